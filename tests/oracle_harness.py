"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
"""
from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "date": "DATE", "smallint": "SMALLINT", "float": "FLOAT"}


def type_mismatches(spark_df, rel):
    d = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for name, t in spark_df.dtypes:
        want = SPARK_TO_DUCK.get(t, t)
        if name in d and d[name] != want:
            out.append(f"{name}: spark {t} vs duck {d[name]}")
    return out


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    msgs = []
    types = type_mismatches(spark_df, rel)
    if types:
        msgs.append(f"types differ: {types}")
    if sorted(s_cols) != sorted(d_cols):
        msgs.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return False, msgs, len(s_rows), len(d_rows)
    if len(s_rows) != len(d_rows):
        msgs.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        msgs.append(f"values differ, e.g. {diff}")
    return not msgs, msgs, len(s_rows), len(d_rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    from tickweave.session import build_session
    import __spark_entry__ as entry
    if os.environ.get("PLAIN_SESSION"):
        # the driver's kind of session: nothing of ours at build time
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if wanted and k not in wanted:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if k in sqls:
                ok, msgs, ns, nd = compare(df, con, sqls[k])
            else:
                ns = df.count()
                ok, msgs, nd = True, ["(no oracle, rows only)"], None
        except Exception as e:  # report and go on
            ok, msgs, ns, nd = False, [f"{type(e).__name__}: {str(e)[:400]}"], None, None
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:28s} spark={ns} duck={nd} {time.time() - t0:5.1f}s {' '.join(msgs)}",
              flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

"""Exact top-k inner products by columnar branch-and-bound.

Vectors are cut into blocks of rows stored by dimension (one row per dimension), with the
dimensions in an order of falling energy.  For a block of queries the partial products grow
one group of dimensions at a time; what a candidate can still gain is at most the product of
the remaining norms of query and candidate (Cauchy-Schwarz).  A candidate whose upper bound
is below the k-th largest lower bound is dropped and the survivors are compacted.

Rows and queries meet block by block: a pair of blocks is one group, bounded by
``ROW_BLOCK`` rows and ``QUERY_BLOCK`` queries whatever the table's size, and gives at most
k rows per query.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

K = 10
SCALE = 1024
QUERY_EVERY = 100
ROW_BLOCK = 16_384
QUERY_BLOCK = 2_048
DIMENSIONS = 16  # dimensions added between two prunings
EXACT = 1 << 53  # integers up to here are exact as doubles

SCHEMA = "query_row long, query_id long, row long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): floor(1024 x) of every component, of the vectors that take part."""
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("x")))
            .select("vec_id", F.transform("x", lambda x: F.floor(x * SCALE).cast("long")).alias("v")))


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    """Vectors as columns of a dimensions x rows matrix; shorter ones are filled with zeros."""
    out = np.zeros((width, len(lists)), np.int64)
    for k, v in enumerate(lists):
        out[:len(v), k] = v
    return out


def top_of_block(query_rows: np.ndarray, queries: np.ndarray, places: np.ndarray, ids: np.ndarray, rows: np.ndarray,
                 k: int = K) -> tuple[list, list, list]:
    """The k best rows of the block for every query, as (query, place in the block, score): scores from high to low, ties
    to the smaller id, then to the smaller row key; the query's own row is left out.  ``queries`` and
    ``rows`` are dimensions x n, ``places`` the row keys of the block."""
    order = np.argsort(-(np.square(rows.astype(float)).sum(axis=1)), kind="stable")
    queries, rows = queries[order], rows[order]
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, len(rows))
    exact = np.float64 if largest < EXACT else np.int64
    rows, queries = rows.astype(exact), queries.astype(exact)
    edges = list(range(0, len(rows), DIMENSIONS)) + [len(rows)]

    def remaining(x: np.ndarray) -> np.ndarray:
        """Norm of what follows each edge, a little above the exact value."""
        mass = np.square(x.astype(float)).cumsum(axis=0)
        total = mass[-1] if len(mass) else np.zeros(x.shape[1])
        done = np.stack([mass[e - 1] if e else np.zeros(x.shape[1]) for e in edges])
        return np.sqrt(np.maximum(total - done, 0) * (1 + 1e-9) + 1e-6 * total + 1e-6)
    row_rest, query_rest = remaining(rows), remaining(queries)
    out_q, out_v, out_s = [], [], []
    for q, own in enumerate(query_rows):
        alive = np.flatnonzero(places != own)
        part = np.zeros(len(alive), exact)
        block = rows
        for step in range(len(edges) - 1):
            a, b = edges[step], edges[step + 1]
            chunk = block[a:b] if len(alive) == rows.shape[1] else rows[a:b, alive]
            part = part + queries[a:b, q] @ chunk
            if step + 1 < len(edges) - 1 and len(alive) > 4 * k:
                slack = row_rest[step + 1, alive] * query_rest[step + 1, q]
                floor = np.partition(part - slack, len(alive) - k)[len(alive) - k]
                keep = part + slack >= floor
                alive, part = alive[keep], part[keep]
        if len(alive) > k:
            edge = np.partition(part, len(part) - k)[len(part) - k]
            keep = part >= edge
            alive, part = alive[keep], part[keep]
        best = np.lexsort((places[alive], ids[alive], -part))[:k]
        out_q += [q] * len(best)
        out_v += alive[best].tolist()
        out_s += part[best].astype(np.int64).tolist()
    return out_q, out_v, out_s


def _meet(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if not len(rows) or not len(queries):
        return pd.DataFrame({name.split()[0]: [] for name in SCHEMA.split(", ")}, dtype="int64")
    width = max(rows["v"].map(len).max(), queries["v"].map(len).max())
    q, at, s = top_of_block(queries["row"].to_numpy(), _matrix(queries["v"], width), rows["row"].to_numpy(),
                            rows["vec_id"].to_numpy(), _matrix(rows["v"], width))
    return pd.DataFrame({"query_row": queries["row"].to_numpy()[q], "query_id": queries["vec_id"].to_numpy()[q],
                         "row": rows["row"].to_numpy()[at], "vec_id": rows["vec_id"].to_numpy()[at], "score": s}, dtype="int64")


def top_k(vectors: DataFrame, every: int = QUERY_EVERY, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row whose vec_id is
    divisible by ``every``.

    Vectors that are null or hold null or non-finite components, and rows without vec_id, take
    no part.  Vectors of different lengths are compared as if the shorter had zeros.  Rows that
    share a vec_id are rows of their own: each is a candidate of the others, and each is a query where
    the id asks for it; other columns are ignored; an empty table gives no rows."""
    scratch = Scratch(vectors.sparkSession, "topk")
    data = scratch.keep(scaled(vectors).withColumn("row", F.monotonically_increasing_id()), "scaled")
    queries = data.where(F.col("vec_id") % every == 0)
    n, m = data.count(), queries.count()
    row_blocks, query_blocks = -(-n // ROW_BLOCK) or 1, -(-m // QUERY_BLOCK) or 1

    def dealt(frame: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return frame.select("row", "vec_id", "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias(own),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other))
    left = dealt(data, "row_block", row_blocks, "query_block", query_blocks)
    right = dealt(queries, "query_block", query_blocks, "row_block", row_blocks)
    found = (left.groupBy("row_block", "query_block")
             .cogroup(right.groupBy("row_block", "query_block")).applyInPandas(_meet, SCHEMA))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_columnar_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP7_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r AS q, c.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, r) AS rank FROM s)
WHERE rank <= {K}"""

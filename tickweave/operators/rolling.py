"""Row-frame rolling windows over long series without one partition per series.

``Window.partitionBy(series).orderBy(time)`` puts a whole series in one task.
Instead:

1. rows per (series, day) are counted and a running sum over that small table
   gives each day's offset; ``row_number`` inside a (series, day) - at most one
   day of buckets - plus the offset is the global row index ``_i``;
2. ``_blk = _i div block``; the last ``halo`` rows of every block are copied into
   the next block;
3. windows run per (series, block) ordered by ``_i`` - every task holds at most
   ``block + halo`` rows - and the lead-in gate uses the *global* index, so the
   result equals the single-partition window exactly;
4. halo copies are dropped.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reuse

DEFAULT_BLOCK = 50_000


def with_row_index(df: DataFrame, keys, order="time", segment: str = "day",
                   out: str = "_i") -> DataFrame:
    """Adds ``out``: 0-based position of the row in its group ``keys`` by ``order``
    (a column name or a list of them; the first one is a timestamp).

    No task ranks a whole group: rows are ranked inside (keys, ``segment`` of the
    first order column) and shifted by the running count of the earlier segments,
    taken from the small per-segment count table."""
    order = [order] if isinstance(order, str) else list(order)
    seg = F.date_trunc(segment, F.col(order[0])).alias("_seg")
    with_seg = df.select("*", seg)
    counts = with_seg.groupBy(*keys, "_seg").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_seg",
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_seg").orderBy(*[F.col(o) for o in order])
    joined = with_seg.join(offsets, [*keys, "_seg"])
    return joined.select(*df.columns,
                         (F.col("_off") + F.row_number().over(inside) - 1).alias(out))


@dataclass(frozen=True)
class Roll:
    """One output column: kind in {'mean', 'std', 'momentum'} of ``source`` over
    ``size`` rows."""
    name: str
    kind: str
    source: str
    size: int


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _expr_sql(spec: Roll, partition: list[str]) -> str:
    """The window column as SQL text (parsed once by the JVM, instead of one call
    per expression node)."""
    x = _q(spec.source)
    part = ", ".join(_q(k) for k in partition)
    over = f"OVER (PARTITION BY {part} ORDER BY _i"
    if spec.kind == "momentum":
        return (f"CASE WHEN _i >= {spec.size} THEN try_divide({x}, lag({x}, {spec.size}) {over})) "
                f"- 1.0D END AS {_q(spec.name)}")
    agg = "avg" if spec.kind == "mean" else "stddev_samp"
    frame = f"ROWS BETWEEN {spec.size - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN _i >= {spec.size - 1} THEN {agg}({x}) {over} {frame} END AS {_q(spec.name)}"


def rolling(df: DataFrame, keys, specs: list[Roll], order: str = "time",
            block: int = DEFAULT_BLOCK, segment: str = "day",
            persist_input: bool = True) -> DataFrame:
    """Adds every ``Roll`` column, equal to a per-series row-frame window.

    The input feeds both the per-day counts and the rows themselves; with
    ``persist_input`` it is computed once (MEMORY_AND_DISK - lost blocks are
    recomputed from lineage) instead of once per branch.  Inputs here are
    bucketed series (one row per bucket and pair), far smaller than the trades."""
    halo = max(s.size for s in specs)
    if block < halo:
        raise ValueError("block must hold at least one halo")
    if persist_input:
        df = reuse(df)
    idx = with_row_index(df, keys, order, segment)
    blk = F.floor(F.col("_i") / block)
    own = F.struct(blk.alias("b"), F.lit(False).alias("h"))
    copy = F.struct((blk + 1).alias("b"), F.lit(True).alias("h"))
    tail = F.pmod(F.col("_i"), F.lit(block)) >= block - halo
    # one generator instead of a union: the indexed rows are computed once
    both = (idx.select("*", F.explode(F.when(tail, F.array(own, copy)).otherwise(F.array(own)))
                       .alias("_c"))
            .select(*idx.columns, F.col("_c.b").alias("_blk"), F.col("_c.h").alias("_halo")))
    out = both.selectExpr("*", *[_expr_sql(s, [*keys, "_blk"]) for s in specs])
    return out.where(~F.col("_halo")).drop("_blk", "_halo", "_i")


def rolling_single_partition(df: DataFrame, keys, specs: list[Roll], order: str = "time") -> DataFrame:
    """Reference form (one partition per series) - only for tests on small data."""
    ordered = Window.partitionBy(*keys).orderBy(order)
    idx = df.select("*", (F.row_number().over(ordered) - 1).alias("_i"))
    return idx.selectExpr("*", *[_expr_sql(s, list(keys)) for s in specs]).drop("_i")

"""Exact quantiles (linear interpolation, as pandas/numpy) in one distributed plan.

Spark's exact ``percentile``/``median`` keep every distinct value of a group in one
final task.  Here equal values are counted first, the counted values are
range-partitioned (Spark samples the bounds), and each range's count gives the rows
below it.  Only the ranges that hold a wanted rank are summed up value by value.
There is no size switch and no value reaches the driver; a value that holds most of
the rows is one counted row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reuse


def lerp(lo: Column, hi: Column, frac: Column) -> Column:
    """numpy's linear interpolation (the upper form from the middle on)."""
    diff = hi - lo
    return (F.when(frac == 0, lo).when(frac >= 0.5, hi - diff * (F.lit(1.0) - frac))
            .otherwise(lo + diff * frac))


def quantiles(df: DataFrame, column: str, qs: list[float], names: list[str], keys=()) -> DataFrame:
    """One row per value of ``keys`` (one row without keys) with the quantiles ``qs`` of
    ``column`` as columns ``names``.

    NULLs are left out.  Without keys the row is there even for an empty input, with NULL
    quantiles; with keys, a group has a row if it has a value."""
    by = list(keys) or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(0))
    ranged = reuse(source.select(*by, F.col(column).cast("double").alias("x")).na.drop()
                   .groupBy(*by, "x").agg(F.count(F.lit(1)).alias("c"))
                   .repartitionByRange(*by, "x").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (ranged.groupBy(*by, "part").agg(F.sum("c").alias("m"))
             .withColumn("below", F.coalesce(F.sum("m").over(before), F.lit(0)))
             .withColumn("n", F.sum("m").over(Window.partitionBy(*by))))
    # 0-based position of each quantile, as (index, lower rank, upper rank, fraction)
    place = [(F.col("n") - 1) * F.lit(float(q)) for q in qs]
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.floor(p).alias("lo"), F.ceil(p).alias("hi"),
                                (p - F.floor(p)).alias("frac")) for i, p in enumerate(place)])
    targets = (parts.select(*by, "part", "below", "m", F.explode(wanted).alias("w"))
               .where((F.col("w.hi") >= F.col("below")) & (F.col("w.lo") < F.col("below") + F.col("m"))))
    edges = targets.groupBy(*by, "part", "below").agg(F.collect_list("w").alias("ws"))
    inside = Window.partitionBy(*by, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("c").over(inside), F.lit(0))
    held = (ranged.join(edges, [*by, "part"]).withColumn("start", start)
            .select(*by, "x", "start", (F.col("start") + F.col("c")).alias("stop"), F.explode("ws").alias("w")))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) >= F.col("start")) & (F.col(rank) < F.col("stop")), F.col("x")))
    found = held.groupBy(*by, F.col("w.i").alias("i"), F.col("w.frac").alias("frac")).agg(
        at("w.lo").alias("lo"), at("w.hi").alias("hi"))
    value = lerp(F.col("lo"), F.col("hi"), F.col("frac"))
    picks = [F.max(F.when(F.col("i") == i, value)).alias(name) for i, name in enumerate(names)]
    return found.groupBy(*keys).agg(*picks) if keys else found.agg(*picks)


def beside(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row (a union and an aggregate, no join)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])

"""Missing buckets of a series as intervals.

Consecutive candles are compared inside a day, the days' first and last candles inside a
year, and the years' inside the series: what a stretch hands on is its first and its last
candle.  No window holds more than a day of candles, a year of days or a series' years,
and no bucket grid is built, so an empty decade is one row.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import bucket_seconds
from ..session import reuse
from .candles import series_keys

STRETCHES = ("day", "year", None)


def holes(candles: DataFrame, bucket: str = "1 minute", keys=None) -> DataFrame:
    """(keys, hole_start, hole_end, n_buckets): every longest run of missing buckets between a series' first
    and last candle, with its first and last missing bucket.  Candles without a time are left out,
    repeated ones count once."""
    keys = list(keys or series_keys(candles))
    step = bucket_seconds(bucket) * 1_000_000
    at = F.unix_micros(F.col("time").cast("timestamp"))
    times = candles.where(F.col("time").isNotNull()).select(*keys, at.alias("first"), at.alias("last"))
    stretches, found = reuse(times), []
    for parent in STRETCHES:
        inside = [*keys, F.date_trunc(parent, F.timestamp_micros("first")).alias("_in")] if parent else keys
        following = F.lead("first").over(Window.partitionBy(*inside).orderBy("first"))
        found.append(stretches.select(*keys, "last", following.alias("next")).where(F.col("next") > F.col("last") + step))
        if parent:
            stretches = reuse(stretches.groupBy(*inside).agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_in"))

    def time(micros):
        return F.timestamp_micros(micros).cast("timestamp_ntz")
    return reduce(DataFrame.unionByName, found).select(
        *keys, time(F.col("last") + step).alias("hole_start"), time(F.col("next") - step).alias("hole_end"),
        F.expr(f"(next - last) div {step} - 1").alias("n_buckets"))

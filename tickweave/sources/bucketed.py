"""Candle tables stored in buckets of (pair, time): venues are put side by side without a shuffle."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import c, col_name
from ..operators.candles import series_keys
from ..session import scratch_table


def write_bucketed(candles: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """The candles as a catalogue table whose files are buckets of (base[, quote], time), one file a bucket.

    The rows are dealt out by the same hash as the buckets first, so a writer holds whole buckets."""
    keys = [k for k in series_keys(candles) if k != "exchange"]
    scratch_table(candles.sparkSession, table)
    (candles.where(F.col("time").isNotNull()).repartition(buckets, *keys, "time")
     .write.mode("overwrite").bucketBy(buckets, *keys, "time").sortBy(*keys, "time").option("path", path).saveAsTable(table))


def align_join(spark: SparkSession, table: str, ex1: str, ex2: str, fields) -> DataFrame:
    """Rows where both venues have every chosen field, as an equi-join of two slices of a bucketed table.  Both
    slices are already dealt out by the join keys: the plan has no exchange."""
    stored = spark.table(table)
    keys = [k for k in series_keys(stored) if k != "exchange"]

    def venue(name):
        held = stored.where((F.col("exchange") == name) & F.expr(" AND ".join(f"{f} IS NOT NULL" for f in fields)))
        return held.select(*keys, "time", *[F.col(f).alias(col_name(name, f)) for f in fields])
    joined = venue(ex1).hint("merge").join(venue(ex2), [*keys, "time"])
    return joined.select(*keys, "time", *[c(col_name(v, f)) for f in fields for v in (ex1, ex2)])

"""Stored tables that grow by loads: what is stored stays, a load only adds.

A load is compared with the folders it falls into and with no others.  Rows whose key is
stored are dropped (the earlier load wins, as the earlier chunk does inside a load); folders
that gain rows are written anew by dynamic partition overwrite, every other folder keeps its
files.  A load that is repeated, whole or in part, adds nothing, so a job that lost its
driver half-way is simply run again.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.candles import dedupe, series_keys
from ..session import scratch_path

GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
LOAD_ORDER = ("chunk_no", "page_no", "pos")


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _staged(rows: DataFrame) -> DataFrame:
    """The rows written aside: the folders they were made from can then be replaced."""
    path = scratch_path(rows.sparkSession, f"staged-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _replace(rows: DataFrame, path: str, folders: list[str]) -> None:
    (rows.repartitionByRange(*folders, "time").sortWithinPartitions(*folders, "time")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path))


def read_increments(spark: SparkSession, path: str) -> DataFrame:
    """The stored table.  Folder names are text (a period such as 2024-01 must not become a date);
    columns that later loads brought are NULL in earlier folders."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")


def upsert_series(candles: DataFrame, path: str, grain: str = "day") -> None:
    """Adds the candles whose (series, time) is not stored yet.

    Of rows of the load that share a key the first in load order counts where the load carries its order
    (``chunk_no, page_no, pos``), else the smallest row.  Candles without a time are not stored."""
    spark = candles.sparkSession
    keys = [*series_keys(candles), "time"]
    folders = ["exchange", *[k for k in keys if k not in ("exchange", "time")], "period"]
    ordered = all(x in candles.columns for x in LOAD_ORDER)
    values = [x for x in candles.columns if x not in (*keys, *LOAD_ORDER)]
    timed = candles.where(F.col("time").isNotNull())
    load = dedupe(timed, keys) if ordered else timed.groupBy(*keys).agg(F.min(F.struct(*values)).alias("v")).select(*keys, "v.*")
    load = _staged(load.withColumn("period", F.date_format("time", GRAINS[grain])))
    if not exists(spark, path):
        _replace(load, path, folders)
        return
    stored = read_increments(spark, path)
    touched = load.select(*folders).distinct()
    near = stored.join(touched, folders, "left_semi")
    fresh = _staged(load.join(near.select(*keys), keys, "left_anti"))
    grown = fresh.select(*folders).distinct()
    kept = stored.join(grown, folders, "left_semi")
    _replace(_staged(kept.unionByName(fresh, allowMissingColumns=True)), path, folders)


def upsert_wide(wide: DataFrame, path: str, grain: str = "day") -> None:
    """Adds a wide table's rows and cells: a stored cell stays, an empty one takes the load's value, and a
    venue that is new becomes new columns.  Rows without a time are not stored."""
    spark = wide.sparkSession
    keys = [k for k in ("base", "quote") if k in wide.columns]
    folders = [*keys, "period"]
    load = _staged(wide.where(F.col("time").isNotNull()).withColumn("period", F.date_format("time", GRAINS[grain])))
    both = load.withColumn("_load", F.lit(1))
    if exists(spark, path):
        kept = read_increments(spark, path).join(load.select(*folders).distinct(), folders, "left_semi")
        both = kept.withColumn("_load", F.lit(0)).unionByName(both, allowMissingColumns=True)
    cells = [x for x in both.columns if x not in (*folders, "time", "_load")]

    def first(cell: str):
        quoted = F.col(f"`{cell}`")
        return F.min_by(quoted, F.when(quoted.isNotNull(), F.col("_load"))).alias(cell)
    _replace(_staged(both.groupBy(*folders, "time").agg(*map(first, cells))), path, folders)

"""Proof that stored files are sorted: rows are read back with the file and the place they stand in."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEGMENT = 65_536  # rows of a file that are compared in one window


def order_report(spark: SparkSession, path: str, keys, time: str = "time") -> DataFrame:
    """(keys, n_rows, n_out_of_order, n_misplaced_files) of a Parquet table with one folder per series.

    A row is out of order when it is earlier than the row before it in its file; a file is misplaced when it
    begins before the end of the file that precedes it by name.  Rows are compared inside segments
    of a file, then segment with segment and file with file by their first and last rows."""
    keys = list(keys)
    place = F.col("_metadata.row_index")
    rows = spark.read.parquet(path).select(
        *keys, F.col(time).try_cast("timestamp_ntz").alias("t"),  # wide tables store minutes as text
        F.col("_metadata.file_path").alias("file"), place.alias("place"),
        F.floor(place / SEGMENT).alias("segment"))
    before = F.lag("t").over(Window.partitionBy(*keys, "file", "segment").orderBy("place"))
    segments = (rows.withColumn("late", F.col("t") < before).groupBy(*keys, "file", "segment")
                .agg(F.count(F.lit(1)).alias("n"), F.count_if("late").alias("late"),
                     F.min_by("t", "place").alias("first"), F.max_by("t", "place").alias("last"),
                     F.min("t").alias("low"), F.max("t").alias("high")))
    ended = F.lag("last").over(Window.partitionBy(*keys, "file").orderBy("segment"))
    files = (segments.withColumn("cut", (F.col("first") < ended).cast("int")).groupBy(*keys, "file")
             .agg(F.sum("n").alias("n"), (F.sum("late") + F.coalesce(F.sum("cut"), F.lit(0))).alias("late"),
                  F.min("low").alias("low"), F.max("high").alias("high")))
    reached = F.lag("high").over(Window.partitionBy(*keys).orderBy("file"))
    return (files.withColumn("misplaced", F.col("low") < reached).groupBy(*keys)
            .agg(F.sum("n").alias("n_rows"), F.sum("late").cast("long").alias("n_out_of_order"),
                 F.count_if("misplaced").alias("n_misplaced_files")))

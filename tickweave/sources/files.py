"""Table files: long candle series and wide tables, Parquet (default) or CSV.

Series are written partitioned by venue and base, so a reader that asks for one
venue or base reads only its folders (partition pruning).  Times are naive UTC;
series CSV has ``yyyy-MM-dd HH:mm:ss`` text and an explicit schema on read, wide CSV has
minutes and is read by its header.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import c, col_name
from ..operators.candles import series_keys

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
CANDLE_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    *[T.StructField(f, T.DoubleType()) for f in ("open", "high", "low", "close", "volume")],
])


def write_series(candles: DataFrame, path: str, fmt: str = "parquet",
                 partition_by=None) -> None:
    """One folder per series (venue, base and, where the table has one, quote), rows sorted
    by time inside each file.

    Range-partitioned on (series, time) before writing: a series that holds a
    large share of the rows is split over many writer tasks by time range
    (hash-partitioning on the series alone would give it to one task), and every
    file covers one contiguous time range."""
    partition_by = partition_by or ("exchange", *(k for k in series_keys(candles) if k != "exchange"))
    out = (candles.repartitionByRange(*partition_by, "time")
           .sortWithinPartitions(*partition_by, "time"))
    if fmt == "csv":
        out = out.withColumn("time", F.date_format("time", TIME_FORMAT))
        out.write.mode("overwrite").partitionBy(*partition_by).option("header", True).csv(path)
    else:
        out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_series(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        schema = T.StructType([T.StructField("time", T.StringType()), *CANDLE_SCHEMA.fields[1:],
                               T.StructField("exchange", T.StringType()),
                               T.StructField("base", T.StringType())])
        df = spark.read.schema(schema).option("header", True).csv(path)
        return df.withColumn("time", F.to_timestamp_ntz("time", F.lit(TIME_FORMAT)))
    return spark.read.parquet(path)


def write_wide(wide: DataFrame, path: str, fmt: str = "csv", partition_by=None) -> None:
    """One folder per base (and quote, where the table has one), times as minutes;
    range-partitioned on (base, time) like ``write_series``."""
    partition_by = partition_by or tuple(k for k in ("base", "quote") if k in wide.columns)
    out = wide.repartitionByRange(*partition_by, "time").sortWithinPartitions(*partition_by, "time")
    out = out.withColumn("time", F.date_format("time", MINUTE_FORMAT))
    writer = out.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def read_wide(spark: SparkSession, path: str, venues=None, fmt: str = "csv",
              fields=("open", "high", "low", "close", "volume")) -> DataFrame:
    """Wide table back with typed columns and a parsed ``time``, whatever venues the file
    has and in whatever order: columns are taken by header name.

    ``venues`` picks and orders venues; a column they need that the header lacks raises, as
    does a header without ``time``.  Times may be minutes, seconds or ISO; an unreadable
    time becomes NULL, an unreadable number too."""
    if fmt == "csv":  # the header names the columns; every value is text, cast below
        df = spark.read.option("header", True).csv(path)
    else:
        df = spark.read.parquet(path)
    keys = [k for k in ("base", "quote") if k in df.columns]
    if venues is None:
        cells = [x for x in df.columns if x not in ("time", *keys)]
    else:
        cells = [col_name(v, f) for v in venues for f in fields]
    missing = [x for x in ("time", *cells) if x not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return df.select(*keys, F.col("time").try_cast("timestamp_ntz").alias("time"),
                     *[c(x).try_cast("double").alias(x) for x in cells])

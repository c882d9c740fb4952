"""Candles from a trade feed that keeps arriving (Structured Streaming).

The same OHLC operator as the batch job, on a stream of landed trade files: a
watermark bounds how late a trade may arrive, each (series, bucket) is state
until the watermark passes its end, and in ``append`` mode a candle is written
once, when it is final.  The checkpoint folder makes the query restartable
(exactly-once file output).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.candles import SERIES, trade_order

TRADE_SCHEMA = T.StructType([
    T.StructField("base", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])


def read_trades(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """Stream of trade parquet files dropped into ``folder``."""
    return (spark.readStream.schema(TRADE_SCHEMA).option("maxFilesPerTrigger", max_files)
            .parquet(folder))


def stream_candles(trades: DataFrame, bucket: str = "1 minute", late: str = "10 minutes",
                   keys=SERIES) -> DataFrame:
    """Streaming OHLC + volume per series and tumbling bucket (event time ``ts``).

    Watermarks need a zoned ``TIMESTAMP``; naive-UTC times are cast under the
    session zone (UTC) and bucket starts are cast back to naive UTC."""
    if dict(trades.dtypes).get("ts") == "timestamp_ntz":
        trades = trades.withColumn("ts", F.col("ts").cast("timestamp"))
    order = F.when(F.col("price").isNotNull(), trade_order(F.col("ts"), F.col("seq")))
    return (trades.withWatermark("ts", late)
            .groupBy(*keys, F.window("ts", bucket).alias("w"))
            .agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"),
                 F.min("price").alias("low"), F.max_by("price", order).alias("close"),
                 F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"))
            .select(*keys, F.col("w.start").cast("timestamp_ntz").alias("time"),
                    "open", "high", "low", "close", "volume"))


def write_candles(candles: DataFrame, path: str, checkpoint: str,
                  trigger_seconds: int = 60) -> StreamingQuery:
    """Final candles appended to a parquet table partitioned by venue and base."""
    return (candles.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("exchange", "base")
            .trigger(processingTime=f"{trigger_seconds} seconds")
            .start())

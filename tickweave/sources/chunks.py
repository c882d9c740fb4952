"""Request plan: a time range split into fixed-length chunks.

Chunks tile the range, neighbours share their end point and the last one is cut
at the range end; an empty or reversed range gives no chunks.  Each range
expands into its own chunk rows (``explode`` of a ``sequence``), so any number
of ranges is planned in parallel.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_MINUTES = 300
TEXT_FORMAT = "yyyy-MM-dd HH:mm"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def chunk_plan(ranges: DataFrame, chunk_minutes: int = 300, start: str = "start",
               end: str = "end") -> DataFrame:
    """``ranges`` (keys..., start, end as timestamp_ntz) -> one row per chunk with
    chunk_no, chunk_start/chunk_end (timestamp, minute text, ISO text, epoch s and
    ms), the start in epoch ns (cursor form) and the length in minutes."""
    step = chunk_minutes * 60 * 1_000_000
    s_us = F.unix_micros(F.col(start).cast("timestamp"))
    e_us = F.unix_micros(F.col(end).cast("timestamp"))
    keys = [c for c in ranges.columns if c not in (start, end)]
    valid = ranges.where(F.col(start) < F.col(end))
    exploded = valid.select(*keys, e_us.alias("_e"),
                            F.posexplode(F.sequence(s_us, e_us - 1, F.lit(step))).alias("chunk_no", "_s"))
    cs = F.timestamp_micros(F.col("_s")).cast("timestamp_ntz")
    ce = F.timestamp_micros(F.least(F.col("_s") + step, F.col("_e"))).cast("timestamp_ntz")
    return exploded.select(
        *keys, "chunk_no", cs.alias("chunk_start"), ce.alias("chunk_end"),
        F.date_format(cs, TEXT_FORMAT).alias("start_text"),
        F.date_format(ce, TEXT_FORMAT).alias("end_text"),
        F.date_format(cs, ISO_FORMAT).alias("start_iso"),
        F.date_format(ce, ISO_FORMAT).alias("end_iso"),
        F.unix_seconds(cs.cast("timestamp")).alias("start_s"),
        F.unix_seconds(ce.cast("timestamp")).alias("end_s"),
        F.unix_millis(cs.cast("timestamp")).alias("start_ms"),
        F.unix_millis(ce.cast("timestamp")).alias("end_ms"),
        (F.unix_micros(cs.cast("timestamp")) * 1000).alias("since_ns"),
        ((F.unix_micros(ce.cast("timestamp")) - F.col("_s")) / 60_000_000).cast("long").alias("minutes"))


def ranges_from(df: DataFrame, keys, time_col: str = "ts") -> DataFrame:
    """The whole-hour range covering each series' rows."""
    return df.groupBy(*keys).agg(
        F.date_trunc("hour", F.min(time_col)).cast("timestamp_ntz").alias("start"),
        (F.date_trunc("hour", F.max(time_col)) + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz").alias("end"))


def with_chunks(df: DataFrame, time_col: str, start: Column, chunk_minutes: int = CHUNK_MINUTES) -> DataFrame:
    """Adds ``chunk_no``; a row on a chunk border is emitted for both chunks."""
    secs = chunk_minutes * 60
    off = F.unix_micros(F.col(time_col).cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    k = F.floor(off / F.lit(secs * 1_000_000)).cast("long")
    border = (F.pmod(off, F.lit(secs * 1_000_000)) == 0) & (k >= 1)
    chunks = F.when(border, F.array(k - 1, k)).otherwise(F.array(k))
    return df.select("*", F.explode(chunks).alias("chunk_no"))

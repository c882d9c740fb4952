"""Candle building and the long candle table.

The long table ``base, exchange, time, open, high, low, close, volume`` is the
central relation; the venue is a value, not part of a column name.  Every
operator here groups by the series key plus a time bucket, so groups are small
(one bucket of one series) and aggregation is partial (map-side) before the
shuffle, whatever the skew between series.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import bucket_seconds, floor_time
from ..session import reuse

SERIES = ("base", "exchange")
CANDLE_FIELDS = ("open", "high", "low", "close", "volume")


def series_keys(df: DataFrame) -> tuple[str, ...]:
    """The columns that name a series: base, quote where the table has one, exchange."""
    return ("base", "quote", "exchange") if "quote" in df.columns else SERIES


def trade_order(ts: Column, seq: Column) -> Column:
    """(ts, seq) as one number: microseconds times 2 * 10^19 plus the sequence number, exact
    for every ``long`` sequence.  A decimal is a hash-aggregate ordering key; a struct is not."""
    step = F.expr("CAST('20000000000000000000' AS DECIMAL(20,0))")
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(16,0)")
    return micros * step + seq.cast("decimal(19,0)")


def ohlc(trades: DataFrame, bucket: str = "1 minute", keys=None,
         ts: str = "ts", seq: str = "seq", order: Column | None = None) -> DataFrame:
    """Tumbling-bucket OHLC + volume per series.

    ``open``/``close`` are the prices of the first/last trade by ``(ts, seq)``;
    ``min_by``/``max_by`` keep that exact under any shuffle order (``first``/``last``
    would not).  Trades with a NULL price count for volume only, as pandas does.
    ``order`` replaces the ordering key for feeds that need another one.
    """
    keys = keys or series_keys(trades)
    key = trade_order(F.col(ts), F.col(seq)) if order is None else order
    first = F.when(F.col("price").isNotNull(), key)
    secs = bucket_seconds(bucket)
    return (trades
            .where(F.col(ts).isNotNull())
            .groupBy(*keys, floor_time(F.col(ts), secs).alias("time"))
            .agg(F.min_by("price", first).alias("open"),
                 F.max("price").alias("high"),
                 F.min("price").alias("low"),
                 F.max_by("price", first).alias("close"),
                 F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume")))


def trade_range(trades: DataFrame, start, end, ts: str = "ts") -> DataFrame:
    """Trades inside ``[start, end]``, both ends kept.  Plain comparisons on the raw
    column, so the filter reaches the parquet scan."""
    return trades.where((F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
                        & (F.col(ts) <= F.lit(end).cast("timestamp_ntz")))


def chunked_candles(trades: DataFrame, start, bucket: str = "1 minute",
                    chunk_minutes: int = 300, keys=None, **kw) -> DataFrame:
    """Candles as a chunked collector builds them from a trade feed.

    The range from ``start`` is requested in ``chunk_minutes`` chunks whose ends are
    inclusive and shared, so a trade exactly on a border belongs to both chunks;
    candles are built per chunk (a border bucket can hold only that border trade)
    and the earlier chunk's candle wins.  Each trade is tagged with its chunk(s)
    by arithmetic, not by a range join."""
    from ..sources.chunks import with_chunks
    keys = keys or series_keys(trades)
    tagged = with_chunks(trades, "ts", F.lit(start).cast("timestamp_ntz"), chunk_minutes)
    per_chunk = ohlc(tagged, bucket, keys=(*keys, "chunk_no"), **kw)
    return dedupe(per_chunk.withColumn("page_no", F.lit(0)).withColumn("pos", F.lit(0)),
                  keys=(*keys, "time"))


def fill_gaps(candles: DataFrame, bucket: str = "1 minute", keys=None,
              chunk_buckets: int = 1440) -> DataFrame:
    """Add empty buckets between each series' first and last candle.

    Filled rows have NULL prices and volume 0.  The bucket grid of a series is
    generated in pieces of ``chunk_buckets`` (one day of minutes by default), so
    no single array grows with the length of the series; the pieces are dealt out
    before they are expanded, so a long series is many tasks' work.  The candles are
    read twice (extent, join) and kept in between.
    """
    keys = keys or series_keys(candles)
    candles = reuse(candles)
    secs = bucket_seconds(bucket)
    step = F.lit(secs * 1_000_000)
    ext = (candles.groupBy(*keys)
           .agg(F.unix_micros(F.min("time").cast("timestamp")).alias("_t0"),
                F.unix_micros(F.max("time").cast("timestamp")).alias("_t1")))
    n = ((F.col("_t1") - F.col("_t0")) / step).cast("long")
    pieces = ext.select(*keys, "_t0", n.alias("_n"),
                        F.explode(F.sequence(F.lit(0).cast("long"),
                                             F.floor(n / chunk_buckets).cast("long")))
                        .alias("_piece")).repartition(*keys, "_piece")
    lo = F.col("_piece") * chunk_buckets
    hi = F.least(F.col("_n"), lo + (chunk_buckets - 1))
    grid = (pieces.select(*keys, "_t0", F.explode(F.sequence(lo, hi)).alias("_i"))
            .select(*keys, F.timestamp_micros(F.col("_t0") + F.col("_i") * step)
                    .cast("timestamp_ntz").alias("time")))
    out = grid.join(candles, [*keys, "time"], "left")
    return out.select(*keys, "time", "open", "high", "low", "close",
                      F.coalesce(F.col("volume"), F.lit(0.0)).alias("volume"))


def load_order(chunk: str = "chunk_no", page: str = "page_no", pos: str = "pos"):
    """(chunk, page, position) in load order as one number (page below 10^18, position
    below 10^10; a ``long`` page number or an array position cannot exceed them)."""
    wide = [F.col(c).cast("decimal(19,0)") for c in (chunk, page, pos)]
    return (wide[0] * F.expr("CAST('10000000000000000000' AS DECIMAL(20,0))")
            + wide[1] * F.expr("CAST('10000000000' AS DECIMAL(11,0))") + wide[2]).cast("decimal(38,0)")


def dedupe(rows: DataFrame, keys=None, order=("chunk_no", "page_no", "pos")) -> DataFrame:
    """One row per key, the first in load order (earlier chunk wins).

    An aggregate instead of a ranking window: partial aggregation on the map side
    and no sort of whole partitions.  The load order is one number and every
    value column its own ``min_by``, so the aggregate is hash-based.
    """
    keys = keys or (*series_keys(rows), "time")
    values = [c for c in rows.columns if c not in keys and c not in order]
    ordered = rows.select(*keys, *values, load_order(*order).alias("_ord"))
    return ordered.groupBy(*keys).agg(*[F.min_by(v, "_ord").alias(v) for v in values])


def series_extent(candles: DataFrame, keys=None) -> DataFrame:
    return (candles.groupBy(*(keys or series_keys(candles)))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min("time").alias("first_time"),
                 F.max("time").alias("last_time")))


def candle_stats(candles: DataFrame, keys=None) -> DataFrame:
    return (candles.groupBy(*(keys or series_keys(candles)))
            .agg(F.min("open").alias("min_open"), F.max("open").alias("max_open"),
                 F.min("close").alias("min_close"), F.max("close").alias("max_close"),
                 F.sum("volume").alias("total_volume")))


def coverage(candles: DataFrame, bucket: str = "1 minute", keys=None) -> DataFrame:
    """Candles present vs. buckets expected between the first and the last one."""
    keys = keys or series_keys(candles)
    secs = bucket_seconds(bucket)
    ext = series_extent(candles, keys)
    span = (F.unix_seconds(F.col("last_time").cast("timestamp"))
            - F.unix_seconds(F.col("first_time").cast("timestamp")))
    expected = (span / F.lit(secs)).cast("long") + 1
    return ext.select(*keys, "first_time", "last_time",
                      F.col("n_rows").alias("present"),
                      expected.alias("expected"),
                      (expected - F.col("n_rows")).alias("missing"))


def preview(candles: DataFrame, n: int = 5, keys=None) -> DataFrame:
    """First and last ``n`` candles of every series (head/tail preview).

    Two-level top-n so that no task sorts a whole series: first the n
    earliest/latest rows of every (series, day), then of those survivors per
    series (n rows per day of the series at most).
    """
    keys = keys or series_keys(candles)
    day = F.date_trunc("day", F.col("time"))
    outs = []
    for part, order in (("head", F.col("time").asc()), ("tail", F.col("time").desc())):
        w_day = Window.partitionBy(*keys, day).orderBy(order)
        w_all = Window.partitionBy(*keys).orderBy(order)
        daily = (candles.withColumn("_r", F.row_number().over(w_day))
                 .where(F.col("_r") <= n).drop("_r"))
        outs.append(daily.withColumn("_r", F.row_number().over(w_all))
                    .where(F.col("_r") <= n).drop("_r")
                    .withColumn("part", F.lit(part)))
    return outs[0].unionByName(outs[1])

"""Land candles and trades as raw exchange pages (inputs for the decoders).

The collector asks each venue for consecutive time chunks whose end points are
shared, so a row stamped exactly on a chunk border arrives twice.  This module
reproduces that on data derived from the driver tables: every row gets its chunk
(and the previous chunk when it sits on a border), rows are grouped into pages of
at most ``page_limit`` rows and serialised in the venue's field order.  All of
it is one aggregation per page; no page holds more than ``page_limit`` rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.candles import series_keys
from ..operators.rolling import with_row_index
from ..session import reuse
from .chunks import CHUNK_MINUTES, with_chunks
from .symbols import kraken_symbol

PAGE_LIMIT = 1000


def _s(x: Column) -> Column:
    return x.cast("string")


def _q(x: Column) -> Column:
    return F.concat(F.lit('"'), x.cast("string"), F.lit('"'))


def _row_text(layout: str) -> Column:
    ms = F.unix_millis(F.col("time").cast("timestamp"))
    sec = F.unix_seconds(F.col("time").cast("timestamp"))
    o, h, lo, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    parts = {
        "BINANCE": [_s(ms), _q(o), _q(h), _q(lo), _q(c), _q(v), _s(ms + 59_999), _q(v * c),
                    F.lit("1"), _q(v), _q(v * c), _q(F.lit(0))],
        "BITFINEX": [_s(ms), _s(o), _s(c), _s(h), _s(lo), _s(v)],
        "COINBASE": [_s(sec), _s(lo), _s(h), _s(o), _s(c), _s(v)],
        "GATEIO": [_q(sec), _q(v), _q(c), _q(h), _q(lo), _q(o), _q(v * c), _q(F.lit("true"))],
        "MEXC": [_s(ms), _q(o), _q(h), _q(lo), _q(c), _q(v), _s(ms + 59_999), _q(v * c)],
    }[layout]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def range_start(df: DataFrame, time_col: str) -> Column:
    """The range start (the earliest row's hour) as a literal: one scalar result."""
    first = df.agg(F.date_trunc("hour", F.min(time_col)).cast("timestamp_ntz")).first()[0]
    return F.lit(first).cast("timestamp_ntz")


def _paged(df: DataFrame, keys, order: list[str], page_limit: int) -> DataFrame:
    """Adds ``page_no`` = position in (keys) by ``order`` div the page limit.  The
    position is ranked per minute and shifted by running minute counts (candles
    are unique per bucket, so a chunk holds a bounded number of them)."""
    ranked = with_row_index(df, keys, order, segment="minute", out="_pos")
    return ranked.withColumn("page_no", F.floor(F.col("_pos") / page_limit).cast("int")).drop("_pos")


def land_candles(candles: DataFrame, layout: str, chunk_minutes: int = CHUNK_MINUTES,
                 page_limit: int = PAGE_LIMIT) -> DataFrame:
    """Candles (any venue) serialised as ``layout`` pages.

    The page keeps the candle's own venue in ``exchange`` and the layout in
    ``layout``; candles without a quote column are USD pairs.  The candles are read
    three times (range start, per-minute counts, rows) and kept in between; they are
    far smaller than the trades behind them."""
    candles = reuse(candles)
    tagged = with_chunks(candles, "time", range_start(candles, "time"), chunk_minutes)
    keys = series_keys(candles)
    paged = _paged(tagged, [*keys, "chunk_no"], ["time"], page_limit)
    desc = layout == "COINBASE"  # this venue answers newest first
    rows = paged.select(*keys, "chunk_no", "page_no", "time", _row_text(layout).alias("_t"))
    pages = rows.groupBy(*keys, "chunk_no", "page_no").agg(
        F.sort_array(F.collect_list(F.struct("time", "_t")), asc=not desc).alias("_rows"))
    quote = F.col("quote") if "quote" in keys else F.lit("USD")
    return pages.select(
        "exchange", "base", quote.alias("quote"),
        F.concat("base", F.lit("/"), quote).alias("pair"), "chunk_no", "page_no",
        F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda r: r["_t"]), ","), F.lit("]"))
        .alias("payload"),
        F.lit(layout).alias("layout"))


def land_trades(trades: DataFrame, chunk_minutes: int = CHUNK_MINUTES) -> DataFrame:
    """Trades (any venue) serialised as trade-endpoint bodies: an object whose
    ``result.<pair>`` holds ``[price, volume, time, side, type, misc, id]`` rows."""
    tagged = with_chunks(trades, "ts", range_start(trades, "ts"), chunk_minutes)
    # trade ids are unique per series: id div PAGE_LIMIT bounds a page to PAGE_LIMIT
    # trades in id order without ranking anything (no window, whatever the skew)
    paged = tagged.withColumn("page_no", F.floor(F.col("seq") / PAGE_LIMIT).cast("long"))
    t_sec = (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)).cast("string")
    row = F.concat(F.lit("["), F.concat_ws(",", _q(F.col("price")), _q(F.col("volume")), t_sec,
                                           F.lit('"b"'), F.lit('"l"'), F.lit('""'), _s(F.col("seq"))),
                   F.lit("]"))
    rows = paged.select("exchange", "base", "chunk_no", "page_no", "ts", "seq", row.alias("_t"))
    pages = rows.groupBy("exchange", "base", "chunk_no", "page_no").agg(
        F.sort_array(F.collect_list(F.struct("ts", "seq", "_t"))).alias("_rows"),
        F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("_last"))
    pair = kraken_symbol(F.col("base"), F.lit("USD"))
    body = F.concat(F.lit('{"error":[],"result":{"'), pair, F.lit('":['),
                    F.array_join(F.transform("_rows", lambda r: r["_t"]), ","),
                    F.lit('],"last":"'), (F.col("_last") * 1000).cast("string"), F.lit('"}}'))
    return pages.select("exchange", "base", F.lit("USD").alias("quote"), pair.alias("pair"),
                        "chunk_no", "page_no", body.alias("payload"))


# --- damaged copies of real pages (every page, every kind) --------------------------

DAMAGE = ["ok", "truncated", "error_object", "garbage", "empty", "flat", "null_body",
          "short_rows", "bad_number"]


def damaged(pages: DataFrame) -> DataFrame:
    """Every page in every damage kind, tagged with ``damage``."""
    p = F.col("payload")
    kinds = {
        "ok": p,
        "truncated": F.substring(p, 1, (F.length(p) / 2).cast("int")),
        "error_object": F.lit('{"code":-1121,"msg":"Invalid symbol."}'),
        "garbage": F.lit("<html>502 Bad Gateway</html>"),
        "empty": F.lit("[]"),
        "flat": F.lit('["error","ratelimit"]'),
        "null_body": F.lit(None).cast("string"),
        # every row cut to its first three fields
        "short_rows": F.regexp_replace(p, r"\[([^\[\],]*),([^\[\],]*),([^\[\],]*)(,[^\[\]]*)\]", "[$1,$2,$3]"),
        # every price/volume field that is a quoted or bare number after the time
        "bad_number": F.regexp_replace(p, r"\[([^\[\],]*),[^\[\],]*,", "[$1,\"n/a\","),
    }
    parts = [pages.withColumn("payload", expr).withColumn("damage", F.lit(k)) for k, expr in kinds.items()]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out

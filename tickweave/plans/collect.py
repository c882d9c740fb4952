"""Registered jobs: landing, decoding, de-duplication, symbols, chunk plans, sinks.

Raw pages are derived from the driver tables (hourly candles / trades of
``events``) in each venue's layout; the decoders must give the original rows
back.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align as al
from ..operators import candles as cd
from ..session import configure, reuse, scratch_path
from ..sources import chunks as ch
from ..sources import files as fl
from ..sources import landing as ld
from ..sources import payloads as pl
from ..sources import symbols as sy
from ..sources.tape import events_trades
from .common import BUCKET, candles_of, hourly_candles, rounded, trades

CANDLE_OUT = ["base", "exchange", "time", "open", "high", "low", "close", "volume"]

# Listed names of the two catalogues that are looked up by name.
CATALOGUE = [
    ("BITFINEX", "BTCUSD", "tBTCUSD"),
    ("BITFINEX", "ETHUSD", "tETHUSD"),
    ("BITFINEX", "DOGE:USD", "tDOGE:USD"),
    ("KRAKEN", "XBTUSD", "XXBTZUSD"),
    ("KRAKEN", "ETHUSD", "XETHZUSD"),
    ("KRAKEN", "XDGUSD", "XDGUSD"),
]


def landed(spark: SparkSession, sf_dir: str, layout: str, keep: bool = False) -> DataFrame:
    """Pages of the hourly candles in ``layout``; ``keep`` when a job reads them
    more than once."""
    pages = ld.land_candles(hourly_candles(spark, sf_dir, multi_base=True), layout)
    return reuse(pages) if keep else pages


def _adapt(layout: str):
    def q(spark, sf_dir):
        pages = landed(spark, sf_dir, layout)
        rows = pl.decode_candles(pages, layout_col="layout")
        return rounded(cd.dedupe(rows).select(*CANDLE_OUT))
    q.__name__ = f"q_adapt_{layout.lower()}"
    return q


def kraken_pages(spark, sf_dir) -> DataFrame:
    return ld.land_trades(trades(spark, sf_dir, multi_base=True))


def q_adapt_kraken_trades(spark, sf_dir):
    got = pl.decode_trades(kraken_pages(spark, sf_dir))
    return rounded(got.select("base", "exchange", "ts", "seq", "price", "volume"))


def q_adapt_kraken(spark, sf_dir):
    """Trade pages -> trades -> hourly candles (the trade venue's adapter end to end)."""
    got = pl.decode_trades(kraken_pages(spark, sf_dir))
    return rounded(candles_of(got).select(*CANDLE_OUT))


def q_page_union(spark, sf_dir):
    """All pages of a series read in one scan: pages and rows before de-duplication."""
    pages = landed(spark, sf_dir, "BINANCE", keep=True)
    rows = pl.decode_candles(pages, layout_col="layout")
    n_pages = pages.groupBy("exchange", "base").agg(F.count(F.lit(1)).alias("n_pages"))
    n_rows = rows.groupBy("exchange", "base").agg(F.count(F.lit(1)).alias("n_rows"))
    return n_pages.join(n_rows, ["exchange", "base"])


def q_dedupe_candles(spark, sf_dir):
    """Keep-first de-duplication of chunked pages: rows landed, kept and dropped."""
    rows = reuse(pl.decode_candles(landed(spark, sf_dir, "BINANCE"), layout_col="layout"))
    kept = cd.dedupe(rows)
    a = rows.groupBy("exchange", "base").agg(F.count(F.lit(1)).alias("n_landed"))
    b = kept.groupBy("exchange", "base").agg(F.count(F.lit(1)).alias("n_kept"))
    return a.join(b, ["exchange", "base"]).withColumn("n_dropped", F.col("n_landed") - F.col("n_kept"))


def damaged_pages(spark, sf_dir) -> DataFrame:
    """Every landed page in every damage kind; the pages are built once."""
    return ld.damaged(landed(spark, sf_dir, "BINANCE", keep=True))


def q_bad_payloads(spark, sf_dir):
    """Every page in every damage kind: page status and rows decoded / rejected."""
    pages = damaged_pages(spark, sf_dir)
    return pl.status_counts(pl.candle_rows(pages, layout_col="layout"), "damage").drop("n_rejected")


def q_load_status(spark, sf_dir):
    return pl.load_status(damaged_pages(spark, sf_dir).drop("damage"), layout_col="layout")


def q_quarantine(spark, sf_dir):
    q = pl.quarantine(damaged_pages(spark, sf_dir).drop("damage"), layout_col="layout")
    return q.groupBy("exchange", "base", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def q_chunk_plan(spark, sf_dir):
    ranges = ch.ranges_from(trades(spark, sf_dir, multi_base=True), ["base", "exchange"])
    return ch.chunk_plan(ranges, 300).drop("chunk_start", "chunk_end")


def series_of(spark, sf_dir) -> DataFrame:
    return trades(spark, sf_dir, multi_base=True).select("exchange", "base").distinct() \
        .withColumn("quote", F.lit("USD"))


def q_symbol_map(spark, sf_dir):
    req = series_of(spark, sf_dir).select("exchange", F.concat("base", F.lit("/"), "quote").alias("pair"))
    return sy.symbol_map(req, sy.catalogue_frame(spark, CATALOGUE))


def q_currency_list(spark, sf_dir):
    """A typed-in list per venue (lower case, blanks, empty items) cleaned up."""
    t = trades(spark, sf_dir, multi_base=True)
    typed = t.groupBy("exchange").agg(
        F.concat(F.array_join(F.sort_array(F.collect_set(F.lower("base"))), " , "), F.lit(", ,"))
        .alias("typed"))
    return typed.select("exchange", F.explode(sy.clean_list(F.col("typed"))).alias("base"))


def q_pair_lookup(spark, sf_dir):
    cat = sy.catalogue_frame(spark, CATALOGUE)
    req = series_of(spark, sf_dir).where(F.col("exchange").isin("BITFINEX", "KRAKEN"))
    return sy.lookup_pairs(req, cat)


def q_time_coerce(spark, sf_dir):
    """Times as text (seconds format, minute format, not a time) -> minute or NULL."""
    t = trades(spark, sf_dir, multi_base=True).select("seq", "ts", "exchange")
    texts = t.select("seq", F.lit("seconds").alias("kind"),
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text")) \
        .unionByName(t.select("seq", F.lit("minutes").alias("kind"),
                              F.date_format("ts", "yyyy-MM-dd HH:mm").alias("text"))) \
        .unionByName(t.select("seq", F.lit("junk").alias("kind"), F.col("exchange").alias("text")))
    parsed = F.col("text").try_cast("timestamp_ntz")
    return texts.select("seq", "kind", "text",
                        F.date_trunc("minute", parsed).cast("timestamp_ntz").alias("time"))


def q_csv_roundtrip(spark, sf_dir):
    """Wide table -> CSV (one folder per base) -> typed read with parsed time."""
    candles = reuse(hourly_candles(spark, sf_dir, multi_base=True))
    venues = al.present_venues(candles)
    wide = al.widen(candles, venues)
    path = scratch_path(spark, f"wide-csv-{uuid.uuid4().hex}")
    fl.write_wide(wide, path, "csv")
    back = fl.read_wide(spark, path, venues, "csv")
    return rounded(back.select("base", "time", *[F.col(f"`{c}`") for c in wide.columns[2:]]))


def q_wide_by_header(spark, sf_dir):
    """The wide CSV read for two of its venues in the opposite order of the file's columns."""
    candles = reuse(hourly_candles(spark, sf_dir, multi_base=True))
    path = scratch_path(spark, f"wide-csv-{uuid.uuid4().hex}")
    fl.write_wide(al.widen(candles, ["BINANCE", "BITFINEX", "COINBASE"]), path, "csv")
    return rounded(fl.read_wide(spark, path, ["COINBASE", "BINANCE"], "csv", fields=("high", "close")))


# The three pairs of a triangle, by user_id % 3.
TRIANGLE = [("BTC", "USDT"), ("ETH", "USDT"), ("ETH", "BTC")]


def triangle_trades(spark, sf_dir) -> DataFrame:
    """The tape with three pairs, two of which share their base and two their quote."""
    configure(spark)
    pick = (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int")
    tape = events_trades(spark, sf_dir, extra=("user_id",))
    return tape.select(
        F.element_at(F.array(*[F.lit(b) for b, _ in TRIANGLE]), pick).alias("base"),
        F.element_at(F.array(*[F.lit(q) for _, q in TRIANGLE]), pick).alias("quote"),
        "exchange", "ts", "seq", "price", "volume")


def q_collect_pairs(spark, sf_dir):
    """Candles of three pairs of each venue landed, decoded and de-duplicated: pairs that share
    a base stay apart."""
    pages = ld.land_candles(cd.ohlc(triangle_trades(spark, sf_dir), BUCKET), "BINANCE")
    got = cd.dedupe(pl.decode_candles(pages, layout_col="layout"))
    return rounded(got.select("base", "quote", "exchange", "time", "open", "high", "low", "close", "volume"))


def q_sink_pairs(spark, sf_dir):
    """The same three pairs as series files: one folder per venue, base and quote."""
    path = scratch_path(spark, f"pairs-{uuid.uuid4().hex}")
    fl.write_series(cd.ohlc(triangle_trades(spark, sf_dir), BUCKET), path)
    return rounded(fl.read_series(spark, path).select("base", "quote", "exchange", "time", "open", "high", "low",
                                                      "close", "volume"))


MINUTE_PAGE_LIMIT = 3


def minute_pages(spark, sf_dir, layout: str) -> DataFrame:
    """Minute candles in pages of three rows, followed by a later load of the same range with
    other prices (which must lose everywhere)."""
    candles = cd.ohlc(trades(spark, sf_dir, multi_base=True), "1 minute")
    first = ld.land_candles(candles, layout, page_limit=MINUTE_PAGE_LIMIT)
    stale = candles.select(*[(F.col(c) * 2 if c in cd.CANDLE_FIELDS else F.col(c)).alias(c) for c in candles.columns])
    later = ld.land_candles(stale, layout, page_limit=MINUTE_PAGE_LIMIT)
    return first.unionByName(later.withColumn("chunk_no", F.col("chunk_no") + 1_000_000))


def q_minute_candles(spark, sf_dir):
    """Several pages per chunk, shared chunk borders and a contradicting later load:
    the first load's candles come back."""
    rows = pl.decode_candles(minute_pages(spark, sf_dir, "GATEIO"), layout_col="layout")
    return rounded(cd.dedupe(rows).select(*CANDLE_OUT))


def q_minute_pages(spark, sf_dir):
    """Pages and rows of the minute load, per venue and base."""
    return pl.load_status(minute_pages(spark, sf_dir, "COINBASE"), layout_col="layout")


def q_trade_load_status(spark, sf_dir):
    """Trade pages whole, cut off and replaced by an error, by venue and base."""
    pages = reuse(kraken_pages(spark, sf_dir))
    cut = pages.withColumn("payload", F.substring("payload", 1, 20))
    error = pages.withColumn("payload", F.lit('{"error":["EQuery:Unknown asset pair"]}'))
    no_time = pages.withColumn("payload", F.regexp_replace("payload", r'",[0-9.E]+,"b"', '","x","b"'))
    return pl.trade_load_status(pages.unionByName(cut).unionByName(error).unionByName(no_time))


def q_sink_series(spark, sf_dir):
    """Long candles -> Parquet partitioned by venue and base -> read back."""
    candles = hourly_candles(spark, sf_dir, multi_base=True)
    path = scratch_path(spark, f"series-{uuid.uuid4().hex}")
    fl.write_series(candles, path, "parquet")
    return rounded(fl.read_series(spark, path).select(*CANDLE_OUT))


def q_landed_files(spark, sf_dir):
    """Pages written as JSON lines (one folder per venue), read back with a schema,
    decoded and de-duplicated: the file-based ingest path end to end."""
    path = scratch_path(spark, f"pages-{uuid.uuid4().hex}")
    pl.write_pages(landed(spark, sf_dir, "MEXC"), path)
    rows = pl.decode_candles(pl.read_pages(spark, path), layout_col="layout")
    return rounded(cd.dedupe(rows).select(*CANDLE_OUT))


def q_sink_series_csv(spark, sf_dir):
    """The same series as CSV files (one folder per venue and base), read back
    with an explicit schema."""
    candles = hourly_candles(spark, sf_dir, multi_base=True)
    path = scratch_path(spark, f"series-csv-{uuid.uuid4().hex}")
    fl.write_series(candles, path, "csv")
    return rounded(fl.read_series(spark, path, "csv").select(*CANDLE_OUT))


QUERIES = {
    "adapt_binance": _adapt("BINANCE"),
    "adapt_bitfinex": _adapt("BITFINEX"),
    "adapt_coinbase": _adapt("COINBASE"),
    "adapt_gateio": _adapt("GATEIO"),
    "adapt_mexc": _adapt("MEXC"),
    "adapt_kraken_trades": q_adapt_kraken_trades,
    "adapt_kraken": q_adapt_kraken,
    "page_union": q_page_union,
    "dedupe_candles": q_dedupe_candles,
    "bad_payloads": q_bad_payloads,
    "load_status": q_load_status,
    "quarantine": q_quarantine,
    "chunk_plan": q_chunk_plan,
    "symbol_map": q_symbol_map,
    "currency_list": q_currency_list,
    "pair_lookup": q_pair_lookup,
    "time_coerce": q_time_coerce,
    "csv_roundtrip": q_csv_roundtrip,
    "wide_by_header": q_wide_by_header,
    "collect_pairs": q_collect_pairs,
    "sink_pairs": q_sink_pairs,
    "minute_candles": q_minute_candles,
    "minute_pages": q_minute_pages,
    "trade_load_status": q_trade_load_status,
    "landed_files": q_landed_files,
    "sink_series": q_sink_series,
    "sink_series_csv": q_sink_series_csv,
}

"""Registered jobs over stored tables: loads that add up, ledgers, salvage, sketches, order, co-located joins,
and the reports of every venue pair at once."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import c
from ..operators import align as al
from ..operators import candles as cd
from ..operators import holes as ho
from ..operators import pairs as pr
from ..operators import sketches as sk
from ..operators import spread as sp
from ..session import reuse, scratch_path
from ..sources import bucketed as bk
from ..sources import chunks as ch
from ..sources import files as fl
from ..sources import increment as inc
from ..sources import landing as ld
from ..sources import ledger as lg
from ..sources import order as od
from ..sources import payloads as pl
from .analysis import spread_close_frame
from .collect import CANDLE_OUT, kraken_pages, landed
from .common import BUCKET, EX1, EX2, hourly_candles, rounded, trades


def new_path(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, f"{kind}-{uuid.uuid4().hex}")


# --- E4: quantile states ------------------------------------------------------------------------

SKETCH_PCTS = [50, 75, 90, 95, 99, 99.9]
# days left out at either end of the merged range
SKETCH_SKIP = 3


def stored_spread_states(spark, sf_dir, path: str) -> DataFrame:
    """Absolute close spreads of every base as daily states, stored twice (the second store replaces day by day)."""
    spreads = reuse(spread_close_frame(spark, sf_dir, multi_base=True))
    states = sk.daily_states(spreads, "abs_price_diff_pct", ("base",))
    sk.store_states(states, path)
    sk.store_states(states, path)
    return spreads


def q_sketch_daily_median(spark, sf_dir):
    """A day's median from its stored state: a day has fewer values than a state keeps, so it is a value itself."""
    path = sk.states_path(spark)
    stored_spread_states(spark, sf_dir, path)
    states = sk.stored_states(spark, path)
    return rounded(states.select("base", "day", "n_rows", "low", "high", sk.quantile_of(F.col("state"), 0.5).alias("median")))


def q_sketch_range_percentiles(spark, sf_dir):
    """Percentiles of a range of days from merged states: the rank each answer has among the spreads themselves
    lies within the documented bound."""
    path = sk.states_path(spark)
    spreads = stored_spread_states(spark, sf_dir, path)
    first, last = sk.stored_states(spark, path).agg(F.date_add(F.min("day"), SKETCH_SKIP), F.date_sub(F.max("day"), SKETCH_SKIP)).first()
    qs, names = [p / 100.0 for p in SKETCH_PCTS], [f"q{i}" for i in range(len(SKETCH_PCTS))]
    answers = sk.sketch_quantiles(sk.stored_states(spark, path, first, last), qs, names, ("base",))
    day = F.col("time").cast("date")
    inside = spreads.where((day >= F.lit(first)) & (day <= F.lit(last)))
    errors = sk.rank_errors(answers, inside, "abs_price_diff_pct", qs, names, ("base",))
    return errors.join(answers.select("base", F.col("n_rows").alias("n_in_states")), "base").select(
        "base", "q", "n_rows", "n_in_states", (F.col("error") <= sk.RANK_ERROR).alias("within_bound"))


# --- B1, B2, E12: loads that add up -------------------------------------------------------------

FIELDS = ("open", "high", "low", "close", "volume")


def _doubled(df: DataFrame, cells) -> DataFrame:
    return df.withColumns({x: c(x) * 2 for x in cells})


def q_incremental_series(spark, sf_dir):
    """Three loads into one stored table: two thirds of the chunks; every chunk, with contradicting prices for those
    already loaded; and the second load again."""
    rows = reuse(pl.decode_candles(landed(spark, sf_dir, "BINANCE"), layout_col="layout"))
    late = F.pmod("chunk_no", F.lit(3)) == 2
    second = _doubled(rows.where(~late), FIELDS).unionByName(rows.where(late))
    path = new_path(spark, "increments")
    for load in (rows.where(~late), second, second):
        inc.upsert_series(load, path)
    return rounded(inc.read_increments(spark, path).select(*CANDLE_OUT))


def q_incremental_wide(spark, sf_dir):
    """A wide table that first knows two venues, then all of them with contradicting values for those two."""
    candles = reuse(hourly_candles(spark, sf_dir, multi_base=True))
    path = new_path(spark, "wide")
    first = al.widen(candles, [EX1, EX2])
    inc.upsert_wide(first, path, grain="month")
    every = al.widen(candles)
    inc.upsert_wide(_doubled(every, [x for x in first.columns if ":" in x]), path, grain="month")
    return rounded(inc.read_increments(spark, path).select(*[c(x) for x in every.columns]))


# --- A7, A9, A10: the load ledger ----------------------------------------------------------------

LEDGER_PAGE_LIMIT = 3


def holed_pages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The chunk plan of every series from the feed's first hour, and minute pages of it with planted holes: chunks
    that never came, first pages that are garbage, second pages that are missing."""
    feed = trades(spark, sf_dir, multi_base=True)
    start = ld.range_start(feed, "ts")
    ranges = ch.ranges_from(feed, ["exchange", "base"]).withColumn("start", start)
    pages = ld.land_candles(cd.ohlc(feed, "1 minute"), "GATEIO", page_limit=LEDGER_PAGE_LIMIT)
    k, p = F.col("chunk_no"), F.col("page_no")
    kept = pages.where((F.pmod(k, F.lit(7)) != 3) & ~((F.pmod(k, F.lit(5)) == 2) & (p == 1)))
    broken = (F.pmod(k, F.lit(7)) == 5) & (p == 0)
    return ch.chunk_plan(ranges, 300), kept.withColumn("payload", F.when(broken, F.lit("<html>")).otherwise(F.col("payload")))


def q_load_ledger(spark, sf_dir):
    """Every planned chunk with what landed of it."""
    plan, pages = holed_pages(spark, sf_dir)
    return lg.ledger(plan.select("exchange", "base", "chunk_no"), pages, LEDGER_PAGE_LIMIT, layout_col="layout")


def q_requests_again(spark, sf_dir):
    """The requests to send again, with their ranges and the page to go on from."""
    plan, pages = holed_pages(spark, sf_dir)
    return lg.requests_again(plan.select("exchange", "base", "chunk_no", "start_s", "end_ms"), pages, LEDGER_PAGE_LIMIT,
                             layout_col="layout").drop("n_pages", "n_bad_pages", "n_rows")


# --- A8: salvage -------------------------------------------------------------------------------------

JUNK = '"oops",{"code":7},17'


def salted(pages: DataFrame, opening: str = "[[") -> DataFrame:
    """Every page with a text, an object and a number among its rows."""
    return pages.withColumn("payload", F.replace("payload", F.lit(opening), F.lit(f"{opening[:-1]}{JUNK},[")))


def q_salvaged_candles(spark, sf_dir):
    """The good rows of pages that each hold three elements which are no rows."""
    rows = pl.decode_candles(salted(landed(spark, sf_dir, "BITFINEX")), layout_col="layout")
    return rounded(cd.dedupe(rows).select(*CANDLE_OUT))


def q_salvage_quarantine(spark, sf_dir):
    """What was rejected of those pages, by reason and raw text."""
    rejected = pl.quarantine(salted(landed(spark, sf_dir, "BITFINEX")), layout_col="layout")
    return rejected.groupBy("exchange", "base", "reject_reason", "raw_row").agg(F.count(F.lit(1)).alias("n_rows"))


def q_salvaged_trades(spark, sf_dir):
    """Trades of bodies that hold the same three elements among their rows."""
    got = pl.decode_trades(salted(kraken_pages(spark, sf_dir), '":[['))
    return rounded(got.select("base", "exchange", "ts", "seq", "price", "volume"))


# --- E11, D3: holes -----------------------------------------------------------------------------------

def q_coverage_holes(spark, sf_dir):
    return ho.holes(hourly_candles(spark, sf_dir, multi_base=True), BUCKET)


# --- C12-E7: every venue pair ---------------------------------------------------------------------------

BY_PAIR = ("base", *pr.PAIR)


def pair_spreads(spark, sf_dir, field: str = "close") -> DataFrame:
    pairs = pr.venue_pairs(hourly_candles(spark, sf_dir, multi_base=True), ["high", "close"] if field == "close" else ["high"])
    return sp.spread(pairs, pr.FIRST, pr.SECOND, field)


def q_threshold_ladder_all_pairs(spark, sf_dir):
    return rounded(sp.threshold_ladder(pair_spreads(spark, sf_dir), keys=BY_PAIR))


def q_spread_stats_all_pairs(spark, sf_dir):
    return rounded(sp.spread_stats(pair_spreads(spark, sf_dir), keys=BY_PAIR))


def q_profit_summary_all_pairs(spark, sf_dir):
    return rounded(sp.profit_summary(pair_spreads(spark, sf_dir), pr.SECOND, "close", keys=BY_PAIR))


def q_fee_clearing_all_pairs(spark, sf_dir):
    frame = pair_spreads(spark, sf_dir, "high").withColumn("profit_per_btc", F.abs("price_diff"))
    return rounded(sp.fee_clearing_summary(frame, keys=BY_PAIR))


def q_best_pair_by_time(spark, sf_dir):
    """The widest close spread of each base and hour over all pairs, and which way to trade it."""
    wide = pair_spreads(spark, sf_dir).where(F.col("abs_price_diff_pct").isNotNull())
    # of equal spreads the first pair in registry order; a pair is one number, so that the aggregate hashes
    venues = F.array(*[F.lit(v) for v in al.VENUES])
    rank = (F.array_position(venues, F.col("ex1")) * 100 + F.array_position(venues, F.col("ex2"))).cast("int")
    best = wide.groupBy("base", "time").agg(F.max("abs_price_diff_pct").alias("best"))
    held = wide.join(best, ["base", "time"]).where(F.col("abs_price_diff_pct") == F.col("best")).withColumn("_rank", rank)
    first = held.groupBy("base", "time").agg(F.min("_rank").alias("_rank"), *[
        F.min_by(x, "_rank").alias(x) for x in ("price_diff", "abs_price_diff_pct")])
    one = first.select("*", F.element_at(venues, F.floor(F.col("_rank") / 100).cast("int")).alias("ex1"),
                       F.element_at(venues, F.col("_rank") % 100).alias("ex2"))
    return rounded(one.select("base", "time", "ex1", "ex2", "abs_price_diff_pct",
                              pr.pair_direction(F.col("price_diff")).alias("direction")))


# --- G2 on stored candles, H1 -----------------------------------------------------------------------------

def q_aligned_bucketed(spark, sf_dir):
    """The two venues joined from a bucketed candle table."""
    table = f"candles_{uuid.uuid4().hex}"
    bk.write_bucketed(hourly_candles(spark, sf_dir, multi_base=True), table, new_path(spark, "bucketed"), buckets=8)
    return rounded(bk.align_join(spark, table, EX1, EX2, ["high", "close"]))


def q_sink_order(spark, sf_dir):
    """Series files read back with their places: rows and files in time order."""
    path = new_path(spark, "series")
    fl.write_series(hourly_candles(spark, sf_dir, multi_base=True), path)
    return od.order_report(spark, path, ["exchange", "base"])


def q_sink_order_wide(spark, sf_dir):
    path = new_path(spark, "wide")
    fl.write_wide(al.widen(hourly_candles(spark, sf_dir, multi_base=True)), path, "parquet")
    return od.order_report(spark, path, ["base"])


QUERIES = {
    "sketch_daily_median": q_sketch_daily_median,
    "sketch_range_percentiles": q_sketch_range_percentiles,
    "incremental_series": q_incremental_series,
    "incremental_wide": q_incremental_wide,
    "load_ledger": q_load_ledger,
    "requests_again": q_requests_again,
    "salvaged_candles": q_salvaged_candles,
    "salvage_quarantine": q_salvage_quarantine,
    "salvaged_trades": q_salvaged_trades,
    "coverage_holes": q_coverage_holes,
    "threshold_ladder_all_pairs": q_threshold_ladder_all_pairs,
    "spread_stats_all_pairs": q_spread_stats_all_pairs,
    "profit_summary_all_pairs": q_profit_summary_all_pairs,
    "fee_clearing_all_pairs": q_fee_clearing_all_pairs,
    "best_pair_by_time": q_best_pair_by_time,
    "aligned_bucketed": q_aligned_bucketed,
    "sink_order": q_sink_order,
    "sink_order_wide": q_sink_order_wide,
}

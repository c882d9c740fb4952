"""Registered jobs: candles, the long table and the spread analysis.

Every job reads the driver tables (``events`` as the trade tape) and returns a
DataFrame; nothing is collected except bounded summaries (venue list, quantile
histograms).
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align as al
from ..operators import candles as cd
from ..operators import spread as sp
from ..operators.quantiles import beside, quantiles
from ..session import reuse
from .common import (BUCKET, EX1, EX2, hourly_candles, pair_candles, rounded,
                     trades)

# Venues drawn in the multi-venue price chart.
CHART_VENUES = ["BINANCE", "BITFINEX", "COINBASE"]


def q_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hourly_candles(spark, sf_dir, multi_base=True))


def q_ohlc_gapfill(spark, sf_dir):
    return rounded(cd.fill_gaps(hourly_candles(spark, sf_dir, multi_base=True), BUCKET))


def q_ohlc_bulk(spark, sf_dir):
    """``lineitem`` as a bulk trade feed: all trades of a day share one time stamp and the
    line key repeats, so open/close rest on the feed's own order (day, line key, line price,
    quantity)."""
    from ..sources.tape import lineitem_trades
    from ..session import configure
    configure(spark)
    return rounded(cd.ohlc(lineitem_trades(spark, sf_dir), BUCKET, order=F.col("place")))


def q_series_extent(spark, sf_dir):
    return cd.series_extent(hourly_candles(spark, sf_dir, multi_base=True))


def q_trade_range(spark, sf_dir):
    """Chunked collection of the whole feed: 300-minute requests with inclusive,
    shared ends from the first hour, candles per request, earlier request wins."""
    t = trades(spark, sf_dir, multi_base=True)
    start = t.agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz")).first()[0]
    return rounded(cd.chunked_candles(t, start, BUCKET)
                   .select("base", "exchange", "time", "open", "high", "low", "close", "volume"))


def q_trade_window(spark, sf_dir):
    """Trades of the first three days, both bounds kept and pushed to the scan."""
    t = trades(spark, sf_dir, multi_base=True)
    start = t.agg(F.min("ts")).first()[0]
    inside = cd.trade_range(t, start, start + dt.timedelta(days=3))
    return rounded(inside.groupBy("base", "exchange").agg(
        F.count(F.lit(1)).alias("n_trades"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sum("volume").alias("volume")))


def q_border_trades(spark, sf_dir):
    """The feed with every time floored to ten minutes, so that trades lie on the shared ends
    of the 300-minute requests: chunked collection in 30-minute candles."""
    t = trades(spark, sf_dir, multi_base=True).withColumn(
        "ts", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp"))
                                 - F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(600_000_000)))
        .cast("timestamp_ntz"))
    start = t.agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz")).first()[0]
    return rounded(cd.chunked_candles(t, start, "30 minutes")
                   .select("base", "exchange", "time", "open", "high", "low", "close", "volume"))


def q_candle_stats(spark, sf_dir):
    return rounded(cd.candle_stats(hourly_candles(spark, sf_dir, multi_base=True)))


def q_coverage(spark, sf_dir):
    return cd.coverage(hourly_candles(spark, sf_dir, multi_base=True), BUCKET)


def q_candle_preview(spark, sf_dir):
    return rounded(cd.preview(hourly_candles(spark, sf_dir, multi_base=True), 5))


def q_wide_candles(spark, sf_dir):
    return rounded(al.widen(hourly_candles(spark, sf_dir, multi_base=True)))


def q_wide_extent(spark, sf_dir):
    """Rows, first and last time and column count of the wide table."""
    wide = al.widen(hourly_candles(spark, sf_dir, multi_base=True))
    return wide.agg(F.count(F.lit(1)).alias("n_rows"), F.min("time").alias("first_time"),
                    F.max("time").alias("last_time"),
                    F.lit(len(wide.columns)).cast("int").alias("n_columns"))


def q_wide_candles_chain(spark, sf_dir):
    return rounded(al.widen_chain(hourly_candles(spark, sf_dir, multi_base=True)))


# --- two-venue alignment and spread --------------------------------------------------

def aligned_close(spark, sf_dir, ex1=EX1, ex2=EX2, multi_base=False):
    return al.align(pair_candles(spark, sf_dir, multi_base, (ex1, ex2)), ex1, ex2, ["high", "close"])


def aligned_high(spark, sf_dir, ex1=EX1, ex2=EX2, multi_base=False):
    return al.align(pair_candles(spark, sf_dir, multi_base, (ex1, ex2)), ex1, ex2, ["high"])


def spread_close_frame(spark, sf_dir, ex1=EX1, ex2=EX2, multi_base=False):
    return sp.spread(aligned_close(spark, sf_dir, ex1, ex2, multi_base), ex1, ex2, "close")


def spread_high_frame(spark, sf_dir, ex1=EX1, ex2=EX2, multi_base=False):
    return sp.spread_high(aligned_high(spark, sf_dir, ex1, ex2, multi_base), ex1, ex2)


def q_aligned_pair(spark, sf_dir):
    return rounded(aligned_close(spark, sf_dir))


def q_spread_close(spark, sf_dir):
    return rounded(spread_close_frame(spark, sf_dir))


def q_spread_high(spark, sf_dir, ex1=EX1, ex2=EX2):
    return rounded(spread_high_frame(spark, sf_dir, ex1, ex2))


def q_spread_stats(spark, sf_dir):
    return rounded(sp.spread_stats_with_median(spread_close_frame(spark, sf_dir)))


def q_spread_stats_high(spark, sf_dir):
    frame = reuse(spread_high_frame(spark, sf_dir))
    # one row each side: the summary and its median
    return rounded(beside(sp.high_stats(frame),
                          quantiles(frame, "profit_per_btc", [0.5], ["profit_median"])))


def q_spread_percentiles(spark, sf_dir):
    return rounded(sp.spread_percentiles(spread_close_frame(spark, sf_dir)))


def q_spread_percentiles_by_base(spark, sf_dir):
    """Exact percentiles of the absolute close spread for every base in one plan."""
    return rounded(sp.spread_percentiles(spread_close_frame(spark, sf_dir, multi_base=True), keys=("base",)))


def q_threshold_ladder(spark, sf_dir, ex1=EX1, ex2=EX2):
    return rounded(sp.threshold_ladder(spread_close_frame(spark, sf_dir, ex1, ex2)))


def q_threshold_ladder_by_base(spark, sf_dir):
    """The ladder of every base in one pass (multi-series tape)."""
    return rounded(sp.threshold_ladder(spread_close_frame(spark, sf_dir, multi_base=True), keys=("base",)))


def q_profit_summary_by_base(spark, sf_dir):
    return rounded(sp.profit_summary(spread_close_frame(spark, sf_dir, multi_base=True), EX2, "close", keys=("base",)))


def q_profit_summary(spark, sf_dir):
    return rounded(sp.profit_summary(spread_close_frame(spark, sf_dir), EX2, "close"))


def q_fee_clearing_summary(spark, sf_dir):
    return rounded(sp.fee_clearing_summary(spread_high_frame(spark, sf_dir)))


def q_fee_clearing_summary_by_base(spark, sf_dir):
    return rounded(sp.fee_clearing_summary(spread_high_frame(spark, sf_dir, multi_base=True), keys=("base",)))


def q_top20_spreads(spark, sf_dir, ex1=EX1, ex2=EX2):
    return rounded(sp.top_spreads(spread_close_frame(spark, sf_dir, ex1, ex2), ex1, ex2, 20, "close"))


def q_top20_spreads_by_base(spark, sf_dir):
    return rounded(sp.top_spreads_by(spread_close_frame(spark, sf_dir, multi_base=True), EX1, EX2, 20))


def q_top5_profit(spark, sf_dir):
    return rounded(sp.top_profit(spread_high_frame(spark, sf_dir), EX1, EX2, 5))


def q_spread_histogram(spark, sf_dir):
    return rounded(sp.histogram(spread_close_frame(spark, sf_dir), "price_diff_pct", 100))


def q_chart_spread_band(spark, sf_dir):
    return rounded(sp.chart_spread_band(spread_close_frame(spark, sf_dir)))


def q_chart_spread_minmax(spark, sf_dir):
    return rounded(sp.chart_spread_minmax(spread_close_frame(spark, sf_dir), 200))


def q_chart_parity(spark, sf_dir):
    return rounded(sp.chart_parity(spread_high_frame(spark, sf_dir), EX1, EX2))


def q_chart_parity_bounds(spark, sf_dir):
    return rounded(sp.chart_parity_bounds(aligned_high(spark, sf_dir), EX1, EX2))


def q_chart_profit_time(spark, sf_dir):
    return rounded(sp.chart_profit_time(spread_high_frame(spark, sf_dir)))


def q_chart_series(spark, sf_dir):
    return rounded(al.price_series(hourly_candles(spark, sf_dir, venues=CHART_VENUES), CHART_VENUES, "high"))


# A second venue pair, for the jobs registered with another pair.
OTHER = ("COINBASE", "KRAKEN")


def _other(job):
    return lambda spark, sf_dir: job(spark, sf_dir, *OTHER)


QUERIES = {
    "threshold_ladder_other_pair": _other(q_threshold_ladder),
    "top20_spreads_other_pair": _other(q_top20_spreads),
    "spread_high_other_pair": _other(q_spread_high),
    "ohlc": q_ohlc,
    "ohlc_bulk": q_ohlc_bulk,
    "ohlc_gapfill": q_ohlc_gapfill,
    "series_extent": q_series_extent,
    "trade_range": q_trade_range,
    "trade_window": q_trade_window,
    "border_trades": q_border_trades,
    "candle_stats": q_candle_stats,
    "coverage": q_coverage,
    "candle_preview": q_candle_preview,
    "wide_candles": q_wide_candles,
    "wide_candles_chain": q_wide_candles_chain,
    "wide_extent": q_wide_extent,
    "aligned_pair": q_aligned_pair,
    "spread_close": q_spread_close,
    "spread_high": q_spread_high,
    "spread_stats": q_spread_stats,
    "spread_stats_high": q_spread_stats_high,
    "spread_percentiles": q_spread_percentiles,
    "spread_percentiles_by_base": q_spread_percentiles_by_base,
    "threshold_ladder": q_threshold_ladder,
    "threshold_ladder_by_base": q_threshold_ladder_by_base,
    "profit_summary": q_profit_summary,
    "profit_summary_by_base": q_profit_summary_by_base,
    "fee_clearing_summary": q_fee_clearing_summary,
    "fee_clearing_summary_by_base": q_fee_clearing_summary_by_base,
    "top20_spreads": q_top20_spreads,
    "top20_spreads_by_base": q_top20_spreads_by_base,
    "top5_profit": q_top5_profit,
    "spread_histogram": q_spread_histogram,
    "chart_spread_band": q_chart_spread_band,
    "chart_spread_minmax": q_chart_spread_minmax,
    "chart_parity": q_chart_parity,
    "chart_parity_bounds": q_chart_parity_bounds,
    "chart_profit_time": q_chart_profit_time,
    "chart_series": q_chart_series,
}

"""Spread between two venues and its reports.

All summaries that the analysis prints are conditional aggregates over the one
aligned frame, so each report is a single pass (partial aggregation on every
partition, one tiny final merge).  Only the exact quantiles need more than one
pass (see ``quantiles``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (PROFITABLE_CUT, TOTAL_COST, TRADING_FEE, c,
                              col_name, direction, net_profit_topk, net_profit_total,
                              parity_class, pct_of, safe_div)
from ..session import reuse
from .quantiles import beside, quantiles

# Ladder rungs (percent) and reported percentiles.
LADDER = [0.1, 0.2, 0.3, 0.5, 0.8, 1.0, 1.5, 2.0]
PERCENTILES = [50, 75, 90, 95, 99, 99.9]


def spread(aligned: DataFrame, ex1: str, ex2: str, field: str = "close") -> DataFrame:
    """Adds ``price_diff``, ``price_diff_pct`` and ``abs_price_diff_pct``."""
    p1, p2 = c(col_name(ex1, field)), c(col_name(ex2, field))
    diff = p1 - p2
    return aligned.select("*", diff.alias("price_diff"),
                          pct_of(diff, p2).alias("price_diff_pct")) \
                  .withColumn("abs_price_diff_pct", F.abs("price_diff_pct"))


def spread_high(aligned: DataFrame, ex1: str, ex2: str) -> DataFrame:
    """High-basis spread with gross profit per unit and the trade direction."""
    out = spread(aligned, ex1, ex2, "high")
    return out.withColumn("profit_per_btc", F.abs("price_diff")) \
              .withColumn("arbitrage_direction", direction(F.col("price_diff"), ex1, ex2))


def spread_stats(sp: DataFrame, column: str = "price_diff_pct", keys=()) -> DataFrame:
    """count, mean, sample std, min, max of one spread column."""
    x = F.col(column)
    aggs = [F.count(x).alias("n_rows"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
    return sp.groupBy(*keys).agg(*aggs) if keys else sp.agg(*aggs)


def spread_stats_with_median(sp: DataFrame, column: str = "price_diff_pct") -> DataFrame:
    """``spread_stats`` plus the exact median.  The frame is kept between the statistics
    pass and the quantile plan."""
    sp = reuse(sp)
    return beside(spread_stats(sp, column), quantiles(sp, column, [0.5], ["median"]))


def spread_percentiles(sp: DataFrame, column: str = "abs_price_diff_pct", pcts=PERCENTILES,
                       keys=()) -> DataFrame:
    """Exact percentiles of a spread column, as one row, or one per value of ``keys``."""
    names = [f"p{str(p).replace('.', '_')}" for p in pcts]
    return quantiles(sp, column, [p / 100.0 for p in pcts], names, keys)


def threshold_ladder(sp: DataFrame, thresholds=LADDER, cost: float = TOTAL_COST,
                     column: str = "abs_price_diff_pct", keys=()) -> DataFrame:
    """For every rung: rows with ``abs >= rung``, their share (percent), and whether
    the rung clears the cost.  One aggregate (per ``keys`` group, e.g. every base at
    once), then ``stack`` to rows."""
    x = F.col(column)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(x >= F.lit(t)).alias(f"_c{i}") for i, t in enumerate(thresholds)]
    one = sp.groupBy(*keys).agg(*aggs) if keys else sp.agg(*aggs)
    pairs = ", ".join(f"{float(t)!r}D, _c{i}" for i, t in enumerate(thresholds))
    rows = one.selectExpr(*keys, "_n", f"stack({len(thresholds)}, {pairs}) AS (threshold, n_rows)")
    return rows.select(
        *keys, "threshold", "n_rows",
        (safe_div(F.col("n_rows").cast("double"), F.col("_n").cast("double")) * 100.0)
        .alias("share_pct"),
        (F.col("threshold") > F.lit(cost)).alias("profitable"))


def profit_summary(sp: DataFrame, ex2: str, field: str = "close",
                   cut: float = PROFITABLE_CUT, cost: float = TOTAL_COST, keys=()) -> DataFrame:
    """Rows with ``abs >= cost + min profit``: count, share, net profit sum/mean/max/min
    (per ``keys`` group when given)."""
    hit = F.col("abs_price_diff_pct") >= F.lit(cut)
    profit = F.when(hit, net_profit_total(F.col("abs_price_diff_pct"), c(col_name(ex2, field)), cost))
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_profitable"),
            F.sum(profit).alias("total_profit"), F.avg(profit).alias("mean_profit"),
            F.max(profit).alias("best_profit"), F.min(profit).alias("worst_profit")]
    out = sp.groupBy(*keys).agg(*aggs) if keys else sp.agg(*aggs)
    return out.select(*keys, "n_rows", "n_profitable",
             (safe_div(F.col("n_profitable").cast("double"), F.col("n_rows").cast("double")) * 100.0)
             .alias("share_pct"),
             "total_profit", "mean_profit", "best_profit", "worst_profit")


def fee_clearing_summary(sp_high: DataFrame, fee: float = TRADING_FEE, keys=()) -> DataFrame:
    """Rows with ``|pct| > fee`` (strict): count, share, mean gross profit, mean |pct|,
    best, total and total per trade (per ``keys`` group when given)."""
    hit = F.abs("price_diff_pct") > F.lit(fee)
    gross = F.when(hit, F.col("profit_per_btc"))
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_clearing"),
            F.avg(gross).alias("mean_profit"),
            F.avg(F.when(hit, F.abs("price_diff_pct"))).alias("mean_abs_pct"),
            F.max(gross).alias("best_profit"), F.sum(gross).alias("total_profit")]
    out = sp_high.groupBy(*keys).agg(*aggs) if keys else sp_high.agg(*aggs)
    return out.select(*keys, "n_rows", "n_clearing",
             (safe_div(F.col("n_clearing").cast("double"), F.col("n_rows").cast("double")) * 100.0)
             .alias("share_pct"),
             "mean_profit", "mean_abs_pct", "best_profit", "total_profit",
             safe_div(F.col("total_profit"), F.col("n_clearing").cast("double")).alias("profit_per_trade"))


def high_stats(sp_high: DataFrame) -> DataFrame:
    """Difference and percent statistics plus gross-profit mean/max (plotter report)."""
    d, p, g = F.col("price_diff"), F.col("price_diff_pct"), F.col("profit_per_btc")
    return sp_high.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(d).alias("diff_mean"), F.stddev_samp(d).alias("diff_std"),
        F.min(d).alias("diff_min"), F.max(d).alias("diff_max"),
        F.avg(p).alias("pct_mean"), F.stddev_samp(p).alias("pct_std"),
        F.min(p).alias("pct_min"), F.max(p).alias("pct_max"),
        F.avg(g).alias("profit_mean"), F.max(g).alias("profit_max"))


def top_spreads(sp: DataFrame, ex1: str, ex2: str, n: int = 20, field: str = "close",
                cost: float = TOTAL_COST) -> DataFrame:
    """The n largest ``abs`` spreads (earlier time first on ties): a top-k report."""
    p1, p2 = c(col_name(ex1, field)), c(col_name(ex2, field))
    keys = [k for k in ("base",) if k in sp.columns]
    return (sp.select(*keys, "time", p1.alias("price1"), p2.alias("price2"),
                      "abs_price_diff_pct",
                      net_profit_topk(F.col("price_diff"), p2, cost).alias("net_profit"),
                      direction(F.col("price_diff"), ex1, ex2).alias("direction"))
            .orderBy(F.col("abs_price_diff_pct").desc(), F.col("time").asc())
            .limit(n))


def top_spreads_by(sp: DataFrame, ex1: str, ex2: str, n: int = 20, field: str = "close",
                   keys=("base",), cost: float = TOTAL_COST) -> DataFrame:
    """The n largest ``abs`` spreads of every ``keys`` group (earlier time first on
    ties).  Two-level top-n, so no task ranks a whole group: the n best of every
    (group, day), then the n best of those survivors per group."""
    from pyspark.sql import Window
    p1, p2 = c(col_name(ex1, field)), c(col_name(ex2, field))
    rows = sp.select(*keys, "time", p1.alias("price1"), p2.alias("price2"), "abs_price_diff_pct",
                     net_profit_topk(F.col("price_diff"), p2, cost).alias("net_profit"),
                     direction(F.col("price_diff"), ex1, ex2).alias("direction"))
    order = [F.col("abs_price_diff_pct").desc(), F.col("time").asc()]
    day = Window.partitionBy(*keys, F.date_trunc("day", F.col("time"))).orderBy(*order)
    daily = rows.withColumn("_r", F.row_number().over(day)).where(F.col("_r") <= n).drop("_r")
    best = Window.partitionBy(*keys).orderBy(*order)
    return daily.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def top_profit(sp_high: DataFrame, ex1: str, ex2: str, n: int = 5,
               fee: float = TRADING_FEE) -> DataFrame:
    """The n largest gross profits among fee-clearing rows (top-k report)."""
    keys = [k for k in ("base",) if k in sp_high.columns]
    return (sp_high.where(F.abs("price_diff_pct") > F.lit(fee))
            .select(*keys, "time", c(col_name(ex1, "high")).alias("price1"),
                    c(col_name(ex2, "high")).alias("price2"), "profit_per_btc",
                    "price_diff_pct", "arbitrage_direction")
            .orderBy(F.col("profit_per_btc").desc(), F.col("time").asc())
            .limit(n))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Equal-width histogram like numpy's: all bins present, the last bin closed on
    the right, and a +-0.5 range when all values are equal.  The range is one
    aggregate whose two scalars become literals of the binning pass."""
    x = F.col(column)
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n_rows long")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    flo, fhi = F.lit(float(lo)), F.lit(float(hi))
    idx = F.least(F.floor((x - flo) / (fhi - flo) * bins), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    width = (fhi - flo) / bins
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    (flo + F.col("bin") * width).alias("bin_lo"),
                    (flo + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows")))


# --- chart tables ---------------------------------------------------------------------

def chart_spread_band(sp: DataFrame, cost: float = TOTAL_COST) -> DataFrame:
    keys = [k for k in ("base",) if k in sp.columns]
    return sp.select(*keys, "time", "price_diff_pct",
                     F.lit(cost).alias("band_hi"), F.lit(-cost).alias("band_lo"))


def chart_spread_minmax(sp: DataFrame, pixels: int = 2000, column: str = "price_diff_pct") -> DataFrame:
    """The spread line for long ranges: min and max per pixel-wide time bucket
    (what a line plot can show), one aggregate instead of every point."""
    keys = [k for k in ("base",) if k in sp.columns]
    t = F.unix_micros(F.col("time").cast("timestamp"))
    lo, hi = sp.agg(F.min(t), F.max(t)).first()
    spark = sp.sparkSession
    if lo is None:
        return spark.createDataFrame([], "pixel long, t_first timestamp_ntz, t_last timestamp_ntz, "
                                         "n_rows long, y_min double, y_max double")
    width = max(hi - lo, 1)
    pix = F.least(F.floor((t - F.lit(lo)) * F.lit(pixels) / F.lit(width)), F.lit(pixels - 1)).cast("long")
    return sp.groupBy(*keys, pix.alias("pixel")).agg(
        F.min("time").alias("t_first"), F.max("time").alias("t_last"),
        F.count(F.lit(1)).alias("n_rows"), F.min(column).alias("y_min"), F.max(column).alias("y_max"))


def chart_parity(sp_high: DataFrame, ex1: str, ex2: str) -> DataFrame:
    keys = [k for k in ("base",) if k in sp_high.columns]
    return sp_high.select(*keys, "time", c(col_name(ex1, "high")).alias("x"),
                          c(col_name(ex2, "high")).alias("y"),
                          parity_class(F.col("price_diff")).alias("colour"))


def chart_parity_bounds(aligned: DataFrame, ex1: str, ex2: str) -> DataFrame:
    a, b = c(col_name(ex1, "high")), c(col_name(ex2, "high"))
    return aligned.agg(F.least(F.min(a), F.min(b)).alias("axis_min"),
                       F.greatest(F.max(a), F.max(b)).alias("axis_max"))


def chart_profit_time(sp_high: DataFrame) -> DataFrame:
    keys = [k for k in ("base",) if k in sp_high.columns]
    return sp_high.select(*keys, "time", "profit_per_btc")


def label_rate(df: DataFrame, label: str = "arbitrage_opportunity", classes=(0, 1)) -> DataFrame:
    """Per class: rows and share of all rows (percent).  One conditional aggregate
    (partial on every partition), stacked to one row per class present."""
    counts = [F.count_if(F.col(label) == k).alias(f"_c{i}") for i, k in enumerate(classes)]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *counts)
    pairs = ", ".join(f"{int(k)}, _c{i}" for i, k in enumerate(classes))
    rows = one.selectExpr("_n", f"stack({len(classes)}, {pairs}) AS (label, n_rows)")
    return rows.where(F.col("n_rows") > 0).select(
        "label", "n_rows", (F.col("n_rows") * 100.0 / F.col("_n")).alias("share_pct"))

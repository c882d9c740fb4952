"""Feature table of the spread classifier."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import LABEL_CUT, c, col_name, pct_of, safe_div
from .rolling import DEFAULT_BLOCK, Roll, rolling

# Default rolling window sizes (rows) and the fields both venues need.
WINDOWS = [5, 10, 20]
FEATURE_FIELDS = ["high", "low", "close", "volume"]
LABEL = "arbitrage_opportunity"
NOT_FEATURES = ["time", LABEL, "price_diff", "price_diff_pct"]


def raw_columns(ex1: str, ex2: str) -> list[str]:
    return [col_name(v, f) for f in FEATURE_FIELDS for v in (ex1, ex2)]


def basic_features(aligned: DataFrame, ex1: str, ex2: str, cut: float = LABEL_CUT) -> DataFrame:
    """Spread on ``high``, candle ranges, volume ratio, calendar and the label."""
    h1, h2 = c(col_name(ex1, "high")), c(col_name(ex2, "high"))
    l1, l2 = c(col_name(ex1, "low")), c(col_name(ex2, "low"))
    v1, v2 = c(col_name(ex1, "volume")), c(col_name(ex2, "volume"))
    diff = h1 - h2
    pct = pct_of(diff, h2)
    return aligned.select(
        "*",
        diff.alias("price_diff"),
        pct.alias("price_diff_pct"),
        (h1 - l1).alias(f"{ex1}_spread"),
        (h2 - l2).alias(f"{ex2}_spread"),
        ((h1 - l1) - (h2 - l2)).alias("spread_diff"),
        safe_div(v1, v2 + F.lit(1e-10)).alias("volume_ratio"),
        F.hour("time").alias("hour"),
        F.minute("time").alias("minute"),
        F.weekday("time").alias("day_of_week"),
        (F.abs(pct) >= F.lit(cut)).cast("int").alias(LABEL),
    )


def rolling_specs(ex1: str, ex2: str, windows=WINDOWS) -> list[Roll]:
    s1, s2 = col_name(ex1, "close"), col_name(ex2, "close")
    out = []
    for w in windows:
        out += [Roll(f"{ex1}_ma_{w}", "mean", s1, w),
                Roll(f"{ex2}_ma_{w}", "mean", s2, w),
                Roll(f"price_diff_ma_{w}", "mean", "price_diff", w),
                Roll(f"{ex1}_volatility_{w}", "std", s1, w),
                Roll(f"{ex2}_volatility_{w}", "std", s2, w),
                Roll(f"{ex1}_momentum_{w}", "momentum", s1, w),
                Roll(f"{ex2}_momentum_{w}", "momentum", s2, w)]
    return out


def engineer(aligned: DataFrame, ex1: str, ex2: str, windows=WINDOWS, keys=("base",),
             block: int = DEFAULT_BLOCK, drop_incomplete: bool = True) -> DataFrame:
    """Aligned pair (high/low/close/volume of both) -> full feature table.

    Column order: time, raw fields, spread/pct, ranges, volume ratio, rolling,
    calendar, label.  With ``drop_incomplete`` rows with any NULL go (the lead-in
    rows of the longest window)."""
    basic = basic_features(aligned, ex1, ex2)
    specs = rolling_specs(ex1, ex2, windows)
    out = rolling(basic, list(keys), specs, block=block)
    order = ([*keys, "time"] + raw_columns(ex1, ex2)
             + ["price_diff", "price_diff_pct", f"{ex1}_spread", f"{ex2}_spread", "spread_diff",
                "volume_ratio"] + [s.name for s in specs] + ["hour", "minute", "day_of_week", LABEL])
    out = out.select(*[c(x) for x in order])
    if not drop_incomplete:
        return out
    # one predicate over an array: as 48 separate null checks it makes the optimizer's
    # constraint inference grow with their combinations
    return out.where(~F.array_contains(F.array(*[c(x).isNull() for x in order]), True))


def feature_columns(df: DataFrame, keys=("base",)) -> list[str]:
    """Every column but time, label, the spread itself and the series keys."""
    return [x for x in df.columns if x not in NOT_FEATURES and x not in keys]

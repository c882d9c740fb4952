"""Registered jobs: feature engineering for the spread classifier."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align as al
from ..operators import features as fe
from ..operators import rolling as ro
from ..operators import spread as sp
from ..operators.quantiles import beside, quantiles
from ..session import reuse
from .common import EX1, EX2, pair_candles, rounded


def aligned_features_input(spark: SparkSession, sf_dir: str, multi_base: bool = False) -> DataFrame:
    return al.align(pair_candles(spark, sf_dir, multi_base), EX1, EX2, fe.FEATURE_FIELDS)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.engineer(aligned_features_input(spark, sf_dir), EX1, EX2)


# rows per block in the registered rolling jobs: below the length of their series, so that
# every job copies halo rows between blocks
JOB_BLOCK = 128


def _rolling_kind(spark, sf_dir, kind: str) -> DataFrame:
    aligned = aligned_features_input(spark, sf_dir, multi_base=True)
    basic = fe.basic_features(aligned, EX1, EX2)
    specs = [s for s in fe.rolling_specs(EX1, EX2) if s.kind == kind]
    out = ro.rolling(basic, ["base"], specs, block=JOB_BLOCK)
    return rounded(out.select("base", "time", *[s.name for s in specs]))


def q_features_basic(spark, sf_dir):
    b = fe.basic_features(aligned_features_input(spark, sf_dir), EX1, EX2)
    return rounded(b.select("base", "time", "price_diff", "price_diff_pct", f"{EX1}_spread",
                            f"{EX2}_spread", "spread_diff", "volume_ratio", "hour", "minute",
                            "day_of_week", fe.LABEL))


def q_rolling_mean(spark, sf_dir):
    return _rolling_kind(spark, sf_dir, "mean")


def q_rolling_std(spark, sf_dir):
    return _rolling_kind(spark, sf_dir, "std")


def q_momentum(spark, sf_dir):
    return _rolling_kind(spark, sf_dir, "momentum")


def q_features_full(spark, sf_dir):
    return rounded(feature_table(spark, sf_dir))


def q_label_rate(spark, sf_dir):
    return rounded(sp.label_rate(feature_table(spark, sf_dir), fe.LABEL))


def q_feature_stage_stats(spark, sf_dir):
    """Statistics of the spread after the null drop; upper percentiles of its
    absolute value before it (as the reference reports them)."""
    aligned = reuse(aligned_features_input(spark, sf_dir))
    full = reuse(fe.engineer(aligned, EX1, EX2))
    before = fe.basic_features(aligned, EX1, EX2).select(F.abs("price_diff_pct").alias("abs_pct"))
    # one row each: the statistics, the median after and the percentiles before the null drop
    return rounded(beside(
        sp.spread_stats(full, "price_diff_pct").select("n_rows", "mean", "std", "min", "max"),
        quantiles(full, "price_diff_pct", [0.5], ["median"]),
        quantiles(before, "abs_pct", [0.75, 0.90, 0.95, 0.99], ["abs_p75", "abs_p90", "abs_p95", "abs_p99"])))


QUERIES = {
    "features_basic": q_features_basic,
    "rolling_mean": q_rolling_mean,
    "rolling_std": q_rolling_std,
    "momentum": q_momentum,
    "features_full": q_features_full,
    "label_rate": q_label_rate,
    "feature_stage_stats": q_feature_stage_stats,
}

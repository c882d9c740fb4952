"""Mergeable quantile states (KLL): one per series and day, stored once, merged for any range of days.

The exact quantiles (``quantiles``) sort every value of the range each time they are asked for.
A state is a few kilobytes whatever the day holds; states are merged by an aggregate, so a
quantile of a year reads one small row per day and no trade, candle or spread.  A value that a state
returns has a rank within ``RANK_ERROR`` of the asked one (three times the sketch's own 99 % error at
``K``); up to ``K`` values a state keeps them all and the answer is the exact one.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

K = 800  # values a state keeps before it starts to thin them out
RANK_ERROR = 0.0105  # share of the rows; 3 * 2.296 / K ** 0.9723


def daily_states(df: DataFrame, column: str, keys=(), time: str = "time", k: int = K) -> DataFrame:
    """(keys, day, n_rows, low, high, state) of a value column; NULL values and NULL times are left out."""
    x = F.col(column).cast("double")
    return (df.where(x.isNotNull() & F.col(time).isNotNull())
            .groupBy(*keys, F.col(time).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(x).alias("low"), F.max(x).alias("high"),
                 F.kll_sketch_agg_double(x, k).alias("state")))


def store_states(states: DataFrame, path: str) -> None:
    """Adds states to a table of days: the days of ``states`` replace those stored, other days stay."""
    (states.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def stored_states(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """States of the days from ``start`` to ``end`` (both kept); other days' folders are not read."""
    states = spark.read.parquet(path)
    if start is not None:
        states = states.where(F.col("day") >= F.lit(start).cast("date"))
    return states if end is None else states.where(F.col("day") <= F.lit(end).cast("date"))


def merge_states(states: DataFrame, keys=()) -> DataFrame:
    """One state per value of ``keys`` (one in all without keys)."""
    aggs = [F.sum("n_rows").alias("n_rows"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.kll_merge_agg_double("state").alias("state")]
    return states.groupBy(*keys).agg(*aggs) if keys else states.agg(*aggs)


def quantile_of(state: Column, q: float) -> Column:
    """The smallest kept value whose rank is at least ``q``."""
    return F.kll_sketch_get_quantile_double(state, F.lit(float(q)))


def sketch_quantiles(states: DataFrame, qs: list[float], names: list[str], keys=()) -> DataFrame:
    """One row per value of ``keys``: rows behind the states and their quantiles as columns ``names``."""
    merged = merge_states(states, keys)
    return merged.select(*keys, "n_rows", *[quantile_of(F.col("state"), q).alias(n) for q, n in zip(qs, names)])


def rank_errors(answers: DataFrame, values: DataFrame, column: str, qs: list[float], names: list[str], keys) -> DataFrame:
    """(keys, q, n_rows, error): how far the rank of each answer lies from ``q`` among the values themselves,
    as a share of the rows.  Equal values share a range of ranks, whose nearer end counts."""
    x = F.col(column).cast("double")
    held = values.where(x.isNotNull()).select(*keys, x.alias("_x")).join(answers.select(*keys, *names), list(keys))
    n = F.count(F.lit(1))
    one = held.groupBy(*keys).agg(n.alias("n_rows"), *[
        agg for i, name in enumerate(names) for agg in (F.count_if(F.col("_x") < F.col(name)).alias(f"_below{i}"),
                                                        F.count_if(F.col("_x") <= F.col(name)).alias(f"_upto{i}"))])
    cells = ", ".join(f"{float(q)!r}D, _below{i}, _upto{i}" for i, q in enumerate(qs))
    rows = one.selectExpr(*keys, "n_rows", f"stack({len(qs)}, {cells}) AS (q, below, upto)")
    place = F.col("q") * F.col("n_rows")
    miss = F.greatest(F.col("below") - place, place - F.col("upto"), F.lit(0.0))
    return rows.select(*keys, "q", "n_rows", (miss / F.col("n_rows")).alias("error"))


def states_path(spark: SparkSession) -> str:
    return scratch_path(spark, f"states-{uuid.uuid4().hex}")

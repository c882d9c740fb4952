"""Shared pieces of the registered jobs: the standard inputs and output rounding."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.candles import ohlc
from ..session import configure
from ..sources.tape import events_trades

# The venue pair of the analyses and the candle bucket used on the
# driver tables (hourly, so that buckets of two venues overlap at small scale).
EX1, EX2 = "BINANCE", "BITFINEX"
BUCKET = "1 hour"
DIGITS = 6
SNAP_BITS = 24


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (results are compared value by value; sums and
    standard deviations differ in the last bits with the summation order):

    1) snap to a 2^-24 grid, so sums that differ in the last bits land on one grid
       point (decimal data never sit on the grid's midpoints); 2) round to
       ``digits`` decimals, which now sees the same value in every engine; 3) add
       0.0, which turns a -0.0 into 0.0 (engines differ on the sign of a rounded
       zero).  Written as SQL text in one ``selectExpr`` (one call to build)."""
    grid, scale = f"{float(2 ** SNAP_BITS)}D", f"{float(10 ** digits)}D"
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(f"round(round({q} * {grid}) / {grid} * {scale}) / {scale} + 0.0D AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)


def trades(spark: SparkSession, sf_dir: str, multi_base: bool = False,
           venues: list[str] | None = None) -> DataFrame:
    configure(spark)
    return events_trades(spark, sf_dir, multi_base, venues)


def candles_of(trades_df: DataFrame) -> DataFrame:
    return ohlc(trades_df, BUCKET)


def hourly_candles(spark: SparkSession, sf_dir: str, multi_base: bool = False,
                   venues: list[str] | None = None) -> DataFrame:
    return candles_of(trades(spark, sf_dir, multi_base, venues))


def pair_candles(spark: SparkSession, sf_dir: str, multi_base: bool = False,
                 venues: tuple[str, str] = (EX1, EX2)) -> DataFrame:
    """Candles of the two analysed venues only (the scan reads nothing else)."""
    return hourly_candles(spark, sf_dir, multi_base, list(venues))

"""Putting venues side by side on time.

``widen`` is the N-way full outer join of all venues on ``time``: because
``(base, exchange, time)`` is unique after dedupe it is a pivot by conditional
aggregation - one shuffle on ``(base, time)`` - instead of a chain of N-1 outer
joins (outer joins cannot be reordered, so a chain is N-1 shuffles).  ``widen_chain`` is that chain, kept to
check the pivot against.  ``align`` is the two-venue inner alignment.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import c, col_name
from ..session import reuse
from .candles import CANDLE_FIELDS, series_keys

# Venue order of the wide table (also the column order).
VENUES = ["COINBASE", "BINANCE", "BITFINEX", "MEXC", "GATEIO", "KRAKEN"]


def present_venues(candles: DataFrame, venues=VENUES) -> list[str]:
    """Venues with at least one candle, in registry order.

    One small aggregate; its result is bounded by the registry size, which is
    what makes collecting it safe.
    """
    found = {r[0] for r in candles.groupBy("exchange").agg(F.count(F.lit(1))).collect()}
    return [v for v in venues if v in found]


def widen(candles: DataFrame, venues: list[str] | None = None,
          fields=CANDLE_FIELDS, keys=None) -> DataFrame:
    """Long candles -> one row per (pair, time), ``VENUE:field`` columns; the pair is base
    and, where the table has one, quote.

    Without an explicit venue list the candles are read twice (venue list, then
    pivot), so they are kept between the two reads."""
    keys = keys or tuple(k for k in series_keys(candles) if k != "exchange")
    # a NULL time never matches (rows without a time belong to the quarantine)
    candles = candles.where(F.col("time").isNotNull())
    if venues is None:
        candles = reuse(candles)
        venues = present_venues(candles)
    # (base, exchange, time) is unique, so each conditional max sees at most one
    # value: exact, one hash aggregate and one shuffle on (base, time).  (pivot()
    # would aggregate twice: by (base, time, exchange), then by (base, time).)
    cells = [F.max(F.when(F.col("exchange") == v, F.col(f))).alias(col_name(v, f))
             for v in venues for f in fields]
    return candles.groupBy(*keys, "time").agg(*cells)


def widen_chain(candles: DataFrame, venues: list[str] | None = None,
                fields=CANDLE_FIELDS, keys=("base",)) -> DataFrame:
    """The same table by folding full outer joins (reference semantics, N-1 shuffles)."""
    candles = candles.where(F.col("time").isNotNull())
    if venues is None:
        candles = reuse(candles)
        venues = present_venues(candles)
    parts = [candles.where(F.col("exchange") == v)
             .select(*keys, "time", *[F.col(f).alias(col_name(v, f)) for f in fields])
             for v in venues]
    return reduce(lambda a, b: a.join(b, [*keys, "time"], "full"), parts)


def align(candles: DataFrame, ex1: str, ex2: str, fields, keys=("base",)) -> DataFrame:
    """Rows where both venues have every chosen field (outer join + drop nulls
    == inner join + drop nulls).

    Expressed as the two-venue pivot: the candle input is read once and shuffled
    once on (base, time), instead of two reads and a join of the two slices."""
    two = candles.where(F.col("exchange").isin(ex1, ex2))
    cols = [col_name(v, f) for f in fields for v in (ex1, ex2)]
    wide = widen(two, [ex1, ex2], tuple(fields), keys)
    return wide.select(*keys, "time", *[c(x) for x in cols]).na.drop(subset=cols)


def unpivot_wide(wide: DataFrame, venues, field: str = "high", keys=("base",)) -> DataFrame:
    """Wide -> long for one field; each venue keeps only its own non-null rows."""
    present = [v for v in venues if col_name(v, field) in wide.columns]
    if not present:
        return wide.select(*keys, "time").limit(0).withColumn("exchange", F.lit(None).cast("string")) \
            .withColumn(field, F.lit(None).cast("double"))
    stacked = wide.unpivot([*keys, "time"], [col_name(v, field) for v in present],
                           "exchange", field)
    return (stacked.where(F.col(field).isNotNull())
            .select(*keys, F.regexp_replace("exchange", f":{field}$", "").alias("exchange"),
                    "time", field))


def price_series(candles: DataFrame, venues, field: str = "high", keys=("base",)) -> DataFrame:
    """One field of several venues over time from the long table, each venue with
    its own missing rows left out (the multi-venue price chart)."""
    return (candles.where(F.col("exchange").isin(list(venues)) & F.col(field).isNotNull()
                          & F.col("time").isNotNull())
            .select(*keys, "exchange", "time", field))

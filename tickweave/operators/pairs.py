"""Every pair of venues in one job: the pair is data and a grouping key, not a parameter.

The candles are pivoted once on (base, time); each row then gives the pairs of the venues it
holds, at most n(n-1)/2 for n registered venues.  All reports group by the pair, so one
shuffle of the candles serves all of them.
"""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import c, col_name
from .align import VENUES, widen
from .candles import series_keys

# the two sides of a pair are named so that the reports of ``spread`` read them as venues
FIRST, SECOND = "EX1", "EX2"
PAIR = ("ex1", "ex2")


def venue_pairs(candles: DataFrame, fields, venues=VENUES, keys=None) -> DataFrame:
    """(keys, time, ex1, ex2, EX1:field..., EX2:field...): a row per time and pair of venues that both have every
    chosen field; ``ex1`` stands before ``ex2`` in registry order.  Venues outside the registry take no part."""
    keys = tuple(keys or (k for k in series_keys(candles) if k != "exchange"))
    wide = widen(candles, list(venues), tuple(fields), keys)

    def side(venue, name):
        return [c(col_name(venue, f)).alias(col_name(name, f)) for f in fields]
    rows = [F.when(F.coalesce(*[F.when(c(col_name(v, f)).isNull(), F.lit(False)) for v in (a, b) for f in fields], F.lit(True)),
                   F.struct(F.lit(a).alias("ex1"), F.lit(b).alias("ex2"), *side(a, FIRST), *side(b, SECOND)))
            for a, b in combinations(venues, 2)]
    return wide.select(*keys, "time", F.explode(F.filter(F.array(*rows), lambda p: p.isNotNull())).alias("p")).select(
        *keys, "time", "p.*")


def pair_direction(diff: Column) -> Column:
    """What to sell and what to buy, from the pair's own venues (a zero difference sells the second)."""
    return F.when(diff > 0, F.concat(F.lit("SELL "), "ex1", F.lit(", BUY "), "ex2")).otherwise(
        F.concat(F.lit("SELL "), "ex2", F.lit(", BUY "), "ex1"))

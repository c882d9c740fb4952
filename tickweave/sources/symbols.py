"""Pair names per venue, the trade-venue asset alias, and catalogue lookup."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Asset aliases of the trade venue (unknown assets map to themselves).
KRAKEN_ALIAS = [("BTC", "XBT"), ("ETH", "ETH"), ("DOGE", "DOG"), ("USD", "USD"),
                ("USDT", "USD"), ("EUR", "EUR")]


def split_pair(pair: Column) -> tuple[Column, Column]:
    parts = F.split(pair, "/")
    return F.get(parts, 0), F.get(parts, 1)


def _alias(asset: Column) -> Column:
    up = F.upper(asset)
    out = None
    for src, dst in KRAKEN_ALIAS:
        out = F.when(up == src, F.lit(dst)) if out is None else out.when(up == src, F.lit(dst))
    return out.otherwise(up)


def kraken_symbol(base: Column, quote: Column) -> Column:
    return F.concat(_alias(base), _alias(quote))


# The venue whose symbol is looked up in its list of pairs, and its prefix.
LISTED_VENUE, LISTED_PREFIX = "BITFINEX", "t"


def venue_symbol(exchange: Column, base: Column, quote: Column) -> Column:
    """The symbol a venue is asked for (NULL for the venue whose pairs are looked up)."""
    usdt = F.when(quote == "USD", F.lit("USDT")).otherwise(quote)
    return (F.when(exchange == "BINANCE", F.concat(base, usdt))
            .when(exchange == "COINBASE", F.concat(base, F.lit("-"), quote))
            .when(exchange == "GATEIO", F.concat(base, F.lit("_"), usdt))
            .when(exchange == "MEXC", F.concat(base, quote, F.lit("T")))
            .when(exchange == "KRAKEN", kraken_symbol(base, quote)))


def symbol_map(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``requests`` has exchange and pair ('BTC/USD') -> base, quote and the symbol
    the venue is asked for.  One venue's symbol is its listed pair (``catalogue``, see
    ``lookup_pairs``) with a prefix, NULL where the pair is not listed."""
    base, quote = split_pair(F.col("pair"))
    parts = requests.select("exchange", "pair", base.alias("base"), quote.alias("quote"))
    listed = F.col("exchange") == LISTED_VENUE
    built = parts.where(~listed).withColumn(
        "symbol", venue_symbol(F.col("exchange"), F.col("base"), F.col("quote")))
    asked = parts.where(listed)
    found = lookup_pairs(asked.select("exchange", "base", "quote").distinct(), catalogue)
    looked_up = asked.join(found.select("exchange", "base", "quote", "symbol"), ["exchange", "base", "quote"], "left")
    return (built.unionByName(looked_up.select(built.columns))
            .select("exchange", "base", "quote", "pair", "symbol"))


def clean_list(text: Column) -> Column:
    """'btc, eth,,doge ' -> ['BTC', 'ETH', 'DOGE']"""
    items = F.transform(F.split(F.upper(text), ","), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def lookup_pairs(requested: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Find each requested (venue, base, quote) in the venue's catalogue.

    Candidates in priority order: BITFINEX ``BASEQUOTE`` then ``BASE:QUOTE``;
    KRAKEN the aliased ``BASEQUOTE`` then the reversed pair, compared without case.
    The catalogue is a dimension of listed names (``exchange, name, symbol``); the
    first candidate found wins, unmatched requests keep a NULL symbol.
    """
    b, q = F.upper("base"), F.upper("quote")
    cands = F.when(F.col("exchange") == "BITFINEX",
                   F.array(F.concat(b, q), F.concat(b, F.lit(":"), q))) \
        .when(F.col("exchange") == "KRAKEN",
              F.array(kraken_symbol(F.col("base"), F.col("quote")),
                      kraken_symbol(F.col("quote"), F.col("base")))) \
        .otherwise(F.array(venue_symbol(F.col("exchange"), F.col("base"), F.col("quote"))))
    req = requested.select("exchange", "base", "quote",
                           F.posexplode(cands).alias("prio", "candidate"))
    cat = catalogue.select(F.col("exchange").alias("_ex"), F.upper("name").alias("_name"),
                           F.col("symbol").alias("_symbol"))
    hit = req.join(cat, (req["exchange"] == cat["_ex"]) & (F.upper(req["candidate"]) == cat["_name"]), "left")
    best = Window.partitionBy("exchange", "base", "quote").orderBy(
        F.col("_symbol").isNull(), F.col("prio"))
    ranked = hit.select("exchange", "base", "quote", "_symbol", F.row_number().over(best).alias("_r"))
    return ranked.where(F.col("_r") == 1).select("exchange", "base", "quote",
                                                 F.col("_symbol").alias("symbol"),
                                                 F.col("_symbol").isNotNull().alias("supported"))


def catalogue_frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "exchange string, name string, symbol string")

"""The trade tape: driver tables mapped onto the canonical trade schema.

``events`` plays the raw trade feed: every event is one trade on one venue.
``lineitem`` can serve as bulk input for scale tests.  Both mappings are plain
projections, so the parquet scan keeps its column pruning and filter pushdown.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event type -> venue.  GATEIO gets no rows on purpose (a venue
# with no data must simply be absent from the wide table).
EVENT_VENUE = [
    ("view", "BINANCE"),
    ("click", "BITFINEX"),
    ("purchase", "COINBASE"),
    ("signup", "KRAKEN"),
    ("error", "MEXC"),
]

# user_id % 3 -> base asset for the multi-series tape.
MULTI_BASES = ["BTC", "ETH", "DOGE"]

TRADE_COLUMNS = ["base", "exchange", "ts", "seq", "price", "volume"]


def _venue(event_type: Column) -> Column:
    out = None
    for kind, venue in EVENT_VENUE:
        out = (F.when(event_type == kind, F.lit(venue)) if out is None
               else out.when(event_type == kind, F.lit(venue)))
    return out


def events_trades(spark: SparkSession, sf_dir: str, multi_base: bool = False,
                  venues: list[str] | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """``events`` as trades: base, exchange, ts, seq, price, volume (and raw columns ``extra``).

    ``venues`` keeps only those venues, as a filter on the raw ``event_type`` column
    so that it reaches the parquet scan (a filter on the mapped venue would not)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    if venues is not None:
        kinds = [k for k, v in EVENT_VENUE if v in venues]
        ev = ev.where(F.col("event_type").isin(kinds))
    if multi_base:
        base = F.element_at(F.array(*[F.lit(b) for b in MULTI_BASES]),
                            (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int"))
    else:
        base = F.lit("BTC")
    return ev.select(
        base.alias("base"),
        _venue(F.col("event_type")).alias("exchange"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        (F.lit(100.0) + F.col("value") / F.lit(100.0)).alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        *extra,
    )


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a bulk trade feed (scale tests): price per unit on the ship date.
    ``place`` is the feed's order (day, line key, line price in cents, quantity) as one number."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    venues = F.array(*[F.lit(v) for _, v in EVENT_VENUE])
    return li.select(
        F.lit("BTC").alias("base"),
        F.element_at(venues, (F.pmod(F.col("l_suppkey"), F.lit(len(EVENT_VENUE))) + 1)
                     .cast("int")).alias("exchange"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("volume"),
        F.expr("""CAST(unix_date(CAST(l_shipdate AS DATE)) AS DECIMAL(6,0)) * CAST('10000000000000000000000000000000' AS DECIMAL(32,0))
                  + CAST(l_orderkey * 8 + l_linenumber AS DECIMAL(18,0)) * CAST('10000000000000' AS DECIMAL(14,0))
                  + CAST(round(l_extendedprice * 100) AS DECIMAL(10,0)) * 1000
                  + CAST(l_quantity AS DECIMAL(3,0))""").alias("place"),
    )


# --- matching SQL (DuckDB dialect) for the oracle ---------------------------------

def sql_events_trades(multi_base: bool = False) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_VENUE)
    if multi_base:
        base = ("CASE user_id % 3 " + " ".join(
            f"WHEN {i} THEN '{b}'" for i, b in enumerate(MULTI_BASES)) + " END")
    else:
        base = "'BTC'"
    return (f"SELECT {base} AS base, CASE event_type {cases} END AS exchange, ts, "
            f"event_id AS seq, 100.0::DOUBLE + value / 100.0::DOUBLE AS price, "
            f"CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume FROM events")


def sql_lineitem_trades() -> str:
    venues = ", ".join(f"'{v}'" for _, v in EVENT_VENUE)
    return (f"SELECT 'BTC' AS base, [{venues}][l_suppkey % {len(EVENT_VENUE)} + 1] AS exchange, "
            "CAST(l_shipdate AS TIMESTAMP) AS ts, l_orderkey * 8 + l_linenumber AS seq, "
            "l_extendedprice / nullif(l_quantity, 0) AS price, l_quantity AS volume, l_extendedprice AS e FROM lineitem")

"""Landed exchange payloads -> candle / trade tables.

A landed page is one raw response body kept as text, with the request it
answered: ``exchange, base, quote, pair, chunk_no, page_no, payload``.  Decoding
is one scan over all pages of all venues: the page is parsed once with ``from_json``,
its rows are exploded, and fields are picked by position from a small layout
table (one row per venue), so a new venue is a new layout row, not new code.

A body that is a list but holds something else than rows is taken apart element by element
(``VARIANT``): its rows are good, each other element is one rejected row.

Nothing is lost on the way: every row of ``candle_rows``/``trade_rows`` is either good or
carries a reject reason and its raw text.  A page that does not parse (error object,
garbage, truncated text, flat array, NULL) or whose venue has no layout is one such row;
an empty page is a row with status ``empty`` and nothing to decode.  ``decode_*`` keep the
good rows, ``quarantine*`` the rejected ones and ``load_status`` counts both.
"""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import epoch_to_ntz, floor_time, micros_to_ntz, nan_to_null
from ..operators.candles import load_order


# Field positions of each venue's candle rows, the epoch unit of the
# time field and the number of fields a row carries.
CANDLE_LAYOUTS = [
    # exchange,  time, unit, open, high, low, close, volume, n_fields
    ("BINANCE", 0, "ms", 1, 2, 3, 4, 5, 12),
    ("BITFINEX", 0, "ms", 1, 3, 4, 2, 5, 6),
    ("COINBASE", 0, "s", 3, 2, 1, 4, 5, 6),
    ("GATEIO", 0, "s", 5, 3, 4, 2, 1, 8),
    ("MEXC", 0, "ms", 1, 2, 3, 4, 5, 8),
]
LAYOUT_SCHEMA = ("_layout string, t_pos int, unit string, o_pos int, h_pos int, l_pos int, "
                 "c_pos int, v_pos int, n_fields int")
# Trade rows of the trade endpoint are price, volume, time, ... and the
# trade id at position 6 when present.
TRADE_PRICE, TRADE_VOLUME, TRADE_TIME, TRADE_ID = 0, 1, 2, 6

ROWS = "array<array<string>>"
TRADE_BODY = "struct<error:array<string>,result:map<string,string>>"
# a landed page as stored: one JSON object per line, folders per venue
PAGE_SCHEMA = ("base string, quote string, pair string, chunk_no int, page_no int, "
               "payload string, layout string, exchange string")


def write_pages(pages: DataFrame, path: str) -> None:
    """Landed pages as JSON lines, one folder per venue (``exchange=...``)."""
    pages.write.mode("overwrite").partitionBy("exchange").json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages back, with an explicit schema (no inference pass over the
    bodies); a filter on ``exchange`` reads only that venue's folder."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


def _layout_of(layout: Column) -> Column:
    """Field positions of a venue's rows: a lookup in a literal map built from the
    registry (no join; NULL for a venue without a candle layout)."""
    names = LAYOUT_SCHEMA.replace(" string", "").replace(" int", "").split(", ")[1:]
    entries = []
    for row in CANDLE_LAYOUTS:
        entries += [F.lit(row[0]), F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row[1:])])]
    return F.create_map(*entries)[layout]


def _num(arr: Column, pos: Column | int) -> Column:
    idx = pos if isinstance(pos, Column) else F.lit(pos)
    return nan_to_null(F.get(arr, idx).try_cast("double"))


def _bad_number(arr: Column, pos: Column) -> Column:
    """Text present but not a number."""
    raw = F.get(arr, pos)
    return raw.isNotNull() & raw.try_cast("double").isNull()


PAGE_REJECTS = ("bad_page", "unknown_layout")


def _elements(text: Column) -> Column:
    """The elements of a JSON list as (row, raw): a list element is a row, anything else only its own text.
    NULL for a body that is no list or holds no row at all."""
    plain = F.transform(F.from_json(text, ROWS), lambda r: F.struct(r.alias("row"), F.lit(None).cast("string").alias("raw")))

    def element(v: Column) -> Column:
        row = F.try_variant_get(v, "$", "array<string>")
        # a JSON null is an empty row, as in a body that parses as a whole
        return F.struct(row.alias("row"), F.when(row.isNull() & ~F.is_variant_null(v), F.to_json(v)).alias("raw"))
    loose = F.transform(F.try_variant_get(F.try_parse_json(text), "$", "array<variant>"), element)
    return F.coalesce(plain, F.when(F.exists(loose, lambda e: e["row"].isNotNull()), loose))


def _exploded(pages: DataFrame, text: Column, unknown: Column, *extra: Column) -> DataFrame:
    """One row per element of every page (one for an empty or rejected page): the page
    columns, ``pos``, ``row``, ``raw_element``, ``page_reject`` and the raw body of rejected pages."""
    reject = F.when(unknown, F.lit("unknown_layout")).when(F.col("_rows").isNull(), F.lit("bad_page"))
    parsed = (pages.select("*", F.when(~unknown, _elements(text)).alias("_rows"), *extra)
              .withColumn("page_reject", reject)
              .withColumn("raw_page", F.when(F.col("page_reject").isNotNull(), F.col("payload"))))
    keep = [c for c in parsed.columns if c not in ("payload", "_rows")]
    return (parsed.select(*keep, F.posexplode_outer("_rows").alias("pos", "_element"))
            .select(*keep, "pos", F.col("_element.row").alias("row"), F.col("_element.raw").alias("raw_element")))


def _status(rows: DataFrame, reason: Column, unusable: Column) -> DataFrame:
    """Adds ``status`` (ok, empty, rejected), ``reject_reason`` and ``raw_row``."""
    why = F.coalesce(F.col("page_reject"), F.when(F.col("raw_element").isNotNull(), F.lit("bad_element")),
                     F.when(F.col("pos").isNotNull(), reason))
    return rows.select(
        "*", F.when(why.isNotNull(), F.lit("rejected")).when(F.col("pos").isNull(), F.lit("empty"))
        .otherwise(F.lit("ok")).alias("status"), why.alias("reject_reason"),
        F.when(why.isNotNull(), F.coalesce("raw_page", "raw_element", unusable)).alias("raw_row"))


def candle_rows(pages: DataFrame, layout_col: str = "exchange", bucket_secs: int = 60) -> DataFrame:
    """Every element of every candle page with its fields, status and reject reason."""
    lay, r = F.col("_lay"), F.col("row")
    rows = _exploded(pages, F.col("payload"), _layout_of(F.col(layout_col)).isNull(),
                     _layout_of(F.col(layout_col)).alias("_lay"))
    t = epoch_to_ntz(F.get(r, lay["t_pos"]), lay["unit"])
    fields = {"open": "o_pos", "high": "h_pos", "low": "l_pos", "close": "c_pos", "volume": "v_pos"}
    bad_number = reduce(or_, [_bad_number(r, lay[p]) for p in fields.values()])
    reason = (F.when(r.isNull(), F.lit("null_row"))
              .when(F.size(r) < lay["n_fields"], F.lit("short_row"))
              .when(t.isNull(), F.lit("bad_time"))
              .when(bad_number, F.lit("bad_number")))
    out = _status(rows, reason, F.to_json("row"))
    return out.select(*[c for c in out.columns if c not in ("_lay", "row", "raw_element", "page_reject", "raw_page")],
                      floor_time(t, bucket_secs).alias("time"),
                      *[_num(r, lay[p]).alias(name) for name, p in fields.items()])


def _carried(pages: DataFrame) -> list[str]:
    return ["base", *(["quote"] if "quote" in pages.columns else []), "exchange"]


def decode_candles(pages: DataFrame, layout_col: str = "exchange", keep_order: bool = True,
                   carry=()) -> DataFrame:
    """Good candle rows of all pages: base, quote (where pages name it), exchange, time,
    open..volume, plus the load order ``chunk_no, page_no, pos`` (for keep-first dedupe)
    when ``keep_order`` and any page columns named in ``carry``."""
    good = candle_rows(pages, layout_col).where(F.col("status") == "ok")
    order = ["chunk_no", "page_no", "pos"] if keep_order else []
    return good.select(*carry, *_carried(pages), "time", "open", "high", "low", "close", "volume", *order)


def quarantine(pages: DataFrame, layout_col: str = "exchange") -> DataFrame:
    """What cannot be used, with the reason and the raw text (of the row, or of the page
    when the page as a whole is rejected; ``pos`` is NULL then)."""
    return _rejected(candle_rows(pages, layout_col), pages)


def _rejected(rows: DataFrame, pages: DataFrame) -> DataFrame:
    return rows.where(F.col("status") == "rejected").select(
        *_carried(pages), "chunk_no", "page_no", "pos", "reject_reason", "raw_row")


def status_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Pages by status, rows decoded and rows rejected, from ``candle_rows``/``trade_rows``."""
    page = F.coalesce(F.col("pos"), F.lit(0)) == 0  # the row that stands for its page
    return rows.groupBy(*keys).agg(
        F.count_if(page).alias("n_pages"),
        F.count_if(F.col("reject_reason").isin(*PAGE_REJECTS)).alias("n_bad_pages"),
        F.count_if(F.col("status") == "empty").alias("n_empty_pages"),
        F.count_if(F.col("status") == "ok").alias("n_rows"),
        F.count_if((F.col("status") == "rejected") & F.col("pos").isNotNull()).alias("n_rejected"))


def load_status(pages: DataFrame, layout_col: str = "exchange") -> DataFrame:
    """Per venue and base: pages by status, rows decoded and rows rejected (one pass)."""
    return status_counts(candle_rows(pages, layout_col), "exchange", "base")


def trade_rows(pages: DataFrame) -> DataFrame:
    """Every trade of every trade-endpoint body (an object whose ``result.<pair>`` holds the
    rows) with its fields, status and reject reason.  ``seq`` is the trade id, NULL where the
    row carries none."""
    body = F.from_json("payload", TRADE_BODY)
    rows = _exploded(pages, body.getField("result")[F.col("pair")], F.lit(False))
    r = F.col("row")
    ts = micros_to_ntz(F.get(r, F.lit(TRADE_TIME)).try_cast("double") * F.lit(1_000_000.0))
    bad_number = _bad_number(r, F.lit(TRADE_PRICE)) | _bad_number(r, F.lit(TRADE_VOLUME))
    reason = (F.when(r.isNull(), F.lit("null_row")).when(ts.isNull(), F.lit("bad_time"))
              .when(bad_number, F.lit("bad_number")))
    out = _status(rows, reason, F.to_json("row"))
    return out.select(*[c for c in out.columns if c not in ("row", "raw_element", "page_reject", "raw_page")],
                      ts.alias("ts"), F.get(r, F.lit(TRADE_ID)).try_cast("long").alias("seq"),
                      _num(r, TRADE_PRICE).alias("price"), _num(r, TRADE_VOLUME).alias("volume"))


def decode_trades(pages: DataFrame) -> DataFrame:
    """Good trades of all pages, each once: base, quote (where pages name it), exchange, ts,
    seq, price, volume.

    Neighbouring chunks share their end point, so a border trade can arrive twice.  With a
    trade id, equal ids are one trade.  Without, trades equal in time, price and volume are
    one trade as often as the page that has most of them says (their occurrence inside the
    page is part of the key), and ``seq`` counts the trades of one time stamp in load order.  Of copies
    that share an id but differ, the first in load order counts."""
    keys = _carried(pages)
    good = trade_rows(pages).where(F.col("status") == "ok")
    nth = Window.partitionBy(*keys, "chunk_no", "page_no", "ts", "price", "volume").orderBy("pos")
    place = load_order()
    with_id = good.where(F.col("seq").isNotNull()).withColumn("_ord", place).groupBy(*keys, "seq").agg(
        *[F.min_by(v, "_ord").alias(v) for v in ("ts", "price", "volume")])
    once = (good.where(F.col("seq").isNull()).withColumn("nth", F.row_number().over(nth))
            .groupBy(*keys, "ts", "price", "volume", "nth").agg(F.min(place).alias("_ord")))
    # trades of one time stamp keep their load order; only they need a number that tells them apart
    together = Window.partitionBy(*keys, "ts").orderBy("_ord", "price", "volume", "nth")
    without = once.withColumn("seq", F.row_number().over(together).cast("long"))
    columns = [*keys, "ts", "seq", "price", "volume"]
    return with_id.select(*columns).unionByName(without.select(*columns))


def quarantine_trades(pages: DataFrame) -> DataFrame:
    """Trades and trade pages that cannot be used, with the reason and the raw text."""
    return _rejected(trade_rows(pages), pages)


def trade_load_status(pages: DataFrame) -> DataFrame:
    """``load_status`` of trade pages (rows before border copies are merged)."""
    return status_counts(trade_rows(pages), "exchange", "base")

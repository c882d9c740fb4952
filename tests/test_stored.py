"""Stored tables, ledgers, salvage, sketches, holes and venue pairs on hand-made rows."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickweave.operators import align as al
from tickweave.operators import holes as ho
from tickweave.operators import pairs as pr
from tickweave.operators import sketches as sk
from tickweave.sources import bucketed as bk
from tickweave.sources import files as fl
from tickweave.sources import increment as inc
from tickweave.sources import ledger as lg
from tickweave.sources import order as od
from tickweave.sources import payloads as pl

CANDLE = "base string, exchange string, time timestamp_ntz, open double, high double, low double, close double, volume double"


def at(day, hour=0, minute=0, year=2024):
    return dt.datetime(year, 1, 1, hour, minute) + dt.timedelta(days=day - 1)


def candle(exchange, time, price, base="BTC"):
    return (base, exchange, time, price, price, price, price, 1.0)


# quantile states ----------------------------------------------------------------------------

def test_merged_states_keep_the_rank_bound(spark, tmp_path):
    rng = random.Random(2)
    rows = [(("a", "b")[k % 3 == 0], at(1 + k % 40, k % 24), rng.lognormvariate(0, 3) if k % 10 else 5.0) for k in range(60_000)]
    df = spark.createDataFrame(rows, "base string, time timestamp_ntz, x double")
    path = str(tmp_path / "states")
    sk.store_states(sk.daily_states(df, "x", ["base"]), path)
    qs, names = [0.0, 0.01, 0.5, 0.9, 0.999, 1.0], [f"q{i}" for i in range(6)]
    answers = sk.sketch_quantiles(sk.stored_states(spark, path), qs, names, ["base"])
    errors = sk.rank_errors(answers, df, "x", qs, names, ["base"]).collect()
    assert len(errors) == 12 and all(r.error <= sk.RANK_ERROR for r in errors)
    assert {r.n_rows for r in errors} == {20_000, 40_000}
    # a wrong answer is found out
    wrong = answers.withColumn("q2", F.col("q2") * 2)
    assert any(r.error > sk.RANK_ERROR for r in sk.rank_errors(wrong, df, "x", qs, names, ["base"]).collect())


def test_states_of_a_range_read_only_its_days_and_small_days_are_exact(spark, tmp_path):
    df = spark.createDataFrame([("a", at(d), float(d * 10 + k)) for d in (1, 2, 3) for k in range(3)] + [("a", at(2), None), ("a", None, 1.0)],
                               "base string, time timestamp_ntz, x double")
    path = str(tmp_path / "states")
    sk.store_states(sk.daily_states(df, "x", ["base"]), path)
    day = spark.createDataFrame([("a", at(2), 100.0)], df.schema)
    sk.store_states(sk.daily_states(day, "x", ["base"]), path)  # the day is replaced, the others stay
    some = sk.stored_states(spark, path, dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()
    assert sk.sketch_quantiles(some, [0.5, 1.0], ["m", "top"]).collect() == [(4, 31.0, 100.0)]
    assert sk.sketch_quantiles(sk.stored_states(spark, path), [0.5], ["m"], ["base"]).collect() == [("a", 7, 30.0)]


# loads that add up -----------------------------------------------------------------------------

def stored(spark, path):
    return sorted((r.exchange, r.base, str(r.time), r.close) for r in inc.read_increments(spark, path).collect())


def test_a_load_adds_and_never_changes(spark, tmp_path):
    path = str(tmp_path / "series")
    first = [candle("X", at(1, h), 1.0 + h) for h in range(3)] + [candle("Y", at(2, 1), 7.0), candle("X", None, 9.0)]
    inc.upsert_series(spark.createDataFrame(first, CANDLE), path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "series").rglob("*.parquet")}
    second = [candle("X", at(1, 2), 50.0), candle("X", at(1, 3), 4.0), candle("X", at(5, 0), 5.0), candle("X", at(5, 0), 6.0),
              candle("Y", at(2, 1), 70.0), candle("X", at(1, 0), 1.0, base="ETH")]
    for _ in range(2):  # the second time it adds nothing
        inc.upsert_series(spark.createDataFrame(second, CANDLE).repartition(3), path)
        want = [("X", "BTC", at(1, h), 1.0 + h) for h in range(4)] + [("X", "BTC", at(5, 0), 5.0), ("X", "ETH", at(1, 0), 1.0), ("Y", "BTC", at(2, 1), 7.0)]
        assert stored(spark, path) == sorted((e, b, str(t), x) for e, b, t, x in want)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "series").rglob("*.parquet")}
    # the folder of Y gained nothing and kept its file
    untouched = [f for f in before if "exchange=Y" in str(f)]
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert not any(f in after for f in before if "exchange=X" in str(f) and "period=2024-01-01" in str(f))
    inc.upsert_series(spark.createDataFrame([], CANDLE), path)
    assert len(stored(spark, path)) == 7


def test_a_load_with_its_order_keeps_the_first_chunk(spark, tmp_path):
    rows = [(*candle("X", at(1), 2.0), 2, 0, 0), (*candle("X", at(1), 1.0), 1, 3, 9)]
    path = str(tmp_path / "series")
    inc.upsert_series(spark.createDataFrame(rows, CANDLE + ", chunk_no int, page_no int, pos int"), path, grain="month")
    assert stored(spark, path) == [("X", "BTC", str(at(1)), 1.0)] and (tmp_path / "series/exchange=X/base=BTC/period=2024-01").exists()


def test_wide_loads_fill_empty_cells_and_bring_venues(spark, tmp_path):
    path, schema = str(tmp_path / "wide"), "base string, time timestamp_ntz, `X:close` double"
    inc.upsert_wide(spark.createDataFrame([("BTC", at(1), 1.0), ("BTC", at(2), None), ("BTC", at(9), 9.0)], schema), path)
    inc.upsert_wide(spark.createDataFrame([("BTC", at(1), 10.0, 3.0), ("BTC", at(2), 2.0, None), ("BTC", None, 1.0, 1.0)],
                                          schema + ", `Y:close` double"), path)
    got = sorted((str(r.time), r["X:close"], r["Y:close"]) for r in inc.read_increments(spark, path).collect())
    assert got == [(str(at(1)), 1.0, 3.0), (str(at(2)), 2.0, None), (str(at(9)), 9.0, None)]


# ledger and salvage --------------------------------------------------------------------------------

PAGE = "exchange string, base string, quote string, pair string, chunk_no int, page_no int, payload string"


def candles_json(*times):
    return "[" + ",".join(f"[{t},1,2,3,4,5]" for t in times) + "]"


def page(chunk, no, payload, exchange="COINBASE"):
    return (exchange, "BTC", "USD", "BTC/USD", chunk, no, payload)


def test_ledger_states(spark):
    pages = spark.createDataFrame([
        page(0, 0, candles_json(60, 120)), page(0, 1, candles_json(180)),          # whole
        page(1, 0, "[]"),                                                          # answered, empty
        page(3, 0, candles_json(60, 120)), page(3, 1, "<html>"),                    # second page broken
        page(4, 0, candles_json(60, 120)), page(4, 2, candles_json(60)),            # hole between pages
        page(5, 0, candles_json(60, 120)),                                         # last page full
        page(6, 0, "oops"), page(6, 0, candles_json(60)),                          # asked again: the good copy counts
        page(7, 0, candles_json(60, 120)), page(7, 1, "[]")], PAGE)                # full, then an empty page
    plan = spark.createDataFrame([("COINBASE", "BTC", k) for k in range(8)], "exchange string, base string, chunk_no int")
    got = {r.chunk_no: (r.status, r.resume_page, r.n_rows) for r in lg.ledger(plan, pages, page_limit=2).collect()}
    assert got == {0: ("landed", None, 3), 1: ("empty", None, 0), 2: ("missing", 0, 0), 3: ("rejected", 1, 2), 4: ("page_gap", 1, 3),
                   5: ("open_end", 1, 2), 6: ("landed", None, 1), 7: ("landed", None, 2)}
    again = lg.requests_again(plan, pages, page_limit=2).collect()
    assert {r.chunk_no for r in again} == {2, 3, 4, 5}
    assert {r.status for r in lg.ledger(plan, pages.limit(0)).collect()} == {"missing"}


def test_a_bad_element_rejects_one_row(spark):
    good = '[60,"1.5",2,3,4,5]'
    pages = spark.createDataFrame([
        page(0, 0, f'[{good},"oops",{good}]'), page(1, 0, f'[{good},{{"a":[1]}},null,7,[8]]'), page(2, 0, '["error","limit"]'),
        page(3, 0, '[["x"'), page(4, 0, '{"code":1}'), page(5, 0, None), page(6, 0, "[]")], PAGE)
    rows = pl.candle_rows(pages)
    by = {}
    for r in rows.collect():
        by.setdefault(r.chunk_no, []).append((r.pos, r.status, r.reject_reason, r.raw_row))
    assert sorted(by[0]) == [(0, "ok", None, None), (1, "rejected", "bad_element", '"oops"'), (2, "ok", None, None)]
    assert [x[1:3] for x in sorted(by[1])] == [("ok", None), ("rejected", "bad_element"), ("rejected", "null_row"), ("rejected", "bad_element"),
                                               ("rejected", "short_row")]
    assert sorted(by[1])[1][3] == '{"a":[1]}' and sorted(by[1])[3][3] == "7"
    assert all(by[k][0][2] == "bad_page" for k in (2, 3, 4, 5)) and by[6][0][1] == "empty"
    assert [r.low for r in pl.decode_candles(pages).collect()] == [1.5] * 3
    assert pl.quarantine(pages).count() == 1 + 4 + 4


def test_trades_are_salvaged_and_far_pages_keep_their_order(spark):
    body = '{"error":[],"result":{"P":[%s]}}'
    tick = '["%s","1",60.5,"b","l",""]'
    pages = spark.createDataFrame([
        ("KRAKEN", "BTC", "USD", "P", 0, 20_000, body % (tick % "2.0")), ("KRAKEN", "BTC", "USD", "P", 0, 9_999, body % f'"x",{tick % "1.0"},17'),
        ("KRAKEN", "BTC", "USD", "P", 1, 0, body % (tick % "3.0"))], PAGE)
    got = pl.decode_trades(pages).orderBy("seq").collect()
    assert [(r.seq, r.price) for r in got] == [(1, 1.0), (2, 2.0), (3, 3.0)]  # chunk, then page, however high its number
    assert pl.quarantine_trades(pages).count() == 2


def test_copies_of_one_trade_id_are_not_mixed(spark):
    row = '["%s","%s",60,"b","l","",7]'
    pages = spark.createDataFrame([
        ("KRAKEN", "BTC", "USD", "P", 1, 0, '{"result":{"P":[%s]}}' % (row % ("9.0", "1.0"))),
        ("KRAKEN", "BTC", "USD", "P", 0, 0, '{"result":{"P":[%s]}}' % (row % ("1.0", "9.0")))], PAGE)
    assert [(r.price, r.volume) for r in pl.decode_trades(pages).collect()] == [(1.0, 9.0)]


# holes --------------------------------------------------------------------------------------------------

def test_holes_inside_days_between_days_and_between_years(spark):
    times = [at(1, 0), at(1, 1), at(1, 4), at(1, 4), at(2, 0), at(10, 5), at(3, 0, year=2031), None]
    candles = spark.createDataFrame([candle("X", t, 1.0) for t in times] + [candle("Y", at(1), 1.0), candle("Z", at(1), 1.0), candle("Z", at(1, 1), 1.0)],
                                    CANDLE).repartition(4)
    got = sorted((r.exchange, str(r.hole_start), str(r.hole_end), r.n_buckets) for r in ho.holes(candles, "1 hour").collect())

    def hole(a, b):
        return "X", str(a + dt.timedelta(hours=1)), str(b - dt.timedelta(hours=1)), int((b - a).total_seconds() // 3600) - 1
    assert got == sorted([hole(at(1, 1), at(1, 4)), hole(at(1, 4), at(2, 0)), hole(at(2, 0), at(10, 5)), hole(at(10, 5), at(3, 0, year=2031))])
    assert ho.holes(candles.limit(0), "1 hour").count() == 0


# venue pairs -----------------------------------------------------------------------------------------------

def test_pairs_equal_every_two_venue_alignment(spark):
    rng = random.Random(6)
    rows = [candle(v, at(1 + h // 24, h % 24), None if rng.random() < 0.1 else rng.random(), b)
            for b in ("BTC", "ETH") for v in ("COINBASE", "BINANCE", "KRAKEN", "ELSEWHERE") for h in range(60) if rng.random() < 0.7]
    candles = spark.createDataFrame(rows, CANDLE).cache()
    pairs = pr.venue_pairs(candles, ["high", "close"])
    got = sorted(map(tuple, pairs.collect()))
    want = [(r[0], r[1], a, b, r[2], r[4], r[3], r[5]) for a, b in (("COINBASE", "BINANCE"), ("COINBASE", "KRAKEN"), ("BINANCE", "KRAKEN"))
            for r in al.align(candles, a, b, ["high", "close"]).collect()]
    assert got == sorted(want) and len(got) > 50
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert pairs.columns == ["base", "time", "ex1", "ex2", "EX1:high", "EX1:close", "EX2:high", "EX2:close"]


# bucketed candles, order ---------------------------------------------------------------------------------------

@pytest.fixture
def hourly(spark):
    rows = [candle(v, at(1 + h // 24, h % 24), float(h)) for v in ("BINANCE", "BITFINEX") for h in range(200) if (h + len(v)) % 5]
    return spark.createDataFrame(rows, CANDLE).repartition(3).cache()


def test_stored_venues_join_without_an_exchange(spark, hourly, tmp_path):
    bk.write_bucketed(hourly, "tw_candles_test", str(tmp_path / "t"), buckets=4)
    joined = bk.align_join(spark, "tw_candles_test", "BINANCE", "BITFINEX", ["high", "close"])
    rows = sorted(map(tuple, joined.collect()))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "isFinalPlan=false" not in plan
    assert rows == sorted(map(tuple, al.align(hourly, "BINANCE", "BITFINEX", ["high", "close"]).collect())) and rows
    assert len(list((tmp_path / "t").glob("*.parquet"))) <= 4


def test_order_report_is_red_without_the_sort(spark, hourly, tmp_path):
    path = str(tmp_path / "sorted")
    fl.write_series(hourly, path)
    report = od.order_report(spark, path, ["exchange", "base"]).collect()
    assert {(r.exchange, r.n_rows, r.n_out_of_order, r.n_misplaced_files) for r in report} == {("BINANCE", 160, 0, 0), ("BITFINEX", 160, 0, 0)}
    mixed = str(tmp_path / "mixed")
    hourly.repartition(3).sortWithinPartitions(F.xxhash64("time")).write.partitionBy("exchange", "base").parquet(mixed)
    bad = od.order_report(spark, mixed, ["exchange", "base"]).collect()
    assert all(r.n_out_of_order > 0 and r.n_misplaced_files > 0 for r in bad)


def test_order_report_sees_the_border_of_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(od, "SEGMENT", 4)
    rows = [candle("X", at(1, h), 1.0) for h in (4, 5, 6, 7, 0, 1, 2, 3)]
    spark.createDataFrame(rows, CANDLE).coalesce(1).write.partitionBy("exchange", "base").parquet(str(tmp_path / "f"))
    r = od.order_report(spark, str(tmp_path / "f"), ["exchange", "base"]).first()
    assert (r.n_rows, r.n_out_of_order, r.n_misplaced_files) == (8, 1, 0)

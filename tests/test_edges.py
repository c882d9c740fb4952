"""Hand-made edge fixtures, one per case of the fixture plan (expected values
worked out by hand)."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickweave.operators import align as al
from tickweave.operators import candles as cd
from tickweave.operators import model as mo
from tickweave.operators import spread as sp
from tickweave.operators.quantiles import quantiles
from tickweave.sources import chunks as ch
from tickweave.sources import payloads as pl

T0 = dt.datetime(2024, 1, 1, 0, 0)
MS0 = 1704067200000  # T0 in epoch ms


def _pages(spark, rows):
    return spark.createDataFrame(
        [("BINANCE", "BTC", "USD", "BTC/USD", c, p, body) for c, p, body in rows],
        "exchange string, base string, quote string, pair string, chunk_no int, page_no int, payload string")


def _row(ms, o, h, lo, c, v):
    return f'[{ms},"{o}","{h}","{lo}","{c}","{v}",{ms + 59999},"0",1,"0","0","0"]'


def test_bad_payloads_give_no_rows_and_keep_schema(spark):
    good = "[" + _row(MS0, 1, 2, 0.5, 1.5, 10) + "]"
    bodies = [good, '{"code":-1}', "garbage", good[:20], "[]", '["error","x"]', None,
              '[[1704067260000,"1","2"]]',
              '[' + _row(MS0 + 120000, "x", 2, 1, 1, 1) + ']']
    pages = _pages(spark, [(0, i, b) for i, b in enumerate(bodies)])
    got = pl.decode_candles(pages)
    assert got.columns[:9] == ["base", "quote", "exchange", "time", "open", "high", "low", "close", "volume"]
    rows = got.collect()
    assert len(rows) == 1 and rows[0]["open"] == 1.0 and rows[0]["time"] == T0
    reasons = sorted(r["reject_reason"] for r in pl.quarantine(pages).collect())
    assert reasons == ["bad_number", *["bad_page"] * 5, "short_row"]
    raw = {r["raw_row"] for r in pl.quarantine(pages).where("reject_reason = 'bad_page'").collect()}
    assert raw == {'{"code":-1}', "garbage", good[:20], '["error","x"]', None}
    assert {r["status"] for r in pl.candle_rows(pages).collect()} == {"ok", "empty", "rejected"}
    ls = pl.load_status(pages).first()
    assert (ls["n_pages"], ls["n_bad_pages"], ls["n_empty_pages"], ls["n_rows"], ls["n_rejected"]) == (9, 5, 1, 1, 2)


def test_earlier_chunk_wins(spark):
    a = "[" + _row(MS0, 1, 1, 1, 1, 1) + "]"
    b = "[" + _row(MS0, 9, 9, 9, 9, 9) + "]"
    rows = pl.decode_candles(_pages(spark, [(1, 0, b), (0, 0, a)]))
    got = cd.dedupe(rows).collect()
    assert len(got) == 1 and got[0]["open"] == 1.0


def test_same_ts_orders_by_seq(spark):
    t = spark.createDataFrame([("BTC", "K", T0, 2, 10.0, 1.0), ("BTC", "K", T0, 1, 20.0, 1.0),
                               ("BTC", "K", T0 + dt.timedelta(seconds=5), 3, 15.0, 2.0)],
                              "base string, exchange string, ts timestamp_ntz, seq long, price double, volume double")
    r = cd.ohlc(t, "1 minute").first()
    assert (r["open"], r["high"], r["low"], r["close"], r["volume"]) == (20.0, 20.0, 10.0, 15.0, 4.0)


def test_range_is_inclusive(spark):
    end = T0 + dt.timedelta(hours=1)
    t = spark.createDataFrame([(T0,), (end,), (end + dt.timedelta(microseconds=1),)], "ts timestamp_ntz")
    assert cd.trade_range(t, "2024-01-01 00:00:00", "2024-01-01 01:00:00").count() == 2


def test_gap_fill(spark):
    c = spark.createDataFrame([("BTC", "K", T0, 1.0, 1.0, 1.0, 1.0, 1.0),
                               ("BTC", "K", T0 + dt.timedelta(minutes=3), 2.0, 2.0, 2.0, 2.0, 2.0),
                               ("ETH", "K", T0, 5.0, 5.0, 5.0, 5.0, 5.0)],
                              "base string, exchange string, time timestamp_ntz, open double, high double, "
                              "low double, close double, volume double")
    got = cd.fill_gaps(c, "1 minute", chunk_buckets=2).orderBy("base", "time").collect()
    btc = [r for r in got if r["base"] == "BTC"]
    assert len(btc) == 4 and btc[1]["open"] is None and btc[1]["volume"] == 0.0
    assert len([r for r in got if r["base"] == "ETH"]) == 1


@pytest.mark.parametrize("start,end,n", [
    ("2024-01-01 00:00", "2024-01-01 00:00", 0),
    ("2024-01-01 05:00", "2024-01-01 00:00", 0),
    ("2024-01-01 00:00", "2024-01-01 01:00", 1),
    ("2024-01-01 00:00", "2024-01-01 10:00", 2),
    ("2024-01-01 00:00", "2024-01-01 10:01", 3),
])
def test_chunk_plan(spark, start, end, n):
    r = spark.createDataFrame([(start, end)], "s string, e string").select(
        F.to_timestamp_ntz("s").alias("start"), F.to_timestamp_ntz("e").alias("end"))
    got = ch.chunk_plan(r, 300).orderBy("chunk_no").collect()
    assert len(got) == n
    if n:
        assert got[0]["start_text"] == start and got[-1]["end_text"] == end
        for a, b in zip(got, got[1:]):
            assert a["end_text"] == b["start_text"]


def test_null_times_do_not_join(spark):
    schema = "base string, exchange string, time timestamp_ntz, open double, high double, low double, close double, volume double"
    c = spark.createDataFrame([("BTC", "A", None, 1.0, 1.0, 1.0, 1.0, 1.0),
                               ("BTC", "B", None, 2.0, 2.0, 2.0, 2.0, 2.0),
                               ("BTC", "A", T0, 1.0, 1.0, 1.0, 1.0, 1.0)], schema)
    assert al.align(c, "A", "B", ["high"]).count() == 0


def test_absent_venue_and_empty_pair(spark):
    schema = "base string, exchange string, time timestamp_ntz, open double, high double, low double, close double, volume double"
    c = spark.createDataFrame([("BTC", "BINANCE", T0, 1.0, 1.0, 1.0, 1.0, 1.0),
                               ("BTC", "COINBASE", T0 + dt.timedelta(minutes=1), 2.0, 2.0, 2.0, 2.0, 2.0)], schema)
    w = al.widen(c)
    assert [x for x in w.columns if x.endswith(":open")] == ["COINBASE:open", "BINANCE:open"]
    pair = sp.spread(al.align(c, "BINANCE", "COINBASE", ["high", "close"]), "BINANCE", "COINBASE")
    lad = sp.threshold_ladder(pair).collect()
    assert all(r["n_rows"] == 0 and r["share_pct"] is None for r in lad)


def _pair(spark, rows):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(minutes=i), a, b) for i, (a, b) in enumerate(rows)],
        "time timestamp_ntz, `X:close` double, `Y:close` double")


def test_direction_on_zero_and_thresholds(spark):
    # diffs of exactly 0 %, 0.2 %, 0.3 %, 0.8 % of 100
    p = sp.spread(_pair(spark, [(100.0, 100.0), (100.2, 100.0), (100.3, 100.0), (100.8, 100.0)]), "X", "Y")
    top = sp.top_spreads(p, "X", "Y", 10).orderBy("time").collect()
    assert top[0]["direction"] == "SELL Y, BUY X"
    lad = {r["threshold"]: r for r in sp.threshold_ladder(p).collect()}
    vals = [r["abs_price_diff_pct"] for r in p.orderBy("time").collect()]
    for t in (0.2, 0.3, 0.8):
        assert lad[t]["n_rows"] == sum(v >= t for v in vals)
    assert lad[0.3]["profitable"] is False and lad[0.5]["profitable"] is True


def test_zero_and_nan_prices(spark):
    from tickweave.operators.features import basic_features
    df = spark.createDataFrame(
        [(T0, 1.0, 0.0, 1.0, 0.0, 1.0, 1.0, 1.0, 0.0), (T0, float("nan"), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)],
        "time timestamp_ntz, `A:high` double, `B:high` double, `A:low` double, `B:low` double, "
        "`A:close` double, `B:close` double, `A:volume` double, `B:volume` double")
    r = basic_features(df, "A", "B").collect()
    assert r[0]["price_diff_pct"] is None and r[0]["arbitrage_opportunity"] is None
    assert math.isclose(r[0]["volume_ratio"], 1e10)


def test_equal_top_values_keep_earlier(spark):
    p = sp.spread(_pair(spark, [(101.0, 100.0), (99.0, 100.0), (101.0, 100.0), (100.5, 100.0)]), "X", "Y")
    top = sp.top_spreads(p, "X", "Y", 2).collect()
    assert [r["time"] for r in top] == [T0, T0 + dt.timedelta(minutes=1)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "x double")
    h = sp.histogram(df, "x", 10).orderBy("bin").collect()
    assert len(h) == 10 and h[-1]["n_rows"] == 1 and sum(r["n_rows"] for r in h) == 5
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    h2 = sp.histogram(same, "x", 100).orderBy("bin").collect()
    assert [r["bin"] for r in h2 if r["n_rows"]] == [50] and math.isclose(h2[0]["bin_lo"], 1.5)


def _quantiles(df, qs):
    return list(quantiles(df, "x", qs, [f"q{i}" for i in range(len(qs))]).first())


@pytest.mark.parametrize("values", [
    [10.0 ** -k for k in range(300)],  # no equal-width buckets separate these
    [0.1, 0.3, 0.1 + (0.3 - 0.1), 0.7, 0.7 + (1.1 - 0.7), 1.1],  # a + (b - a) is not b
    [2.5] * 120_000 + [1.0, 3.0, 4.0],  # most rows are one value
    [-0.0, 0.0, -1e300, 1e300]])
def test_quantiles_of_hard_columns(spark, values):
    import numpy as np
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    qs = [0.0, 0.25, 0.5, 0.9, 0.999]
    want = np.quantile(values, qs)
    got = _quantiles(df, qs)
    assert all(a == b or math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got, want)), (got, want)


def test_quantiles_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(0, 1, 3000), np.full(500, 0.25), rng.exponential(5, 1500)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    qs = [0.0, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999, 1.0]
    got = _quantiles(df, qs)
    want = np.quantile(vals, qs)
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(got, want))


def _labels(spark, n_pos, n_neg):
    rows = [(T0 + dt.timedelta(minutes=i), 1 if i < n_pos else 0) for i in range(n_pos + n_neg)]
    return spark.createDataFrame(rows, "time timestamp_ntz, y int").withColumn("base", F.lit("BTC"))


@pytest.mark.parametrize("n_pos,ok", [(9, False), (10, True), (0, False)])
def test_guard(spark, n_pos, ok):
    assert mo.guard(_labels(spark, n_pos, 50), "y").first()["trainable"] is ok


def test_split_sizes_exact(spark):
    df = _labels(spark, 37, 411)
    s = mo.stratified_split(df, "y", ["base", "time"])
    got = {(r["y"], r["is_test"]): r["n"] for r in s.groupBy("y", "is_test").agg(F.count(F.lit(1)).alias("n")).collect()}
    # 90 = ceil(0.2 * 448) test rows; 358 train rows shared 29.57 / 328.43 -> 30 / 328
    assert (got[(1, True)], got[(0, True)]) == (7, 83)
    assert got[(1, False)] + got[(1, True)] == 37 and s.count() == 448
    assert mo.test_allocation({0: 411, 1: 37}) == {0: 83, 1: 7}
    assert sum(mo.test_allocation({0: 5, 1: 5}).values()) == 2


def test_report_zero_division(spark):
    conf = spark.createDataFrame([(0, 0, 5), (0, 1, 0), (1, 0, 3), (1, 1, 0)], "actual int, predicted int, n_rows long")
    rep = {r["class"]: r for r in mo.report(conf).collect()}
    assert rep["Opportunity"]["precision"] == 0.0 and rep["Opportunity"]["f1"] == 0.0
    assert math.isclose(rep["accuracy"]["f1"], 5 / 8)


def test_border_trade_in_both_chunks(spark):
    """A trade exactly on a chunk border is fetched by both requests; the chunked
    collector keeps the earlier chunk's (partial) candle; aggregating the feed
    once gives the full bucket."""
    border = T0 + dt.timedelta(minutes=300)
    t = spark.createDataFrame(
        [("BTC", "K", border, 1, 10.0, 1.0), ("BTC", "K", border + dt.timedelta(seconds=30), 2, 12.0, 1.0)],
        "base string, exchange string, ts timestamp_ntz, seq long, price double, volume double")
    chunked = cd.chunked_candles(t, T0, "1 minute").collect()
    assert len(chunked) == 1 and chunked[0]["close"] == 10.0 and chunked[0]["volume"] == 1.0
    whole = cd.ohlc(t, "1 minute").first()
    assert whole["close"] == 12.0 and whole["volume"] == 2.0


def test_trade_bodies(spark):
    from tickweave.sources.landing import land_trades
    ok = ('{"error":[],"result":{"XBTUSD":[["100.5","0.1",1704067200.25,"b","l","",7],'
          '["101","0.2",1704067260.5,"s","m","",8]],"last":"1704067260500000000"}}')
    bodies = [ok, '{"error":["EQuery:Unknown asset pair"]}', "garbage", ok[:40], None,
              '{"error":[],"result":{"XBTUSD":[],"last":"0"}}']
    pages = spark.createDataFrame(
        [("KRAKEN", "BTC", "USD", "XBTUSD", 0, i, b) for i, b in enumerate(bodies)],
        "exchange string, base string, quote string, pair string, chunk_no int, page_no int, payload string")
    got = pl.decode_trades(pages).orderBy("seq").collect()
    assert [(r["seq"], r["price"], r["volume"]) for r in got] == [(7, 100.5, 0.1), (8, 101.0, 0.2)]
    assert got[0]["ts"] == dt.datetime(2024, 1, 1, 0, 0, 0, 250000)
    # landing then decoding gives the trades back
    trades = spark.createDataFrame([(r["base"], r["exchange"], r["ts"], r["seq"], r["price"], r["volume"]) for r in got],
                                   "base string, exchange string, ts timestamp_ntz, seq long, price double, volume double")
    back = pl.decode_trades(land_trades(trades)).drop("quote")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, trades.collect()))


def test_pair_lookup_priority(spark):
    from tickweave.sources import symbols as sy
    cat = sy.catalogue_frame(spark, [("BITFINEX", "DOGE:USD", "tDOGE:USD"), ("BITFINEX", "BTCUSD", "tBTCUSD"),
                                     ("BITFINEX", "BTC:USD", "tBTC:USD"), ("KRAKEN", "usdxbt", "REV"),
                                     ("KRAKEN", "ETHUSD", "XETHZUSD")])
    req = spark.createDataFrame([("BITFINEX", "BTC", "USD"), ("BITFINEX", "DOGE", "USD"), ("KRAKEN", "BTC", "USD"),
                                 ("KRAKEN", "eth", "usd"), ("KRAKEN", "DOGE", "USD")],
                                "exchange string, base string, quote string")
    got = {(r["exchange"], r["base"]): r["symbol"] for r in sy.lookup_pairs(req, cat).collect()}
    assert got == {("BITFINEX", "BTC"): "tBTCUSD", ("BITFINEX", "DOGE"): "tDOGE:USD",
                   ("KRAKEN", "BTC"): "REV", ("KRAKEN", "eth"): "XETHZUSD", ("KRAKEN", "DOGE"): None}


def test_quantiles_all_equal_and_single(spark):
    one = spark.createDataFrame([(3.5,)], "x double")
    same = spark.createDataFrame([(2.0,)] * 50, "x double")
    assert _quantiles(one, [0.0, 0.5, 1.0]) == [3.5, 3.5, 3.5]
    assert _quantiles(same, [0.3, 0.999]) == [2.0, 2.0]
    empty = spark.createDataFrame([], "x double")
    assert _quantiles(empty, [0.5]) == [None]


def test_garbage_times_are_rejected_not_fatal(spark):
    good = "[" + _row(MS0, 1, 2, 0.5, 1.5, 10) + "]"
    bad = ('[[99999999999999999999,"1","1","1","1","1",0,"0",1,"0","0","0"],'
           '[-99999999999999999,"1","1","1","1","1",0,"0",1,"0","0","0"],'
           '["soon","1","1","1","1","1",0,"0",1,"0","0","0"]]')
    pages = _pages(spark, [(0, 0, good), (0, 1, bad)])
    assert pl.decode_candles(pages).count() == 1
    reasons = [r["reject_reason"] for r in pl.quarantine(pages).collect()]
    assert reasons == ["bad_time"] * 3
    tb = ('{"error":[],"result":{"XBTUSD":[["1","1",1e300,"b","l","",1],["1","1",1704067200.5,"b","l","",2]],'
          '"last":"0"}}')
    tp = spark.createDataFrame([("KRAKEN", "BTC", "USD", "XBTUSD", 0, 0, tb)],
                               "exchange string, base string, quote string, pair string, chunk_no int, "
                               "page_no int, payload string")
    assert [r["seq"] for r in pl.decode_trades(tp).collect()] == [2]


def test_venue_symbols(spark):
    from tickweave.sources import symbols as sy
    venues = ["BINANCE", "COINBASE", "GATEIO", "MEXC", "BITFINEX", "KRAKEN"]
    req = spark.createDataFrame([(v, p) for v in venues for p in ("BTC/USD", "DOGE/EUR", "ETH/USDT")],
                                "exchange string, pair string")
    cat = sy.catalogue_frame(spark, [("BITFINEX", "BTCUSD", "tBTCUSD")])
    got = {(r["exchange"], r["pair"]): r["symbol"] for r in sy.symbol_map(req, cat).collect()}
    assert got[("BINANCE", "BTC/USD")] == "BTCUSDT" and got[("BINANCE", "DOGE/EUR")] == "DOGEEUR"
    assert got[("COINBASE", "BTC/USD")] == "BTC-USD"
    assert got[("GATEIO", "BTC/USD")] == "BTC_USDT" and got[("GATEIO", "ETH/USDT")] == "ETH_USDT"
    assert got[("MEXC", "BTC/USD")] == "BTCUSDT" and got[("MEXC", "DOGE/EUR")] == "DOGEEURT"
    assert got[("BITFINEX", "BTC/USD")] == "tBTCUSD"
    assert got[("KRAKEN", "BTC/USD")] == "XBTUSD" and got[("KRAKEN", "DOGE/EUR")] == "DOGEUR"
    assert got[("KRAKEN", "ETH/USDT")] == "ETHUSD"
    cleaned = spark.createDataFrame([(" btc, eth,,doge ,",)], "t string").select(
        sy.clean_list(F.col("t")).alias("l")).first()["l"]
    assert cleaned == ["BTC", "ETH", "DOGE"]


def test_stratified_folds_exact_sizes(spark):
    df = _labels(spark, 37, 411)
    f = mo.with_fold(df, "y", ["base", "time"], 5)
    sizes = {}
    for r in f.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes.setdefault(r["y"], []).append(r["n"])
    assert sorted(sizes[1]) == [7, 7, 7, 8, 8] and sum(sizes[0]) == 411
    assert max(sizes[0]) - min(sizes[0]) <= 1 and len(sizes[0]) == 5
    assert f.count() == 448


def test_grouped_quantiles_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    data = {"A": rng.normal(0, 1, 700), "B": np.concatenate([np.full(300, 1.5), rng.exponential(2, 200)]),
            "C": np.array([4.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.0, 0.5, 0.9, 0.999, 1.0]
    got = {r[0]: list(r)[1:] for r in quantiles(df, "x", qs, list("abcde"), keys=("g",)).collect()}
    for g, vs in data.items():
        want = np.quantile(vs, qs)
        assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(got[g], want)), g


PAGES = "exchange string, base string, quote string, pair string, chunk_no int, page_no int, payload string"


def test_nothing_is_lost_at_ingest(spark):
    """Rows in = decoded + rejected, with the raw text of what was rejected."""
    good = _row(MS0, 1, 2, 0.5, 1.5, 10)
    pages = spark.createDataFrame([
        ("BINANCE", "BTC", "USD", "BTC/USD", 0, 0, f'[{good}, "oops"]'),  # one bad element: its row alone is kept aside
        ("NEWVENUE", "BTC", "USD", "BTC/USD", 0, 0, f"[{good}]"),
        ("BINANCE", "BTC", "USD", "BTC/USD", 1, 0, f"[{_row(MS0 + 60000, 1, 2, 3, 4, 5)}]")], PAGES)
    kept = {(r["exchange"], r["reject_reason"]): r["raw_row"] for r in pl.quarantine(pages).collect()}
    assert kept == {("BINANCE", "bad_element"): '"oops"', ("NEWVENUE", "unknown_layout"): f"[{good}]"}
    status = {r["exchange"]: r for r in pl.load_status(pages).collect()}
    assert (status["NEWVENUE"]["n_pages"], status["NEWVENUE"]["n_bad_pages"]) == (1, 1)
    assert [status["BINANCE"][x] for x in ("n_pages", "n_bad_pages", "n_rows", "n_rejected")] == [2, 0, 2, 1]


def test_trades_without_id_and_bad_trades(spark):
    """A border trade in two chunks is one trade; equal trades inside a page stay apart; a bad
    time or price is kept aside."""
    def body(*rows):
        return '{"error":[],"result":{"XBTUSD":[' + ",".join(rows) + "]}}"
    border = '["5","1",1704067500.0]'
    pages = spark.createDataFrame([
        ("KRAKEN", "BTC", "USD", "XBTUSD", 0, 0, body('["4","1",1704067200.0]', '["4","1",1704067200.0]', border)),
        ("KRAKEN", "BTC", "USD", "XBTUSD", 1, 0, body(border, '["6","1","x"]', '["n/a","1",1704067501.0]'))], PAGES)
    got = pl.decode_trades(pages)
    assert sorted((r["price"], r["volume"]) for r in got.collect()) == [(4.0, 1.0), (4.0, 1.0), (5.0, 1.0)]
    assert cd.ohlc(got, "1 hour").first()["volume"] == 3.0
    assert sorted((r["reject_reason"], r["raw_row"]) for r in pl.quarantine_trades(pages).collect()) == [
        ("bad_number", '["n/a","1","1.704067501E9"]'), ("bad_time", '["6","1","x"]')]
    status = pl.trade_load_status(pages).first()
    assert (status["n_pages"], status["n_rows"], status["n_rejected"]) == (2, 4, 2)


@pytest.mark.parametrize("venue,body", [
    ("BINANCE", '[[1704067200000,"1","4","0.5","2","9",1704067259999,"0",1,"0","0","0"]]'),
    ("BITFINEX", "[[1704067200000,1,2,4,0.5,9]]"),
    ("COINBASE", "[[1704067200,0.5,4,1,2,9]]"),
    ("GATEIO", '[["1704067200","9","2","4","0.5","1","0","true"]]'),
    ("MEXC", '[[1704067200000,"1","4","0.5","2","9",1704067259999,"0"]]')])
def test_one_literal_body_per_venue(spark, venue, body):
    pages = spark.createDataFrame([(venue, "BTC", "USD", "BTC/USD", 0, 0, body)], PAGES)
    r = pl.decode_candles(pages).first()
    assert (r["time"], r["open"], r["high"], r["low"], r["close"], r["volume"]) == (T0, 1.0, 4.0, 0.5, 2.0, 9.0)


def test_ids_that_run_against_time(spark):
    rows = [("BTC", "K", T0 + dt.timedelta(seconds=s), q, p, 1.0) for s, q, p in
            [(0, 900, 10.0), (1, 5, 20.0), (1, 4, 15.0), (2, 1, 30.0)]]
    t = spark.createDataFrame(rows, "base string, exchange string, ts timestamp_ntz, seq long, price double, volume double")
    got = cd.ohlc(t, "1 minute").first()
    assert (got["open"], got["close"]) == (10.0, 30.0)
    second = cd.ohlc(t, "1 second").orderBy("time").collect()[1]
    assert (second["open"], second["close"]) == (15.0, 20.0)


def test_times_before_1970(spark):
    pages = _pages(spark, [(0, 0, "[" + _row(-60_000, 1, 2, 0.5, 1.5, 10) + "]")])
    assert pl.decode_candles(pages).first()["time"] == dt.datetime(1969, 12, 31, 23, 59)


def test_wide_csv_is_read_by_its_header(spark, tmp_path):
    from tickweave.sources import files as fl
    (tmp_path / "w.csv").write_text("time,BINANCE:close,COINBASE:close\n2024-01-01 00:00,1.5,2.5\nbad,,x\n")
    got = fl.read_wide(spark, str(tmp_path / "w.csv"), ["COINBASE", "BINANCE"], fields=("close",)).collect()
    assert [tuple(r) for r in got] == [(T0, 2.5, 1.5), (None, None, None)]
    with pytest.raises(ValueError, match="MEXC:close"):
        fl.read_wide(spark, str(tmp_path / "w.csv"), ["MEXC"], fields=("close",))


def test_pairs_of_one_base_stay_apart(spark):
    good = "[" + _row(MS0, 1, 2, 0.5, 1.5, 10) + "]"
    pages = spark.createDataFrame([("BINANCE", "ETH", q, f"ETH/{q}", 0, 0, good) for q in ("USDT", "BTC")], PAGES)
    assert {r["quote"] for r in cd.dedupe(pl.decode_candles(pages)).collect()} == {"USDT", "BTC"}


def test_listed_symbol_comes_from_the_catalogue(spark):
    from tickweave.sources import symbols as sy
    cat = sy.catalogue_frame(spark, [("BITFINEX", "DOGE:USD", "tDOGE:USD")])
    req = spark.createDataFrame([("BITFINEX", "DOGE/USD"), ("BITFINEX", "XYZ/USD"), ("MEXC", "DOGE/USD")],
                                "exchange string, pair string")
    got = {(r["exchange"], r["base"]): r["symbol"] for r in sy.symbol_map(req, cat).collect()}
    assert got == {("BITFINEX", "DOGE"): "tDOGE:USD", ("BITFINEX", "XYZ"): None, ("MEXC", "DOGE"): "DOGEUSDT"}


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace
    from tickweave.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=context))

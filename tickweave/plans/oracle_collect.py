"""DuckDB SQL for the landing / decoding / symbol / sink jobs.

A decoder is right when it gives back what was landed, so most oracles are the
candle (or trade) table itself; page and row counts follow from the chunk rule
(300-minute chunks from the first hour, a row on a chunk border in both chunks).
"""
from __future__ import annotations

from ..sources.tape import sql_events_trades
from .oracle_analysis import CANDLE_OUT, R, candles_cte, rnd, tape_cte, wide_select

CHUNK_US = 300 * 60 * 1_000_000

CANDLES = f"WITH {candles_cte(True)} SELECT {CANDLE_OUT} FROM candles"

_LANDED = (f"WITH {candles_cte(True)}, st AS (SELECT date_trunc('hour', min(time)) AS s FROM candles), "
           "tg AS (SELECT c.exchange, c.base, epoch_us(c.time) - epoch_us(st.s) AS off FROM candles c, st), "
           f"ch AS (SELECT exchange, base, off // {CHUNK_US} AS k FROM tg UNION ALL "
           f"SELECT exchange, base, off // {CHUNK_US} - 1 AS k FROM tg "
           f"WHERE off % {CHUNK_US} = 0 AND off // {CHUNK_US} >= 1), "
           "ser AS (SELECT exchange, base, count(DISTINCT k) AS p, count(*) AS l FROM ch GROUP BY exchange, base), "
           "kept AS (SELECT exchange, base, count(*) AS n FROM candles GROUP BY exchange, base), "
           "tot AS (SELECT sum(p)::BIGINT AS p, sum(l)::BIGINT AS l FROM ser) ")

# damage kind -> (bad pages, empty pages, rows kept) as multiples of (pages, pages, rows)
_DAMAGE = [("ok", 0, 0, 1), ("truncated", 1, 0, 0), ("error_object", 1, 0, 0), ("garbage", 1, 0, 0),
           ("empty", 0, 1, 0), ("flat", 1, 0, 0), ("null_body", 1, 0, 0), ("short_rows", 0, 0, 0),
           ("bad_number", 0, 0, 0)]


def _bad_payloads() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{k}' AS damage, p AS n_pages, ({b} * p)::BIGINT AS n_bad_pages, "
        f"({e} * p)::BIGINT AS n_empty_pages, ({g} * l)::BIGINT AS n_rows FROM tot" for k, b, e, g in _DAMAGE)
    return _LANDED + f"SELECT * FROM ({rows})"


_KR = ("CASE upper({x}) WHEN 'BTC' THEN 'XBT' WHEN 'ETH' THEN 'ETH' WHEN 'DOGE' THEN 'DOG' "
       "WHEN 'USD' THEN 'USD' WHEN 'USDT' THEN 'USD' WHEN 'EUR' THEN 'EUR' ELSE upper({x}) END")

_PAIR_LOOKUP = (
    f"WITH {tape_cte(True)}, req AS (SELECT DISTINCT exchange, base, 'USD' AS quote FROM tape "
    "WHERE exchange IN ('BITFINEX', 'KRAKEN')), "
    "cat(ex, name, symbol) AS (VALUES ('BITFINEX', 'BTCUSD', 'tBTCUSD'), ('BITFINEX', 'ETHUSD', 'tETHUSD'), "
    "('BITFINEX', 'DOGE:USD', 'tDOGE:USD'), ('KRAKEN', 'XBTUSD', 'XXBTZUSD'), ('KRAKEN', 'ETHUSD', 'XETHZUSD'), "
    "('KRAKEN', 'XDGUSD', 'XDGUSD')), "
    "cand AS (SELECT exchange, base, quote, 0 AS prio, CASE exchange WHEN 'BITFINEX' THEN upper(base) || upper(quote) "
    f"ELSE {_KR.format(x='base')} || {_KR.format(x='quote')} END AS c FROM req UNION ALL "
    "SELECT exchange, base, quote, 1 AS prio, CASE exchange WHEN 'BITFINEX' THEN upper(base) || ':' || upper(quote) "
    f"ELSE {_KR.format(x='quote')} || {_KR.format(x='base')} END AS c FROM req), "
    "hit AS (SELECT exchange, base, quote, min_by(symbol, prio) AS symbol FROM cand "
    "JOIN cat ON cat.ex = cand.exchange AND upper(cat.name) = upper(cand.c) GROUP BY exchange, base, quote) "
    "SELECT req.exchange, req.base, req.quote, hit.symbol, hit.symbol IS NOT NULL AS supported "
    "FROM req LEFT JOIN hit USING (exchange, base, quote)")

# the same catalogue decides what the listed venue is asked for
_SYMBOLS = (
    f"WITH {tape_cte(True)}, s AS (SELECT DISTINCT exchange, base FROM tape), "
    "cat(base, symbol) AS (SELECT split_part(replace(replace(name, ':', ''), 'USD', ''), ':', 1), 't' || name FROM "
    "(VALUES ('BTCUSD'), ('ETHUSD'), ('DOGE:USD')) v(name)) "
    "SELECT exchange, base, 'USD' AS quote, base || '/USD' AS pair, "
    "CASE exchange WHEN 'BINANCE' THEN base || 'USDT' WHEN 'COINBASE' THEN base || '-USD' "
    "WHEN 'GATEIO' THEN base || '_USDT' WHEN 'MEXC' THEN base || 'USDT' "
    "WHEN 'BITFINEX' THEN (SELECT symbol FROM cat WHERE cat.base = s.base) "
    f"WHEN 'KRAKEN' THEN {_KR.format(x='base')} || 'USD' END AS symbol FROM s")

_CHUNKS = (
    f"WITH {tape_cte(True)}, r AS (SELECT base, exchange, date_trunc('hour', min(ts)) AS s, "
    "date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS e FROM tape GROUP BY base, exchange), "
    f"c AS (SELECT base, exchange, s, e, unnest(generate_series(0, (epoch_us(e) - epoch_us(s) - 1) // {CHUNK_US})) AS k "
    "FROM r WHERE s < e), "
    "b AS (SELECT base, exchange, k, s + k * INTERVAL 300 MINUTE AS cs, "
    "least(s + (k + 1) * INTERVAL 300 MINUTE, e) AS ce FROM c) "
    "SELECT base, exchange, k::INTEGER AS chunk_no, strftime(cs, '%Y-%m-%d %H:%M') AS start_text, "
    "strftime(ce, '%Y-%m-%d %H:%M') AS end_text, strftime(cs, '%Y-%m-%dT%H:%M:%SZ') AS start_iso, "
    "strftime(ce, '%Y-%m-%dT%H:%M:%SZ') AS end_iso, epoch(cs)::BIGINT AS start_s, epoch(ce)::BIGINT AS end_s, "
    "epoch_ms(cs) AS start_ms, epoch_ms(ce) AS end_ms, epoch_ns(cs) AS since_ns, "
    "(date_diff('minute', cs, ce))::BIGINT AS minutes FROM b")

_CURRENCY = (
    f"WITH {tape_cte(True)}, d AS (SELECT DISTINCT exchange, lower(base) AS b FROM tape), "
    "t AS (SELECT exchange, string_agg(b, ' , ' ORDER BY b) || ', ,' AS typed FROM d GROUP BY exchange), "
    "u AS (SELECT exchange, trim(unnest(string_split(upper(typed), ','))) AS base FROM t) "
    "SELECT exchange, base FROM u WHERE base <> ''")

_TIMES = (
    f"WITH {tape_cte(True)}, x AS ("
    "SELECT seq, 'seconds' AS kind, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM tape UNION ALL "
    "SELECT seq, 'minutes' AS kind, strftime(ts, '%Y-%m-%d %H:%M') AS text FROM tape UNION ALL "
    "SELECT seq, 'junk' AS kind, exchange AS text FROM tape) "
    "SELECT seq, kind, text, date_trunc('minute', TRY_CAST(text AS TIMESTAMP)) AS time FROM x")

# three pairs by user_id % 3, two of which share their base
_TRIANGLE = ("WITH tape AS (SELECT CASE user_id % 3 WHEN 0 THEN 'BTC' ELSE 'ETH' END AS base, "
             "CASE user_id % 3 WHEN 2 THEN 'BTC' ELSE 'USDT' END AS quote, t.* EXCLUDE (base) FROM "
             f"({sql_events_trades(False)}) t JOIN (SELECT event_id AS seq, user_id FROM events) USING (seq)), "
             "candles AS (SELECT base, quote, exchange, date_trunc('hour', ts) AS time, arg_min(price, ts) AS open, "
             "max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, coalesce(sum(volume), 0) AS volume "
             "FROM tape WHERE ts IS NOT NULL GROUP BY ALL) "
             f"SELECT quote, {CANDLE_OUT} FROM candles")

# minute candles of the multi-series tape, and the pages of three rows they land in
_MINUTE = (f"WITH {tape_cte(True)}, candles AS (SELECT base, exchange, date_trunc('minute', ts) AS time, "
           "arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, "
           "coalesce(sum(volume), 0) AS volume FROM tape WHERE ts IS NOT NULL GROUP BY ALL) ")
_MINUTE_PAGES = (_MINUTE + ", st AS (SELECT date_trunc('hour', min(time)) AS s FROM candles), "
                 "tg AS (SELECT c.exchange, c.base, epoch_us(c.time) - epoch_us(st.s) AS off FROM candles c, st), "
                 f"ch AS (SELECT exchange, base, off // {CHUNK_US} AS k FROM tg UNION ALL "
                 f"SELECT exchange, base, off // {CHUNK_US} - 1 AS k FROM tg "
                 f"WHERE off % {CHUNK_US} = 0 AND off // {CHUNK_US} >= 1), "
                 "per AS (SELECT exchange, base, k, count(*) AS n FROM ch GROUP BY ALL) "
                 "SELECT exchange, base, (2 * sum(ceil(n / 3.0)))::BIGINT AS n_pages, 0::BIGINT AS n_bad_pages, "
                 "0::BIGINT AS n_empty_pages, (2 * sum(n))::BIGINT AS n_rows, 0::BIGINT AS n_rejected "
                 "FROM per GROUP BY exchange, base")

# trade pages: chunk of the trade (two on a border) and trade id div 1000
_TRADE_PAGES = (f"WITH {tape_cte(True)}, st AS (SELECT date_trunc('hour', min(ts)) AS s FROM tape), "
                "tg AS (SELECT t.exchange, t.base, seq, epoch_us(ts) - epoch_us(st.s) AS off FROM tape t, st), "
                f"ch AS (SELECT exchange, base, seq, off // {CHUNK_US} AS k FROM tg UNION ALL "
                f"SELECT exchange, base, seq, off // {CHUNK_US} - 1 AS k FROM tg "
                f"WHERE off % {CHUNK_US} = 0 AND off // {CHUNK_US} >= 1), "
                "p AS (SELECT exchange, base, count(DISTINCT (k, seq // 1000)) AS p, count(*) AS n FROM ch GROUP BY ALL) "
                "SELECT exchange, base, (4 * p)::BIGINT AS n_pages, (2 * p)::BIGINT AS n_bad_pages, "
                "0::BIGINT AS n_empty_pages, n::BIGINT AS n_rows, n::BIGINT AS n_rejected FROM p")

SQL = {
    "collect_pairs": _TRIANGLE,
    "sink_pairs": _TRIANGLE,
    "minute_candles": _MINUTE + f"SELECT {CANDLE_OUT} FROM candles",
    "minute_pages": _MINUTE_PAGES,
    "trade_load_status": _TRADE_PAGES,
    "wide_by_header": (f"WITH {candles_cte(True)} SELECT base, time, " + ", ".join(
        rnd(f"max(CASE WHEN exchange = '{v}' THEN {f} END)") + f' AS "{v}:{f}"'
        for v in ("COINBASE", "BINANCE") for f in ("high", "close"))
        + " FROM candles GROUP BY base, time"),
    "adapt_binance": CANDLES,
    "adapt_bitfinex": CANDLES,
    "adapt_coinbase": CANDLES,
    "adapt_gateio": CANDLES,
    "adapt_mexc": CANDLES,
    "adapt_kraken_trades": (f"WITH {tape_cte(True)} SELECT base, exchange, ts, seq, {rnd('price')} AS price, "
                            f"{rnd('volume')} AS volume FROM tape"),
    "adapt_kraken": CANDLES,
    "page_union": _LANDED + "SELECT exchange, base, p::BIGINT AS n_pages, l::BIGINT AS n_rows FROM ser",
    "dedupe_candles": (_LANDED + "SELECT exchange, base, l::BIGINT AS n_landed, n::BIGINT AS n_kept, "
                       "(l - n)::BIGINT AS n_dropped FROM ser JOIN kept USING (exchange, base)"),
    "bad_payloads": _bad_payloads(),
    "load_status": (_LANDED + "SELECT exchange, base, (9 * p)::BIGINT AS n_pages, (5 * p)::BIGINT AS n_bad_pages, "
                    "p::BIGINT AS n_empty_pages, l::BIGINT AS n_rows, (2 * l)::BIGINT AS n_rejected FROM ser"),
    "quarantine": (_LANDED + "SELECT exchange, base, 'short_row' AS reject_reason, l::BIGINT AS n_rows FROM ser "
                   "UNION ALL SELECT exchange, base, 'bad_number' AS reject_reason, l::BIGINT AS n_rows FROM ser "
                   "UNION ALL SELECT exchange, base, 'bad_page' AS reject_reason, (5 * p)::BIGINT AS n_rows FROM ser"),
    "chunk_plan": _CHUNKS,
    "symbol_map": _SYMBOLS,
    "currency_list": _CURRENCY,
    "pair_lookup": _PAIR_LOOKUP,
    "time_coerce": _TIMES,
    "csv_roundtrip": f"WITH {candles_cte(True)} {wide_select()}",
    "landed_files": CANDLES,
    "sink_series": CANDLES,
    "sink_series_csv": CANDLES,
}

"""DuckDB SQL for the jobs over stored tables and over every venue pair."""
from __future__ import annotations

from .oracle_analysis import (CLOSE_MULTI, COST, CUT, LADDER, VENUES, _r, _stats_cols, aligned_cte, candles_cte, rnd,
                              tape_cte, wide_select)
from .oracle_collect import _LANDED, _MINUTE, CANDLES, CHUNK_US

_RANK = "list_position([" + ", ".join(f"'{v}'" for v in VENUES) + "], {x}.exchange)"


def _pairs(fields: list[str], basis: str) -> str:
    """Every pair of venues with all fields, by a self-join in registry order."""
    full = " AND ".join(f"{s}.{f} IS NOT NULL" for s in "ab" for f in fields)
    return (f"WITH {candles_cte(True)}, sp AS (SELECT a.base, a.time, a.exchange AS ex1, b.exchange AS ex2, a.{basis} AS p1, "
            f"b.{basis} AS p2, a.{basis} - b.{basis} AS price_diff, (a.{basis} - b.{basis}) / nullif(b.{basis}, 0) * 100.0 AS price_diff_pct, "
            f"abs((a.{basis} - b.{basis}) / nullif(b.{basis}, 0) * 100.0) AS abs_price_diff_pct "
            f"FROM candles a JOIN candles b ON a.base = b.base AND a.time = b.time "
            f"AND {_RANK.format(x='a')} < {_RANK.format(x='b')} WHERE {full}) ")


_CLOSE, _HIGH = _pairs(["high", "close"], "close"), _pairs(["high"], "high")


def _ladder() -> str:
    rungs = ", ".join(f"({t!r}::DOUBLE)" for t in LADDER)
    return (_CLOSE + f", t(threshold) AS (VALUES {rungs}) SELECT base, ex1, ex2, threshold, "
            "count(*) FILTER (abs_price_diff_pct >= threshold) AS n_rows, "
            f"{rnd('count(*) FILTER (abs_price_diff_pct >= threshold)::DOUBLE / count(*)::DOUBLE * 100.0')} AS share_pct, "
            f"threshold > {COST} AS profitable FROM sp, t GROUP BY base, ex1, ex2, threshold")


_PROFIT = (_CLOSE + f", s AS (SELECT base, ex1, ex2, count(*) AS n_rows, count(*) FILTER (hit) AS n_profitable, sum(p) AS total_profit, "
           f"avg(p) AS mean_profit, max(p) AS best_profit, min(p) AS worst_profit FROM (SELECT *, abs_price_diff_pct >= {CUT} AS hit, "
           f"CASE WHEN abs_price_diff_pct >= {CUT} THEN (abs_price_diff_pct - {COST}) * p2 / 100.0 END AS p FROM sp) GROUP BY base, ex1, ex2) "
           f"SELECT base, ex1, ex2, n_rows, n_profitable, {rnd('n_profitable::DOUBLE / n_rows::DOUBLE * 100.0')} AS share_pct, "
           + ", ".join(_r(x, x) for x in ("total_profit", "mean_profit", "best_profit", "worst_profit")) + " FROM s")

_FEES = (_HIGH + ", s AS (SELECT base, ex1, ex2, count(*) AS n_rows, count(*) FILTER (hit) AS n_clearing, avg(g) AS mean_profit, "
         "avg(CASE WHEN hit THEN abs_price_diff_pct END) AS mean_abs_pct, max(g) AS best_profit, sum(g) AS total_profit "
         "FROM (SELECT *, abs_price_diff_pct > 0.2::DOUBLE AS hit, CASE WHEN abs_price_diff_pct > 0.2::DOUBLE THEN abs(price_diff) END AS g FROM sp) "
         f"GROUP BY base, ex1, ex2) SELECT base, ex1, ex2, n_rows, n_clearing, {rnd('n_clearing::DOUBLE / n_rows::DOUBLE * 100.0')} AS share_pct, "
         + ", ".join(_r(x, x) for x in ("mean_profit", "mean_abs_pct", "best_profit", "total_profit"))
         + f", {rnd('total_profit / nullif(n_clearing, 0)::DOUBLE')} AS profit_per_trade FROM s")

_BEST = (_CLOSE + ", o AS (SELECT *, row_number() OVER (PARTITION BY base, time ORDER BY abs_price_diff_pct DESC, "
         + "list_position([" + ", ".join(f"'{v}'" for v in VENUES) + "], ex1), list_position([" + ", ".join(f"'{v}'" for v in VENUES)
         + "], ex2)) AS r FROM sp WHERE abs_price_diff_pct IS NOT NULL) SELECT base, time, ex1, ex2, "
         + _r("abs_price_diff_pct", "abs_price_diff_pct")
         + ", CASE WHEN price_diff > 0 THEN 'SELL ' || ex1 || ', BUY ' || ex2 ELSE 'SELL ' || ex2 || ', BUY ' || ex1 END AS direction "
         "FROM o WHERE r = 1")

_DAYS = CLOSE_MULTI + ", d AS (SELECT base, CAST(time AS DATE) AS day, abs_price_diff_pct AS x FROM sp WHERE abs_price_diff_pct IS NOT NULL)"
_DAILY_MEDIAN = (_DAYS + f" SELECT base, day, count(*) AS n_rows, {_r('min(x)', 'low')}, {_r('max(x)', 'high')}, "
                 f"{_r('quantile_disc(x, 0.5)', 'median')} FROM d GROUP BY base, day")
_RANGE = (_DAYS + ", e AS (SELECT min(day) + 3 AS a, max(day) - 3 AS z FROM d), "
          "q(q) AS (VALUES (0.5::DOUBLE), (0.75::DOUBLE), (0.9::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE), (99.9::DOUBLE / 100.0::DOUBLE)) "
          "SELECT base, q, count(*) AS n_rows, count(*) AS n_in_states, true AS within_bound FROM d, e, q WHERE day BETWEEN a AND z GROUP BY base, q")

# pages of three minute candles by chunk, with the planted holes
_LEDGER = (_MINUTE + ", st AS (SELECT date_trunc('hour', min(ts)) AS s FROM tape), "
           "tg AS (SELECT c.exchange, c.base, time, epoch_us(c.time) - epoch_us(st.s) AS off FROM candles c, st), "
           f"ch AS (SELECT exchange, base, time, off // {CHUNK_US} AS k FROM tg UNION ALL SELECT exchange, base, time, off // {CHUNK_US} - 1 AS k "
           f"FROM tg WHERE off % {CHUNK_US} = 0 AND off // {CHUNK_US} >= 1), "
           "pg AS (SELECT exchange, base, k, p, count(*) AS n FROM (SELECT *, (row_number() OVER (PARTITION BY exchange, base, k ORDER BY time) - 1) // 3 AS p "
           "FROM ch) GROUP BY ALL), "
           "here AS (SELECT *, NOT (k % 7 = 5 AND p = 0) AS good FROM pg WHERE k % 7 <> 3 AND NOT (k % 5 = 2 AND p = 1)), "
           "sums AS (SELECT exchange, base, k, count(*) AS n_pages, count(*) FILTER (NOT good) AS n_bad_pages, sum(n) FILTER (good) AS n_rows, "
           "max(p) AS last, arg_max(CASE WHEN good THEN n ELSE 0 END, p) AS last_n, list(p) FILTER (good) AS goods FROM here GROUP BY ALL), "
           "r AS (SELECT exchange, base, (SELECT s FROM st) AS s, date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS e FROM tape GROUP BY exchange, base), "
           f"plan AS (SELECT exchange, base, s, e, unnest(generate_series(0, (epoch_us(e) - epoch_us(s) - 1) // {CHUNK_US})) AS k FROM r), "
           "j AS (SELECT plan.*, n_pages, n_bad_pages, n_rows, last, last_n, "
           "list_min(list_filter(generate_series(0, last + 1), lambda x: NOT list_contains(coalesce(goods, []), x))) AS absent "
           "FROM plan LEFT JOIN sums USING (exchange, base, k)), "
           "led AS (SELECT *, CASE WHEN n_pages IS NULL THEN 'missing' WHEN n_bad_pages > 0 THEN 'rejected' WHEN absent <= last THEN 'page_gap' "
           "WHEN last_n >= 3 THEN 'open_end' ELSE 'landed' END AS status FROM j) ")
_RESUME = "CASE WHEN status = 'landed' THEN NULL ELSE coalesce(absent, 0) END::BIGINT AS resume_page"

_HOLES = (f"WITH {candles_cte(True)}, n AS (SELECT base, exchange, time, lead(time) OVER (PARTITION BY base, exchange ORDER BY time) AS nxt FROM candles) "
          "SELECT base, exchange, time + INTERVAL 1 HOUR AS hole_start, nxt - INTERVAL 1 HOUR AS hole_end, "
          "(date_diff('hour', time, nxt) - 1)::BIGINT AS n_buckets FROM n WHERE nxt > time + INTERVAL 1 HOUR")

SQL = {
    "sketch_daily_median": _DAILY_MEDIAN,
    "sketch_range_percentiles": _RANGE,
    "incremental_series": CANDLES,
    "incremental_wide": f"WITH {candles_cte(True)} {wide_select()}",
    "load_ledger": _LEDGER + "SELECT exchange, base, k::INTEGER AS chunk_no, coalesce(n_pages, 0)::BIGINT AS n_pages, "
                             "coalesce(n_bad_pages, 0)::BIGINT AS n_bad_pages, coalesce(n_rows, 0)::BIGINT AS n_rows, status, " + _RESUME + " FROM led",
    "requests_again": _LEDGER + "SELECT exchange, base, k::INTEGER AS chunk_no, epoch(s + k * INTERVAL 300 MINUTE)::BIGINT AS start_s, "
                                "epoch_ms(least(s + (k + 1) * INTERVAL 300 MINUTE, e)) AS end_ms, status, " + _RESUME
                      + " FROM led WHERE status <> 'landed'",
    "salvaged_candles": CANDLES,
    "salvage_quarantine": _LANDED + "SELECT exchange, base, 'bad_element' AS reject_reason, raw AS raw_row, p::BIGINT AS n_rows FROM ser, "
                                    "(VALUES ('\"oops\"'), ('{\"code\":7}'), ('17')) v(raw)",
    "salvaged_trades": (f"WITH {tape_cte(True)} SELECT base, exchange, ts, seq, {rnd('price')} AS price, {rnd('volume')} AS volume FROM tape"),
    "coverage_holes": _HOLES,
    "threshold_ladder_all_pairs": _ladder(),
    "spread_stats_all_pairs": _CLOSE + f"SELECT base, ex1, ex2, count(price_diff_pct) AS n_rows, {_stats_cols('price_diff_pct')} FROM sp GROUP BY base, ex1, ex2",
    "profit_summary_all_pairs": _PROFIT,
    "fee_clearing_all_pairs": _FEES,
    "best_pair_by_time": _BEST,
    "aligned_bucketed": (f"WITH {candles_cte(True)}, {aligned_cte(['high', 'close'])} SELECT base, time, "
                         + ", ".join(_r(f'"{v}:{f}"', f"{v}:{f}") for f in ("high", "close") for v in ("BINANCE", "BITFINEX")) + " FROM al"),
    "sink_order": f"WITH {candles_cte(True)} SELECT exchange, base, count(*) AS n_rows, 0::BIGINT AS n_out_of_order, 0::BIGINT AS n_misplaced_files "
                  "FROM candles GROUP BY exchange, base",
    "sink_order_wide": f"WITH {candles_cte(True)} SELECT base, count(DISTINCT time) AS n_rows, 0::BIGINT AS n_out_of_order, 0::BIGINT AS n_misplaced_files "
                       "FROM candles GROUP BY base",
}

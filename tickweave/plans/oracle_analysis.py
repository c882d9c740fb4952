"""DuckDB SQL equal to the analysis jobs (correctness oracle).

Written independently of the Spark code: straight SQL over the driver views.
Doubles are rounded to 6 digits on both sides; cost constants are written as
DOUBLE sums so that 0.2 + 0.1 keeps its binary value.
"""
from __future__ import annotations

from ..sources.tape import sql_events_trades, sql_lineitem_trades
from .common import EX1, EX2

R = 6


def rnd(expr: str) -> str:
    """Same rounding as the Spark side: snap to a 2^-24 grid, then round(x * 1e6) / 1e6,
    then + 0.0.  Values that differ only in their last bits (summation order) end up
    identical in both engines, also at decimal rounding ties."""
    return f"(round((round(({expr}) * 16777216.0) / 16777216.0) * 1e{R}) / 1e{R} + 0.0)"


def _r(expr: str, alias: str) -> str:
    return f"{rnd(expr)} AS \"{alias}\""


def tape_cte(multi: bool) -> str:
    return f"tape AS ({sql_events_trades(multi)})"


def candles_cte(multi: bool, where: str = "") -> str:
    return (f"{tape_cte(multi)}, candles AS ("
            "SELECT base, exchange, date_trunc('hour', ts) AS time, "
            "arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, "
            "arg_max(price, ts) AS close, coalesce(sum(volume), 0) AS volume "
            f"FROM tape WHERE ts IS NOT NULL {where} GROUP BY base, exchange, date_trunc('hour', ts))")


CANDLE_OUT = ("base, exchange, time, " + ", ".join(_r(f, f) for f in
                                                     ("open", "high", "low", "close", "volume")))

VENUES = ["COINBASE", "BINANCE", "BITFINEX", "MEXC", "GATEIO", "KRAKEN"]
PRESENT = ["COINBASE", "BINANCE", "BITFINEX", "MEXC", "KRAKEN"]
FIELDS = ["open", "high", "low", "close", "volume"]


def wide_select(fields=FIELDS, venues=PRESENT) -> str:
    cols = ", ".join(
        f"{rnd(f"max({f}) FILTER (WHERE exchange = '{v}')")} AS \"{v}:{f}\""
        for v in venues for f in fields)
    return f"SELECT base, time, {cols} FROM candles GROUP BY base, time"


def aligned_cte(fields) -> str:
    a = ", ".join(f"{f} AS \"{EX1}:{f}\"" for f in fields)
    b = ", ".join(f"{f} AS \"{EX2}:{f}\"" for f in fields)
    cols = ", ".join(f"\"{v}:{f}\"" for f in fields for v in (EX1, EX2))
    notnull = " AND ".join(f"\"{v}:{f}\" IS NOT NULL" for f in fields for v in (EX1, EX2))
    return (f"a AS (SELECT base, time, {a} FROM candles WHERE exchange = '{EX1}'), "
            f"b AS (SELECT base, time, {b} FROM candles WHERE exchange = '{EX2}'), "
            f"al AS (SELECT base, time, {cols} FROM a JOIN b USING (base, time) WHERE {notnull})")


def spread_cte(field: str) -> str:
    p1, p2 = f"\"{EX1}:{field}\"", f"\"{EX2}:{field}\""
    return (f"sp AS (SELECT *, {p1} - {p2} AS price_diff, "
            f"({p1} - {p2}) / nullif({p2}, 0) * 100.0 AS price_diff_pct, "
            f"abs(({p1} - {p2}) / nullif({p2}, 0) * 100.0) AS abs_price_diff_pct FROM al)")


def spread_high_cte() -> str:
    return (spread_cte("high") + ", sph AS (SELECT *, abs(price_diff) AS profit_per_btc, "
            f"CASE WHEN price_diff > 0 THEN 'SELL {EX1}, BUY {EX2}' "
            f"ELSE 'SELL {EX2}, BUY {EX1}' END AS arbitrage_direction FROM sp)")


CLOSE = f"WITH {candles_cte(False)}, {aligned_cte(['high', 'close'])}, {spread_cte('close')} "
HIGH = f"WITH {candles_cte(False)}, {aligned_cte(['high'])}, {spread_high_cte()} "
COST = "(0.2::DOUBLE + 0.1::DOUBLE)"
CUT = "(0.2::DOUBLE + 0.1::DOUBLE + 0.5::DOUBLE)"
LADDER = [0.1, 0.2, 0.3, 0.5, 0.8, 1.0, 1.5, 2.0]
PCTS = [50, 75, 90, 95, 99, 99.9]


def _stats_cols(x: str, prefix: str = "") -> str:
    return (f"{_r(f'avg({x})', prefix + 'mean')}, {_r(f'stddev_samp({x})', prefix + 'std')}, "
            f"{_r(f'min({x})', prefix + 'min')}, {_r(f'max({x})', prefix + 'max')}")


def _ladder() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {t!r}::DOUBLE AS threshold, count(*) FILTER (WHERE abs_price_diff_pct >= {t!r}::DOUBLE) AS n_rows, "
        f"count(*) AS total FROM sp" for t in LADDER)
    return (CLOSE + f", lad AS ({rows}) SELECT threshold, n_rows, "
            f"{rnd('n_rows::DOUBLE / nullif(total, 0)::DOUBLE * 100.0')} AS share_pct, "
            f"threshold > {COST} AS profitable FROM lad")


CLOSE_MULTI = f"WITH {candles_cte(True)}, {aligned_cte(['high', 'close'])}, {spread_cte('close')} "


def _ladder_by_base() -> str:
    rows = " UNION ALL ".join(
        f"SELECT base, {t!r}::DOUBLE AS threshold, count(*) FILTER (WHERE abs_price_diff_pct >= {t!r}::DOUBLE) "
        f"AS n_rows, count(*) AS total FROM sp GROUP BY base" for t in LADDER)
    return (CLOSE_MULTI + f", lad AS ({rows}) SELECT base, threshold, n_rows, "
            f"{rnd('n_rows::DOUBLE / nullif(total, 0)::DOUBLE * 100.0')} AS share_pct, "
            f"threshold > {COST} AS profitable FROM lad")


def _profit_by_base() -> str:
    return (CLOSE_MULTI + f", s AS (SELECT base, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE abs_price_diff_pct >= {CUT}) AS n_profitable, "
            f"sum(p) AS total_profit, avg(p) AS mean_profit, max(p) AS best_profit, min(p) AS worst_profit "
            f"FROM (SELECT *, CASE WHEN abs_price_diff_pct >= {CUT} THEN "
            f"(abs_price_diff_pct - {COST}) * \"{EX2}:close\" / 100.0 END AS p FROM sp) GROUP BY base) "
            f"SELECT base, n_rows, n_profitable, {rnd('n_profitable::DOUBLE / nullif(n_rows, 0)::DOUBLE * 100.0')} "
            "AS share_pct, " + ", ".join(_r(x, x) for x in ("total_profit", "mean_profit", "best_profit", "worst_profit"))
            + " FROM s")


HIGH_MULTI = f"WITH {candles_cte(True)}, {aligned_cte(['high'])}, {spread_high_cte()} "


def _fee_by_base() -> str:
    hit = "abs(price_diff_pct) > 0.2::DOUBLE"
    return (HIGH_MULTI + f", s AS (SELECT base, count(*) AS n_rows, count(*) FILTER (WHERE {hit}) AS n_clearing, "
            f"avg(profit_per_btc) FILTER (WHERE {hit}) AS mean_profit, "
            f"avg(abs(price_diff_pct)) FILTER (WHERE {hit}) AS mean_abs_pct, "
            f"max(profit_per_btc) FILTER (WHERE {hit}) AS best_profit, "
            f"sum(profit_per_btc) FILTER (WHERE {hit}) AS total_profit FROM sph GROUP BY base) "
            f"SELECT base, n_rows, n_clearing, {rnd('n_clearing::DOUBLE / nullif(n_rows, 0)::DOUBLE * 100.0')} AS share_pct, "
            + ", ".join(_r(x, x) for x in ("mean_profit", "mean_abs_pct", "best_profit", "total_profit"))
            + f", {rnd('total_profit / nullif(n_clearing, 0)::DOUBLE')} AS profit_per_trade FROM s")


def _histogram() -> str:
    return (CLOSE + ", rng AS (SELECT min(price_diff_pct) AS mn, max(price_diff_pct) AS mx, "
            "count(price_diff_pct) AS n FROM sp), "
            "edges AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, "
            "CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM rng WHERE n > 0), "
            "binned AS (SELECT least(floor((price_diff_pct - lo) / (hi - lo) * 100), 99)::INTEGER AS bin "
            "FROM sp, edges WHERE price_diff_pct IS NOT NULL), "
            "counts AS (SELECT bin, count(*) AS n_rows FROM binned GROUP BY bin), "
            "grid AS (SELECT lo, hi, range::INTEGER AS bin FROM edges, range(0, 100)) "
            f"SELECT grid.bin, (round((round((lo + grid.bin * ((hi - lo) / 100)) * 16777216.0) / 16777216.0) * 1e{R}) / 1e{R} + 0.0) AS bin_lo, "
            f"(round((round((lo + (grid.bin + 1) * ((hi - lo) / 100)) * 16777216.0) / 16777216.0) * 1e{R}) / 1e{R} + 0.0) AS bin_hi, "
            "coalesce(counts.n_rows, 0)::BIGINT AS n_rows FROM grid LEFT JOIN counts USING (bin)")


def _fill_gaps() -> str:
    return (f"WITH {candles_cte(True)}, ext AS (SELECT base, exchange, min(time) AS t0, max(time) AS t1 "
            "FROM candles GROUP BY base, exchange), "
            "grid AS (SELECT base, exchange, unnest(range(t0, t1 + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time FROM ext) "
            "SELECT g.base, g.exchange, g.time, "
            + ", ".join(_r(f"c.{f}", f) for f in ("open", "high", "low", "close"))
            + f", {rnd('coalesce(c.volume, 0)')} AS volume "
            "FROM grid g LEFT JOIN candles c USING (base, exchange, time)")


def _preview() -> str:
    return (f"WITH {candles_cte(True)}, r AS (SELECT *, "
            "row_number() OVER (PARTITION BY base, exchange ORDER BY time) AS h, "
            "row_number() OVER (PARTITION BY base, exchange ORDER BY time DESC) AS t FROM candles) "
            f"SELECT {CANDLE_OUT}, 'head' AS part FROM r WHERE h <= 5 UNION ALL "
            f"SELECT {CANDLE_OUT}, 'tail' AS part FROM r WHERE t <= 5")


def _chart_series() -> str:
    parts = " UNION ALL ".join(
        f"SELECT base, '{v}' AS exchange, time, high FROM candles WHERE exchange = '{v}' AND high IS NOT NULL"
        for v in ["BINANCE", "BITFINEX", "COINBASE"])
    return f"WITH {candles_cte(False)} SELECT base, exchange, time, {rnd('high')} AS high FROM ({parts})"


_BULK = (f"WITH tape AS ({sql_lineitem_trades()}), candles AS (SELECT base, exchange, "
         "date_trunc('hour', ts) AS time, arg_min(price, {'t': ts, 's': seq, 'e': e, 'v': volume}) AS open, max(price) AS high, "
         "min(price) AS low, arg_max(price, {'t': ts, 's': seq, 'e': e, 'v': volume}) AS close, coalesce(sum(volume), 0) AS volume "
         "FROM tape WHERE ts IS NOT NULL GROUP BY base, exchange, date_trunc('hour', ts)) "
         f"SELECT {CANDLE_OUT} FROM candles")

_US = 300 * 60 * 1_000_000


def _chunked(tape: str, bucket: str) -> str:
    """Candles per inclusive 300-minute request; the earlier request's candle wins."""
    order = "{'t': ts, 's': seq}"
    return (f"WITH {tape}, st AS (SELECT date_trunc('hour', min(ts)) AS s FROM tape), "
            "tg AS (SELECT t.*, epoch_us(t.ts) - epoch_us(st.s) AS off FROM tape t, st), "
            f"ch AS (SELECT *, off // {_US} AS k FROM tg UNION ALL "
            f"SELECT *, off // {_US} - 1 AS k FROM tg WHERE off % {_US} = 0 AND off // {_US} >= 1), "
            f"pc AS (SELECT base, exchange, k, {bucket} AS time, arg_min(price, {order}) AS open, "
            f"max(price) AS high, min(price) AS low, arg_max(price, {order}) AS close, "
            f"coalesce(sum(volume), 0) AS volume FROM ch GROUP BY base, exchange, k, {bucket}), "
            "candles AS (SELECT base, exchange, time, arg_min(open, k) AS open, arg_min(high, k) AS high, "
            "arg_min(low, k) AS low, arg_min(close, k) AS close, arg_min(volume, k) AS volume "
            "FROM pc GROUP BY base, exchange, time) "
            f"SELECT {CANDLE_OUT} FROM candles")


_BORDER_TAPE = (f"raw AS ({sql_events_trades(True)}), "
                "tape AS (SELECT * REPLACE (time_bucket(INTERVAL 10 MINUTE, ts) AS ts) FROM raw)")

SQL = {
    "ohlc": f"WITH {candles_cte(True)} SELECT {CANDLE_OUT} FROM candles",
    "ohlc_bulk": _BULK,
    "ohlc_gapfill": _fill_gaps(),
    "series_extent": (f"WITH {candles_cte(True)} SELECT base, exchange, count(*) AS n_rows, "
                      "min(time) AS first_time, max(time) AS last_time FROM candles GROUP BY base, exchange"),
    "trade_range": _chunked(tape_cte(True), "date_trunc('hour', ts)"),
    "border_trades": _chunked(_BORDER_TAPE, "time_bucket(INTERVAL 30 MINUTE, ts)"),
    "trade_window": (f"WITH {tape_cte(True)} SELECT base, exchange, count(*) AS n_trades, min(ts) AS first_ts, "
                     f"max(ts) AS last_ts, {_r('sum(volume)', 'volume')} FROM tape "
                     "WHERE ts <= (SELECT min(ts) FROM tape) + INTERVAL 3 DAY GROUP BY base, exchange"),
    "candle_stats": (f"WITH {candles_cte(True)} SELECT base, exchange, "
                     f"{_r('min(open)', 'min_open')}, {_r('max(open)', 'max_open')}, "
                     f"{_r('min(close)', 'min_close')}, {_r('max(close)', 'max_close')}, "
                     f"{_r('sum(volume)', 'total_volume')} FROM candles GROUP BY base, exchange"),
    "coverage": (f"WITH {candles_cte(True)}, e AS (SELECT base, exchange, min(time) AS first_time, "
                 "max(time) AS last_time, count(*) AS present FROM candles GROUP BY base, exchange) "
                 "SELECT base, exchange, first_time, last_time, present, "
                 "(date_diff('second', first_time, last_time) // 3600 + 1)::BIGINT AS expected, "
                 "(date_diff('second', first_time, last_time) // 3600 + 1 - present)::BIGINT AS missing FROM e"),
    "candle_preview": _preview(),
    "wide_candles": f"WITH {candles_cte(True)} {wide_select()}",
    "wide_candles_chain": f"WITH {candles_cte(True)} {wide_select()}",
    "wide_extent": (f"WITH {candles_cte(True)}, w AS ({wide_select()}) SELECT count(*) AS n_rows, "
                    f"min(time) AS first_time, max(time) AS last_time, (2 + {len(PRESENT) * len(FIELDS)})::INTEGER "
                    "AS n_columns FROM w"),
    "aligned_pair": (f"WITH {candles_cte(False)}, {aligned_cte(['high', 'close'])} SELECT base, time, "
                     + ", ".join(_r(f'"{v}:{f}"', f"{v}:{f}") for f in ("high", "close") for v in (EX1, EX2))
                     + " FROM al"),
    "spread_close": (CLOSE + "SELECT base, time, "
                     + ", ".join(_r(f'"{v}:{f}"', f"{v}:{f}") for f in ("high", "close") for v in (EX1, EX2))
                     + f", {_r('price_diff', 'price_diff')}, {_r('price_diff_pct', 'price_diff_pct')}, "
                     f"{_r('abs_price_diff_pct', 'abs_price_diff_pct')} FROM sp"),
    "spread_high": (HIGH + f"SELECT base, time, {_r(chr(34) + EX1 + ':high' + chr(34), EX1 + ':high')}, "
                    f"{_r(chr(34) + EX2 + ':high' + chr(34), EX2 + ':high')}, "
                    f"{_r('price_diff', 'price_diff')}, {_r('price_diff_pct', 'price_diff_pct')}, "
                    f"{_r('abs_price_diff_pct', 'abs_price_diff_pct')}, {_r('profit_per_btc', 'profit_per_btc')}, "
                    "arbitrage_direction FROM sph"),
    "spread_stats": (CLOSE + f"SELECT count(price_diff_pct) AS n_rows, {_stats_cols('price_diff_pct')}, "
                     f"{_r('quantile_cont(price_diff_pct, 0.5)', 'median')} FROM sp"),
    "spread_stats_high": (HIGH + "SELECT count(*) AS n_rows, "
                          + _stats_cols("price_diff", "diff_") + ", " + _stats_cols("price_diff_pct", "pct_")
                          + f", {_r('avg(profit_per_btc)', 'profit_mean')}, {_r('max(profit_per_btc)', 'profit_max')}, "
                          f"{_r('quantile_cont(profit_per_btc, 0.5)', 'profit_median')} FROM sph"),
    "spread_percentiles": (CLOSE + "SELECT " + ", ".join(
        _r(f"quantile_cont(abs_price_diff_pct, {p / 100.0!r})", f"p{str(p).replace('.', '_')}") for p in PCTS)
        + " FROM sp"),
    "spread_percentiles_by_base": (CLOSE_MULTI + "SELECT base, " + ", ".join(
        _r(f"quantile_cont(abs_price_diff_pct, {p / 100.0!r})", f"p{str(p).replace('.', '_')}") for p in PCTS)
        + " FROM sp GROUP BY base"),
    "fee_clearing_summary_by_base": _fee_by_base(),
    "threshold_ladder": _ladder(),
    "threshold_ladder_by_base": _ladder_by_base(),
    "profit_summary_by_base": _profit_by_base(),
    "profit_summary": (CLOSE + f", s AS (SELECT count(*) AS n_rows, "
                       f"count(*) FILTER (WHERE abs_price_diff_pct >= {CUT}) AS n_profitable, "
                       f"sum(p) AS total_profit, avg(p) AS mean_profit, max(p) AS best_profit, min(p) AS worst_profit "
                       f"FROM (SELECT *, CASE WHEN abs_price_diff_pct >= {CUT} THEN "
                       f"(abs_price_diff_pct - {COST}) * \"{EX2}:close\" / 100.0 END AS p FROM sp)) "
                       f"SELECT n_rows, n_profitable, {rnd('n_profitable::DOUBLE / nullif(n_rows, 0)::DOUBLE * 100.0')} AS share_pct, "
                       + ", ".join(_r(x, x) for x in ("total_profit", "mean_profit", "best_profit", "worst_profit"))
                       + " FROM s"),
    "fee_clearing_summary": (HIGH + ", s AS (SELECT count(*) AS n_rows, "
                             "count(*) FILTER (WHERE abs(price_diff_pct) > 0.2::DOUBLE) AS n_clearing, "
                             "avg(profit_per_btc) FILTER (WHERE abs(price_diff_pct) > 0.2::DOUBLE) AS mean_profit, "
                             "avg(abs(price_diff_pct)) FILTER (WHERE abs(price_diff_pct) > 0.2::DOUBLE) AS mean_abs_pct, "
                             "max(profit_per_btc) FILTER (WHERE abs(price_diff_pct) > 0.2::DOUBLE) AS best_profit, "
                             "sum(profit_per_btc) FILTER (WHERE abs(price_diff_pct) > 0.2::DOUBLE) AS total_profit FROM sph) "
                             f"SELECT n_rows, n_clearing, {rnd('n_clearing::DOUBLE / nullif(n_rows, 0)::DOUBLE * 100.0')} AS share_pct, "
                             + ", ".join(_r(x, x) for x in ("mean_profit", "mean_abs_pct", "best_profit", "total_profit"))
                             + f", {rnd('total_profit / nullif(n_clearing, 0)::DOUBLE')} AS profit_per_trade FROM s"),
    "top20_spreads": (CLOSE + f"SELECT base, time, {_r(chr(34) + EX1 + ':close' + chr(34), 'price1')}, "
                      f"{_r(chr(34) + EX2 + ':close' + chr(34), 'price2')}, {_r('abs_price_diff_pct', 'abs_price_diff_pct')}, "
                      f"{_r('abs(price_diff) - ' + chr(34) + EX2 + ':close' + chr(34) + ' * ' + COST + ' / 100.0', 'net_profit')}, "
                      f"CASE WHEN price_diff > 0 THEN 'SELL {EX1}, BUY {EX2}' ELSE 'SELL {EX2}, BUY {EX1}' END AS direction "
                      "FROM sp ORDER BY abs_price_diff_pct DESC, time ASC LIMIT 20"),
    "top20_spreads_by_base": (CLOSE_MULTI + ", t AS (SELECT *, row_number() OVER (PARTITION BY base "
                              "ORDER BY abs_price_diff_pct DESC, time ASC) AS rank FROM sp) "
                              f"SELECT base, time, {_r(chr(34) + EX1 + ':close' + chr(34), 'price1')}, "
                              f"{_r(chr(34) + EX2 + ':close' + chr(34), 'price2')}, {_r('abs_price_diff_pct', 'abs_price_diff_pct')}, "
                              f"{_r('abs(price_diff) - ' + chr(34) + EX2 + ':close' + chr(34) + ' * ' + COST + ' / 100.0', 'net_profit')}, "
                              f"CASE WHEN price_diff > 0 THEN 'SELL {EX1}, BUY {EX2}' ELSE 'SELL {EX2}, BUY {EX1}' END AS direction, "
                              "rank::INTEGER AS rank FROM t WHERE rank <= 20"),
    "top5_profit": (HIGH + f"SELECT base, time, {_r(chr(34) + EX1 + ':high' + chr(34), 'price1')}, "
                    f"{_r(chr(34) + EX2 + ':high' + chr(34), 'price2')}, {_r('profit_per_btc', 'profit_per_btc')}, "
                    f"{_r('price_diff_pct', 'price_diff_pct')}, arbitrage_direction FROM sph "
                    "WHERE abs(price_diff_pct) > 0.2::DOUBLE ORDER BY profit_per_btc DESC, time ASC LIMIT 5"),
    "spread_histogram": _histogram(),
    "chart_spread_band": (CLOSE + f"SELECT base, time, {_r('price_diff_pct', 'price_diff_pct')}, "
                          f"{rnd(COST)} AS band_hi, {rnd('-' + COST)} AS band_lo FROM sp"),
    "chart_spread_minmax": (CLOSE + ", rg AS (SELECT min(epoch_us(time)) AS lo, max(epoch_us(time)) AS hi FROM sp), "
                            "px AS (SELECT sp.*, least(floor((epoch_us(time) - lo) * 200 / greatest(hi - lo, 1)), 199)::BIGINT "
                            "AS pixel FROM sp, rg) SELECT base, pixel, min(time) AS t_first, max(time) AS t_last, "
                            f"count(*) AS n_rows, {_r('min(price_diff_pct)', 'y_min')}, {_r('max(price_diff_pct)', 'y_max')} "
                            "FROM px GROUP BY base, pixel"),
    "chart_parity": (HIGH + f"SELECT base, time, {_r(chr(34) + EX1 + ':high' + chr(34), 'x')}, "
                     f"{_r(chr(34) + EX2 + ':high' + chr(34), 'y')}, "
                     "CASE WHEN price_diff > 0 THEN 'red' ELSE 'green' END AS colour FROM sph"),
    "chart_parity_bounds": (f"WITH {candles_cte(False)}, {aligned_cte(['high'])} SELECT "
                            f"(round((round((least(min(\"{EX1}:high\"), min(\"{EX2}:high\"))) * 16777216.0) / 16777216.0) * 1e{R}) / 1e{R} + 0.0) AS axis_min, "
                            f"(round((round((greatest(max(\"{EX1}:high\"), max(\"{EX2}:high\"))) * 16777216.0) / 16777216.0) * 1e{R}) / 1e{R} + 0.0) AS axis_max FROM al"),
    "chart_profit_time": HIGH + f"SELECT base, time, {_r('profit_per_btc', 'profit_per_btc')} FROM sph",
    "chart_series": _chart_series(),
}

# the same reports of another venue pair (the tape's own venue mapping stays as it is)
_TAPE = sql_events_trades(False)
SQL.update({f"{key}_other_pair": SQL[key].replace(_TAPE, "@").replace(EX1, "COINBASE").replace(EX2, "KRAKEN").replace("@", _TAPE)
            for key in ("threshold_ladder", "top20_spreads", "spread_high")})

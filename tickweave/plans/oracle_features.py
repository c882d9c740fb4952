"""DuckDB SQL equal to the feature jobs (plain per-series window functions)."""
from __future__ import annotations

from .common import EX1, EX2
from .oracle_analysis import R, _r, aligned_cte, candles_cte, rnd

FIELDS = ["high", "low", "close", "volume"]
WINDOWS = [5, 10, 20]


def _q(v: str, f: str) -> str:
    return f'"{v}:{f}"'


def basic_cte(multi: bool) -> str:
    h1, h2 = _q(EX1, "high"), _q(EX2, "high")
    l1, l2 = _q(EX1, "low"), _q(EX2, "low")
    v1, v2 = _q(EX1, "volume"), _q(EX2, "volume")
    return (f"WITH {candles_cte(multi)}, {aligned_cte(FIELDS)}, bf AS (SELECT *, "
            f"{h1} - {h2} AS price_diff, ({h1} - {h2}) / nullif({h2}, 0) * 100.0 AS price_diff_pct, "
            f"{h1} - {l1} AS \"{EX1}_spread\", {h2} - {l2} AS \"{EX2}_spread\", "
            f"({h1} - {l1}) - ({h2} - {l2}) AS spread_diff, "
            f"{v1} / nullif({v2} + 1e-10, 0) AS volume_ratio, "
            "hour(time)::INTEGER AS hour, minute(time)::INTEGER AS minute, "
            "(isodow(time) - 1)::INTEGER AS day_of_week, "
            f"(abs(({h1} - {h2}) / nullif({h2}, 0) * 100.0) >= 0.8::DOUBLE)::INTEGER AS arbitrage_opportunity, "
            "row_number() OVER (PARTITION BY base ORDER BY time) - 1 AS i FROM al)")


def roll_cols(kind: str) -> list[tuple[str, str]]:
    s1, s2 = _q(EX1, "close"), _q(EX2, "close")
    out = []
    for w in WINDOWS:
        frame = f"OVER (PARTITION BY base ORDER BY time ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        if kind == "mean":
            out += [(f"{EX1}_ma_{w}", f"CASE WHEN i >= {w - 1} THEN avg({s1}) {frame} END"),
                    (f"{EX2}_ma_{w}", f"CASE WHEN i >= {w - 1} THEN avg({s2}) {frame} END"),
                    (f"price_diff_ma_{w}", f"CASE WHEN i >= {w - 1} THEN avg(price_diff) {frame} END")]
        elif kind == "std":
            out += [(f"{EX1}_volatility_{w}", f"CASE WHEN i >= {w - 1} THEN stddev_samp({s1}) {frame} END"),
                    (f"{EX2}_volatility_{w}", f"CASE WHEN i >= {w - 1} THEN stddev_samp({s2}) {frame} END")]
        else:
            lag = "OVER (PARTITION BY base ORDER BY time)"
            out += [(f"{EX1}_momentum_{w}",
                     f"CASE WHEN i >= {w} THEN {s1} / nullif(lag({s1}, {w}) {lag}, 0) - 1 END"),
                    (f"{EX2}_momentum_{w}",
                     f"CASE WHEN i >= {w} THEN {s2} / nullif(lag({s2}, {w}) {lag}, 0) - 1 END")]
    return out


def _rolling(kind: str) -> str:
    cols = roll_cols(kind)
    inner = ", ".join(f"{e} AS \"{n}\"" for n, e in cols)
    outer = ", ".join(_r(f'"{n}"', n) for n, _ in cols)
    return basic_cte(True) + f", rr AS (SELECT base, time, {inner} FROM bf) SELECT base, time, {outer} FROM rr"


def full_cte() -> str:
    """Full feature rows (with the lead-in rows still present) as ``ff``; ``fd`` drops them."""
    cols = []
    for w in WINDOWS:
        # keep the reference column order inside each window size
        kinds = dict((n, e) for k in ("mean", "std", "momentum") for n, e in roll_cols(k))
        for n in (f"{EX1}_ma_{w}", f"{EX2}_ma_{w}", f"price_diff_ma_{w}", f"{EX1}_volatility_{w}",
                  f"{EX2}_volatility_{w}", f"{EX1}_momentum_{w}", f"{EX2}_momentum_{w}"):
            cols.append((n, kinds[n]))
    raw = [_q(v, f) for f in FIELDS for v in (EX1, EX2)]
    names = (["base", "time"] + raw + ["price_diff", "price_diff_pct", f'"{EX1}_spread"', f'"{EX2}_spread"',
                                        "spread_diff", "volume_ratio"])
    roll = ", ".join(f"{e} AS \"{n}\"" for n, e in cols)
    every = names + [f'"{n}"' for n, _ in cols] + ["hour", "minute", "day_of_week", "arbitrage_opportunity"]
    notnull = " AND ".join(f"{x} IS NOT NULL" for x in every)
    return (basic_cte(False) + f", ff AS (SELECT {', '.join(names)}, {roll}, hour, minute, day_of_week, "
            f"arbitrage_opportunity FROM bf), fd AS (SELECT * FROM ff WHERE {notnull})"), every


def _features_full() -> str:
    cte, every = full_cte()
    outs = []
    for x in every:
        name = x.strip('"')
        if name in ("base", "time", "hour", "minute", "day_of_week", "arbitrage_opportunity"):
            outs.append(x)
        else:
            outs.append(_r(x, name))
    return cte + " SELECT " + ", ".join(outs) + " FROM fd"


def _stage_stats() -> str:
    cte, _ = full_cte()
    return (cte + ", st AS (SELECT count(price_diff_pct) AS n_rows, avg(price_diff_pct) AS mean, "
            "stddev_samp(price_diff_pct) AS std, min(price_diff_pct) AS min, max(price_diff_pct) AS max, "
            "quantile_cont(price_diff_pct, 0.5) AS median FROM fd), "
            "pb AS (SELECT quantile_cont(abs(price_diff_pct), 0.75) AS abs_p75, "
            "quantile_cont(abs(price_diff_pct), 0.90) AS abs_p90, quantile_cont(abs(price_diff_pct), 0.95) AS abs_p95, "
            "quantile_cont(abs(price_diff_pct), 0.99) AS abs_p99 FROM bf) "
            "SELECT n_rows, " + ", ".join(_r(x, x) for x in ("mean", "std", "min", "max", "median", "abs_p75",
                                                                "abs_p90", "abs_p95", "abs_p99"))
            + " FROM st, pb")


SQL = {
    "features_basic": (basic_cte(False) + " SELECT base, time, " + ", ".join(
        _r(x, x.strip('"')) for x in ("price_diff", "price_diff_pct", f'"{EX1}_spread"', f'"{EX2}_spread"',
                                      "spread_diff", "volume_ratio"))
        + ", hour, minute, day_of_week, arbitrage_opportunity FROM bf"),
    "rolling_mean": _rolling("mean"),
    "rolling_std": _rolling("std"),
    "momentum": _rolling("momentum"),
    "features_full": _features_full(),
    "label_rate": (full_cte()[0] + ", per AS (SELECT arbitrage_opportunity AS label, count(*) AS n_rows FROM fd "
                   f"GROUP BY 1) SELECT label, n_rows, {rnd('n_rows * 100.0 / sum(n_rows) OVER ()')} AS share_pct "
                   "FROM per"),
    "feature_stage_stats": _stage_stats(),
}

"""DuckDB SQL for the model jobs that SQL can express (guard and split sizes)."""
from __future__ import annotations

from ..operators.model import CLASS_NAMES, SEED
from .oracle_analysis import rnd
from .oracle_features import full_cte

_FD = full_cte()[0]

# stratified split sizes: ceil(0.2 n) test rows; train rows per class by floors and
# largest remainders (ties to the lower label); test rows per class are the rest
_ALLOC = (_FD + ", pc AS (SELECT arbitrage_opportunity AS label, count(*) AS c FROM fd GROUP BY 1), "
          "tot AS (SELECT sum(c) AS n, sum(c) - ceil(sum(c) * 0.2::DOUBLE) AS n_train FROM pc), "
          "fl AS (SELECT label, c, c::DOUBLE / n::DOUBLE * n_train::DOUBLE AS cont, "
          "floor(c::DOUBLE / n::DOUBLE * n_train::DOUBLE) AS fl, n_train FROM pc, tot), "
          "rk AS (SELECT *, n_train - sum(fl) OVER () AS lft, "
          "row_number() OVER (ORDER BY cont - fl DESC, label) AS r FROM fl), "
          "alloc AS (SELECT label, c, (fl + CASE WHEN r <= lft THEN 1 ELSE 0 END) AS tr FROM rk), "
          "s AS (SELECT 'test' AS split, label, (c - tr)::BIGINT AS n_rows FROM alloc UNION ALL "
          "SELECT 'train' AS split, label, tr::BIGINT AS n_rows FROM alloc) ")



def _hash(seed: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || base || '|' || CAST(time AS VARCHAR)), 1, 15) AS BIGINT)"


# rows in hash order per class; the first c - tr of a class are its test rows
_ROWS = (_ALLOC + ", ranked AS (SELECT *, arbitrage_opportunity AS label, row_number() OVER (PARTITION BY "
         f"arbitrage_opportunity ORDER BY {_hash(SEED)}, base, time) AS rnk FROM fd), "
         "sp AS (SELECT ranked.*, rnk <= c - tr AS is_test FROM ranked JOIN alloc USING (label)) ")
# nothing is fitted when the guard stops training
_FITTED = ("(SELECT count(*) FILTER (WHERE arbitrage_opportunity = 1) >= 10 "
           "AND count(*) FILTER (WHERE arbitrage_opportunity = 0) >= 2 FROM fd)")
_FEATURES = [x for x in (y.strip('"') for y in full_cte()[1])
             if x not in ("base", "time", "price_diff", "price_diff_pct", "arbitrage_opportunity")]

# a fixed rule as predictor: |mean difference of five buckets| > 1
_RULE = (_FD + ", cells AS (SELECT arbitrage_opportunity AS a, CAST(abs(price_diff_ma_5) > 1.0 AS INTEGER) AS p, "
         "count(*) AS n FROM fd GROUP BY 1, 2), grid AS (SELECT a, p FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(p)), "
         "conf AS (SELECT grid.a, grid.p, coalesce(n, 0)::BIGINT AS n FROM grid LEFT JOIN cells USING (a, p)) ")
_PER = ("per AS (SELECT c, coalesce(hit / nullif(pred, 0), 0) AS pr, coalesce(hit / nullif(act, 0), 0) AS re, act, hit FROM ("
        "SELECT x.c, sum(CASE WHEN a = c AND p = c THEN n ELSE 0 END)::DOUBLE AS hit, "
        "sum(CASE WHEN p = c THEN n ELSE 0 END)::DOUBLE AS pred, sum(CASE WHEN a = c THEN n ELSE 0 END)::DOUBLE AS act "
        "FROM conf, (VALUES (0), (1)) x(c) GROUP BY x.c)), "
        "f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM per) ")
_REPORT = (_RULE + ", " + _PER + "".join([
    f"SELECT CASE c WHEN 0 THEN '{CLASS_NAMES[0]}' ELSE '{CLASS_NAMES[1]}' END AS class, {rnd('pr')} AS precision, "
    f"{rnd('re')} AS recall, {rnd('f1')} AS f1, act::BIGINT AS support FROM f UNION ALL ",
    f"SELECT 'accuracy', NULL, NULL, {rnd('sum(hit) / nullif(sum(act), 0)')}, sum(act)::BIGINT FROM f UNION ALL ",
    f"SELECT 'macro avg', {rnd('avg(pr)')}, {rnd('avg(re)')}, {rnd('avg(f1)')}, sum(act)::BIGINT FROM f UNION ALL ",
    f"SELECT 'weighted avg', {rnd('sum(pr * act) / sum(act)')}, {rnd('sum(re * act) / sum(act)')}, "
    f"{rnd('sum(f1 * act) / sum(act)')}, sum(act)::BIGINT FROM f"]))

SQL = {
    # the saved nodes must say what the forest says: every row, bin and feature agrees
    "node_predictions": _ROWS + "SELECT count(*) AS n_rows, count(*) AS n_same_class, count(*) AS n_same_probability FROM sp "
                        f"WHERE is_test HAVING {_FITTED}",
    "node_histogram": _ROWS + f"SELECT 50::BIGINT AS n_bins, 50::BIGINT AS n_same, count(*) AS n_rows FROM sp WHERE is_test HAVING {_FITTED}",
    "node_importances": _ROWS + f"SELECT {len(_FEATURES)}::BIGINT AS n_features, {len(_FEATURES)}::BIGINT AS n_same_importance, "
                        f"{len(_FEATURES)}::BIGINT AS n_same_rank FROM sp HAVING {_FITTED}",
    "node_rules": _ROWS + "SELECT 100::BIGINT AS n_trees, 0::BIGINT AS n_small_splits, 0::BIGINT AS n_small_leaves, 0::BIGINT AS n_orphans, "
                  f"0::BIGINT AS n_too_deep FROM sp HAVING {_FITTED}",
    "cv_node_accuracy": _ROWS + "SELECT 5::BIGINT AS n_folds, count(*) AS n_rows, 5::BIGINT AS n_same_accuracy FROM sp "
                        f"WHERE NOT is_test HAVING {_FITTED}",
    "split_rows": _ROWS + "SELECT base, time, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split FROM sp",
    "cv_fold_rows": (_ROWS + "SELECT base, time, CAST(floor(r * 5 / n) AS INTEGER) AS fold FROM (SELECT base, time, "
                     f"row_number() OVER (PARTITION BY label ORDER BY {_hash(SEED + 1)}, base, time) - 1 AS r, "
                     "count(*) OVER (PARTITION BY label) AS n FROM sp WHERE NOT is_test)"),
    "scaler_fit": (_ROWS + ", held AS (" + " UNION ALL ".join(
        f"SELECT '{x}' AS feature, avg({q}) AS m, stddev_samp({q}) AS s FROM sp WHERE NOT is_test HAVING {_FITTED}"
        for x in _FEATURES for q in ['"' + x + '"::DOUBLE'])
        + "), p AS (SELECT *, floor(log10(CASE WHEN m <> 0 THEN abs(m) ELSE 1 END)) AS mp, "
          "floor(log10(CASE WHEN s <> 0 THEN abs(s) ELSE 1 END)) AS sp FROM held) "
          f"SELECT feature, CAST(mp AS INTEGER) AS mean_power, {rnd('m / pow(10.0, mp)')} AS mean, "
          f"CAST(sp AS INTEGER) AS std_power, {rnd('s / pow(10.0, sp)')} AS std FROM p"),
    "rule_confusion": _RULE + "SELECT a AS actual, p AS predicted, n AS n_rows FROM conf",
    "rule_report": _REPORT,
    "class_support": _ROWS + "SELECT label, count(*) FILTER (WHERE is_test) AS n_rows FROM sp "
                     f"WHERE {_FITTED} GROUP BY label",
    "model_roundtrip": _ROWS + "SELECT count(*) AS n_rows, count(*) AS n_same FROM sp WHERE is_test "
                       f"HAVING {_FITTED}",
    "train_guard": (_FD + " SELECT count(*) FILTER (WHERE arbitrage_opportunity = 1) AS n_positive, "
                    "count(*) FILTER (WHERE arbitrage_opportunity = 0) AS n_negative, "
                    "(count(*) FILTER (WHERE arbitrage_opportunity = 1) >= 10 AND "
                    "count(*) FILTER (WHERE arbitrage_opportunity = 0) >= 2) AS trainable FROM fd"),
    "stratified_split": (_ALLOC + "SELECT split, label, n_rows FROM s WHERE n_rows > 0"),
    "split_rates": (_ALLOC + f"SELECT split, sum(n_rows)::BIGINT AS n_rows, "
                    f"{rnd('sum(n_rows * label)::DOUBLE / sum(n_rows)::DOUBLE * 100.0')} "
                    "AS label_rate_pct FROM s WHERE n_rows > 0 GROUP BY split"),
}

"""Invariants of the model jobs (no SQL oracle there) at sf0.01."""
import math

from pyspark.sql import functions as F

import __spark_entry__ as e

from paths import SF01

Q = e.queries()


def test_predictions_and_confusion(spark):
    pred = Q["rf_predictions"](spark, SF01)
    split = {r["split"]: r["n_rows"] for r in Q["split_rates"](spark, SF01).collect()}
    rows = pred.collect()
    assert len(rows) == split["test"]
    assert all(0.0 <= r["p_opportunity"] <= 1.0 and r["prediction"] in (0, 1) for r in rows)
    conf = {(r["actual"], r["predicted"]): r["n_rows"] for r in Q["confusion_matrix"](spark, SF01).collect()}
    assert set(conf) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert sum(conf.values()) == len(rows)
    rep = {r["class"]: r for r in Q["classification_report"](spark, SF01).collect()}
    assert rep["No Opportunity"]["support"] + rep["Opportunity"]["support"] == len(rows)
    acc = (conf[(0, 0)] + conf[(1, 1)]) / len(rows)
    assert math.isclose(rep["accuracy"]["f1"], round(acc, 6), abs_tol=1e-6)
    test_acc = {r["split"]: r["accuracy"] for r in Q["train_accuracy"](spark, SF01).collect()}["test"]
    assert math.isclose(test_acc, acc, abs_tol=1e-6)


def test_scaled_features_are_standardised(spark):
    rows = Q["scaled_features"](spark, SF01).collect()
    assert len(rows) == 36
    for r in rows:
        assert abs(r["mean"]) < 1e-6
        assert r["std"] == 0.0 or math.isclose(r["std"], 1.0, abs_tol=1e-6)


def test_importances_and_histogram(spark):
    imp = Q["feature_importance"](spark, SF01).orderBy("rank").collect()
    assert [r["rank"] for r in imp] == list(range(1, 37))
    assert math.isclose(sum(r["importance"] for r in imp), 1.0, abs_tol=1e-4)
    assert all(a["importance"] >= b["importance"] for a, b in zip(imp, imp[1:]))
    hist = Q["proba_histogram"](spark, SF01)
    assert hist.count() == 50
    assert hist.agg(F.sum("n_rows")).first()[0] == Q["rf_predictions"](spark, SF01).count()


def test_cv_and_roundtrip(spark):
    cv = Q["cv_accuracy"](spark, SF01).collect()
    assert len(cv) == 5 and all(0.0 <= r["accuracy"] <= 1.0 for r in cv)
    train_rows = {r["split"]: r["n_rows"] for r in Q["split_rates"](spark, SF01).collect()}["train"]
    assert sum(r["n_rows"] for r in cv) == train_rows
    rt = Q["model_roundtrip"](spark, SF01).first()
    assert rt["n_rows"] == rt["n_same"] > 0


def test_forest_independent_of_shuffle_partitions(spark):
    from tickweave.plans import model as mj
    from tickweave.session import release
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            mj._FITTED.clear()
            release()
            got.append(sorted(map(tuple, Q["rf_predictions"](spark, SF01).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        mj._FITTED.clear()
    assert got[0] == got[1] and len(got[0]) > 0


def test_duckdb_over_the_saved_nodes_agrees_with_the_forest(spark, tmp_path):
    """The node table is all another engine needs: classes, probabilities, importances."""
    import duckdb
    from tickweave.operators import model as mo
    from tickweave.operators import trees as tr
    from tickweave.plans import model as mj
    model, names, _, test = mj.trained(spark, SF01)
    nodes = tr.save_nodes(model, str(tmp_path / "forest"), spark)
    nodes.write.parquet(str(tmp_path / "nodes"))
    tr.scaled_rows(model, test, mj.KEYS).write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE n AS SELECT * FROM read_parquet('{tmp_path}/nodes/*.parquet')")
    con.execute(f"CREATE TABLE r AS SELECT * FROM read_parquet('{tmp_path}/rows/*.parquet')")
    got = {(b, t): (p, x) for b, t, p, x in con.sql("""
        WITH RECURSIVE w AS (SELECT base, time, x, tree, node FROM r, (SELECT DISTINCT tree, 0 AS node FROM n)
          UNION ALL SELECT w.base, w.time, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n.left ELSE n.right END
                    FROM w JOIN n USING (tree, node) WHERE n.left >= 0)
        SELECT base, time, (avg(class_weights[2] / list_sum(class_weights)) > avg(class_weights[1] / list_sum(class_weights)))::INT,
               avg(class_weights[2] / list_sum(class_weights)) FROM w JOIN n USING (tree, node) WHERE n.left < 0 GROUP BY base, time""").fetchall()}
    want = mo.predict(model, test, "arbitrage_opportunity").select("base", "time", "prediction", "p_opportunity").collect()
    assert len(got) == len(want) > 0
    for r in want:
        p, x = got[r.base, r.time]
        assert p == int(r.prediction) and math.isclose(x, r.p_opportunity, abs_tol=1e-9)
    sums = dict(con.sql("""WITH g AS (SELECT tree, feature, sum(gain * list_sum(class_weights)) AS g FROM n WHERE n.left >= 0 GROUP BY ALL),
        s AS (SELECT feature, sum(g / t) AS s FROM g JOIN (SELECT tree, sum(g) AS t FROM g GROUP BY tree) USING (tree) GROUP BY feature)
        SELECT feature, s / sum(s) OVER () FROM s""").fetchall())
    told = model.stages[-1].featureImportances.toArray()
    assert len(told) == len(names) and all(math.isclose(sums.get(i, 0.0), v, abs_tol=1e-9) for i, v in enumerate(told))


def test_node_rules_see_broken_trees(spark):
    from tickweave.operators import trees as tr
    schema = "tree int, node int, left int, right int, feature int, threshold double, gain double, n_rows long, class_weights array<double>"
    leaf = (-1, -1, None, None, -1.0)
    rows = [(0, 0, 1, 2, 0, 0.5, 1.0, 12, [6.0, 6.0]), (0, 1, *leaf, 6, [6.0, 0.0]), (0, 2, *leaf, 6, [0.0, 6.0]),
            (1, 0, 1, 2, 0, 0.5, 1.0, 9, [4.0, 5.0]), (1, 1, *leaf, 5, [4.0, 1.0]), (1, 2, 3, 4, 0, 0.9, 1.0, 10, [5.0, 5.0]),
            (1, 3, *leaf, 4, [4.0, 0.0]), (1, 4, *leaf, 6, [1.0, 5.0]), (1, 9, *leaf, 8, [1.0, 7.0])]
    got = tr.node_rules(spark.createDataFrame(rows, schema), 10, 5, 1).first()
    assert (got.n_trees, got.n_small_splits, got.n_small_leaves, got.n_orphans, got.n_too_deep) == (2, 1, 1, 1, 1)

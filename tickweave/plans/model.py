"""Registered jobs: training and evaluating the spread classifier.

The feature table is checkpointed (reliable checkpoint folder of the session)
before training: the forest makes many passes over it, and a lost executor then
re-reads the checkpoint instead of recomputing candles, joins and windows.
A fitted model is kept with the content of the feature table it was fitted on, so the
evaluation tables of one run share one fit and changed data get their own.
"""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import model as mo
from ..operators import trees as tr
from ..operators.spread import histogram
from ..session import checkpoint_dir, scratch_path
from .common import rounded
from .features import feature_table

KEYS = ["base", "time"]
_FITTED: dict = {}


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, checkpointed: its readers do not plan the windows again."""
    checkpoint_dir(spark)
    return feature_table(spark, sf_dir).checkpoint(eager=True)


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mo.stratified_split(stored_features(spark, sf_dir), fe.LABEL, KEYS)


def trained(spark: SparkSession, sf_dir: str):
    """(model, feature names, train, test) - or None when the guard stops training.

    A fit is shared by the evaluation tables of one session as long as the feature table
    is the same, rows and values (their count and summed hash)."""
    table = stored_features(spark, sf_dir)
    content = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, *content)
    if key in _FITTED:
        return _FITTED[key]
    counts = mo.class_counts(table, fe.LABEL)
    if counts.get(1, 0) < mo.MIN_POSITIVES or counts.get(0, 0) < 2:
        _FITTED[key] = None
        return None
    # the split is read by the weight counts, the forest's metadata passes and the
    # evaluation: materialise it once instead of re-ranking each time
    split = mo.stratified_split(table, fe.LABEL, KEYS).checkpoint(eager=True)
    names = fe.feature_columns(table)
    train = split.where(~F.col("is_test")).drop("is_test")
    test = split.where(F.col("is_test")).drop("is_test")
    model = mo.fit(train, names, fe.LABEL, layout_keys=KEYS)
    _FITTED[key] = (model, names, train, test)
    return _FITTED[key]


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def q_train_guard(spark, sf_dir):
    return mo.guard(feature_table(spark, sf_dir), fe.LABEL)


def q_stratified_split(spark, sf_dir):
    s = split_table(spark, sf_dir)
    return s.groupBy(F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train")).alias("split"),
                     F.col(fe.LABEL).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))


def q_split_rows(spark, sf_dir):
    """Which rows are held out."""
    s = split_table(spark, sf_dir)
    return s.select(*KEYS, F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train")).alias("split"))


def q_cv_fold_rows(spark, sf_dir):
    """Which fold each training row is evaluated in."""
    train = split_table(spark, sf_dir).where(~F.col("is_test")).drop("is_test").checkpoint(eager=True)
    return mo.with_fold(train, fe.LABEL, KEYS).select(*KEYS, "fold")


def q_scaler_fit(spark, sf_dir):
    """Mean and sample std that the fitted scaler holds for every feature, as mantissa and
    power of ten (the features' sizes span ten orders of magnitude)."""
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "feature string, mean_power int, mean double, std_power int, std double")
    model, names, _, _ = got
    scaler = model.stages[1]  # two numbers per feature, already on the driver
    rows = list(zip(names, scaler.mean.toArray().tolist(), scaler.std.toArray().tolist()))
    held = spark.createDataFrame(rows, "feature string, mean double, std double")
    power = {x: F.floor(F.log10(F.when(F.col(x) != 0, F.abs(x)).otherwise(1.0))).cast("int") for x in ("mean", "std")}
    return rounded(held.select("feature", power["mean"].alias("mean_power"), (F.col("mean") / F.pow(F.lit(10.0), power["mean"])).alias("mean"),
                               power["std"].alias("std_power"), (F.col("std") / F.pow(F.lit(10.0), power["std"])).alias("std")))


def rule_predictions(spark, sf_dir) -> DataFrame:
    """A fixed rule as predictor: the mean difference of five buckets is above 1."""
    return feature_table(spark, sf_dir).select(
        fe.LABEL, (F.abs("price_diff_ma_5") > 1.0).cast("double").alias("prediction"))


def q_rule_confusion(spark, sf_dir):
    return mo.confusion(rule_predictions(spark, sf_dir), fe.LABEL)


def q_rule_report(spark, sf_dir):
    return rounded(mo.report(mo.confusion(rule_predictions(spark, sf_dir), fe.LABEL)))


def q_class_support(spark, sf_dir):
    """Held-out rows per class, as the forest's confusion table has them."""
    pred = predictions(spark, sf_dir)
    if pred is None:
        return _empty(spark, "label int, n_rows long")
    return mo.confusion(pred, fe.LABEL).groupBy(F.col("actual").alias("label")).agg(F.sum("n_rows").alias("n_rows"))


def q_split_rates(spark, sf_dir):
    s = split_table(spark, sf_dir)
    return rounded(s.groupBy(F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train")).alias("split"))
                   .agg(F.count(F.lit(1)).alias("n_rows"),
                        (F.avg(F.col(fe.LABEL).cast("double")) * 100.0).alias("label_rate_pct")))


def q_scaled_features(spark, sf_dir):
    """Mean and sample std of every scaled training feature (mean 0, std 1),
    one ``Summarizer`` pass."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "feature string, mean double, std double")
    model, names, train, _ = got
    scaled = model.stages[1].transform(model.stages[0].transform(train))
    summ = scaled.select(Summarizer.metrics("mean", "std").summary(F.col("features")).alias("s"))
    arrs = summ.select(vector_to_array("s.mean").alias("m"), vector_to_array("s.std").alias("d"),
                       F.array(*[F.lit(n) for n in names]).alias("f"))
    rows = arrs.select(F.explode(F.arrays_zip("f", "m", "d")).alias("z"))
    return rounded(rows.select(F.col("z.f").alias("feature"), F.col("z.m").alias("mean"),
                               F.col("z.d").alias("std")))


def predictions(spark, sf_dir) -> DataFrame | None:
    got = trained(spark, sf_dir)
    if got is None:
        return None
    model, _, _, test = got
    return mo.predict(model, test, fe.LABEL)


def q_rf_predictions(spark, sf_dir):
    pred = predictions(spark, sf_dir)
    if pred is None:
        return _empty(spark, "base string, time timestamp_ntz, label int, prediction int, p_opportunity double")
    return rounded(pred.select("base", "time", F.col(fe.LABEL).cast("int").alias("label"),
                               F.col("prediction").cast("int").alias("prediction"), "p_opportunity"))


def q_confusion_matrix(spark, sf_dir):
    pred = predictions(spark, sf_dir)
    if pred is None:
        return _empty(spark, "actual int, predicted int, n_rows long")
    return mo.confusion(pred, fe.LABEL)


def q_classification_report(spark, sf_dir):
    pred = predictions(spark, sf_dir)
    if pred is None:
        return _empty(spark, "class string, precision double, recall double, f1 double, support long")
    return rounded(mo.report(mo.confusion(pred, fe.LABEL)))


def q_train_accuracy(spark, sf_dir):
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "split string, accuracy double, n_rows long")
    model, _, train, test = got
    parts = [mo.accuracy(mo.predict(model, d, fe.LABEL), fe.LABEL).select(F.lit(n).alias("split"), "*")
             for n, d in (("train", train), ("test", test))]
    return rounded(parts[0].unionByName(parts[1]))


def q_cv_accuracy(spark, sf_dir):
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "fold int, accuracy double, n_rows long, mean_accuracy double, two_std double")
    _, names, train, _ = got
    return rounded(mo.cross_validate(train, names, fe.LABEL, KEYS))


def q_feature_importance(spark, sf_dir):
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "feature string, importance double")
    model, names, _, _ = got
    return rounded(mo.importances(model, names))


def q_proba_histogram(spark, sf_dir):
    pred = predictions(spark, sf_dir)
    if pred is None:
        return _empty(spark, "bin int, bin_lo double, bin_hi double, n_rows long")
    return rounded(histogram(pred, "p_opportunity", 50))


def q_model_roundtrip(spark, sf_dir):
    """Save the pipeline model to the shared folder, load it back, and compare the
    test predictions of both."""
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "n_rows long, n_same long")
    from pyspark.ml import PipelineModel
    model, _, _, test = got
    path = scratch_path(spark, f"model-{spark.sparkContext.applicationId}")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = mo.predict(model, test, fe.LABEL).select(*KEYS, F.col("prediction").alias("p1"))
    b = mo.predict(back, test, fe.LABEL).select(*KEYS, F.col("prediction").alias("p2"))
    return a.join(b, KEYS).agg(F.count(F.lit(1)).alias("n_rows"),
                               F.count_if(F.col("p1") == F.col("p2")).alias("n_same"))


def forest_nodes(spark: SparkSession, model) -> DataFrame:
    return tr.save_nodes(model, scratch_path(spark, f"forest-{uuid.uuid4().hex}"), spark)


def _close(a: str, b: str):
    return F.abs(F.col(a) - F.col(b)) <= 1e-9


def q_node_predictions(spark, sf_dir):
    """Held-out rows walked down the saved nodes: how many get the forest's class and probability."""
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "n_rows long, n_same_class long, n_same_probability long")
    model, _, _, test = got
    ours = tr.predict_by_nodes(forest_nodes(spark, model), tr.scaled_rows(model, test, KEYS), KEYS, mo.N_TREES, mo.MAX_DEPTH)
    forest = mo.predict(model, test, fe.LABEL).select(*KEYS, F.col("prediction").cast("int").alias("c"), F.col("p_opportunity").alias("p"))
    return ours.join(forest, KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") == F.col("c")).alias("n_same_class"),
        F.count_if(_close("p_opportunity", "p")).alias("n_same_probability"))


def q_node_histogram(spark, sf_dir):
    """The probability chart from the saved nodes against the forest's own: bins, and bins that agree."""
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "n_bins long, n_same long, n_rows long")
    model, _, _, test = got
    ours = tr.predict_by_nodes(forest_nodes(spark, model), tr.scaled_rows(model, test, KEYS), KEYS, mo.N_TREES, mo.MAX_DEPTH)
    # sums of shares differ in their last bits with the order of the trees
    a = histogram(ours.select(F.round("p_opportunity", 9).alias("p")), "p", 50).select("bin", F.col("n_rows").alias("a"))
    b = histogram(mo.predict(model, test, fe.LABEL).select(F.round("p_opportunity", 9).alias("p")), "p", 50).select(
        "bin", F.col("n_rows").alias("b"))
    return a.join(b, "bin").agg(F.count(F.lit(1)).alias("n_bins"), F.count_if(F.col("a") == F.col("b")).alias("n_same"),
                                F.sum("a").alias("n_rows"))


def q_node_importances(spark, sf_dir):
    """Importances summed up from the saved splits against the model's: features, equal values, equal ranks."""
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "n_features long, n_same_importance long, n_same_rank long")
    model, names, _, _ = got
    ours = tr.importances_by_nodes(forest_nodes(spark, model), names)
    theirs = mo.importances(model, names).select("feature", F.col("rank").alias("r"), F.col("importance").alias("i"))
    return ours.join(theirs, "feature").agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if(_close("importance", "i")).alias("n_same_importance"),
        F.count_if(F.col("rank") == F.col("r")).alias("n_same_rank"))


def q_cv_node_accuracy(spark, sf_dir):
    """Each fold's accuracy from its own forest's saved nodes against the reported one."""
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "n_folds long, n_rows long, n_same_accuracy long")
    _, names, train, _ = got
    fitted: dict = {}
    reported = mo.cross_validate(train, names, fe.LABEL, KEYS, fitted=fitted).select("fold", F.col("accuracy").alias("told"))
    parts = []
    for fold, (model, held) in sorted(fitted.items()):
        ours = tr.predict_by_nodes(forest_nodes(spark, model), tr.scaled_rows(model, held, KEYS), KEYS, mo.N_TREES, mo.MAX_DEPTH)
        right = ours.join(held.select(*KEYS, F.col(fe.LABEL).cast("int").alias("label")), KEYS)
        parts.append(right.select(F.lit(fold).alias("fold"), (F.col("prediction") == F.col("label")).alias("right")))
    by = reduce(DataFrame.unionByName, parts).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("right").cast("double")).alias("seen"))
    return by.join(reported, "fold").agg(F.count(F.lit(1)).alias("n_folds"), F.sum("n").alias("n_rows"),
                                         F.count_if(_close("seen", "told")).alias("n_same_accuracy"))


def q_node_rules(spark, sf_dir):
    """Trees of the saved forest, and nodes that break its size rules (a split needs 10 rows, a leaf 5, a path 10 steps)."""
    got = trained(spark, sf_dir)
    if got is None:
        return _empty(spark, "n_trees long, n_small_splits long, n_small_leaves long, n_orphans long, n_too_deep long")
    return tr.node_rules(forest_nodes(spark, got[0]), mo.MIN_SPLIT, mo.MIN_LEAF, mo.MAX_DEPTH)


QUERIES = {
    "node_predictions": q_node_predictions,
    "node_histogram": q_node_histogram,
    "node_importances": q_node_importances,
    "node_rules": q_node_rules,
    "cv_node_accuracy": q_cv_node_accuracy,
    "train_guard": q_train_guard,
    "stratified_split": q_stratified_split,
    "split_rows": q_split_rows,
    "split_rates": q_split_rates,
    "cv_fold_rows": q_cv_fold_rows,
    "scaler_fit": q_scaler_fit,
    "rule_confusion": q_rule_confusion,
    "rule_report": q_rule_report,
    "class_support": q_class_support,
    "scaled_features": q_scaled_features,
    "rf_predictions": q_rf_predictions,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "train_accuracy": q_train_accuracy,
    "cv_accuracy": q_cv_accuracy,
    "feature_importance": q_feature_importance,
    "proba_histogram": q_proba_histogram,
    "model_roundtrip": q_model_roundtrip,
}

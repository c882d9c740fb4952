"""Spread classifier with ``pyspark.ml``: split, weights, forest, evaluation.

Everything is distributed: the split is decided by per-bucket class counts and a
ranking of only the boundary bucket of each class; metrics come from a 2x2
confusion table built by ``groupBy``.
"""
from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reuse

# Forest settings and evaluation constants of the reference job.
N_TREES = 100
MAX_DEPTH = 10
MIN_LEAF = 5
MIN_SPLIT = 10  # a node that splits; two leaves of MIN_LEAF rows already say so
SEED = 42
TEST_SIZE = 0.2
MIN_POSITIVES = 10
CV_FOLDS = 5
CLASS_NAMES = ["No Opportunity", "Opportunity"]

_BUCKET_BITS = 16


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class (at most two rows come back)."""
    return {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}


def guard(df: DataFrame, label: str, min_positives: int = MIN_POSITIVES) -> DataFrame:
    """One row: class sizes and whether a model may be trained."""
    agg = df.agg(F.count_if(F.col(label) == 1).alias("n_positive"),
                 F.count_if(F.col(label) == 0).alias("n_negative"))
    return agg.select("n_positive", "n_negative",
                      ((F.col("n_positive") >= min_positives) & (F.col("n_negative") >= 2)).alias("trainable"))


_HASH_BITS = 60


def row_hash(keys, seed: int) -> Column:
    """60 bits of the md5 of seed and keys as text: an order of rows that other engines
    can compute too."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def test_allocation(counts: dict, test_size: float = TEST_SIZE) -> dict:
    """Test rows per class of a stratified split: ``ceil(test_size * n)`` test rows
    in all; the train rows ``n - n_test`` are shared out in proportion to the
    classes (floors, then the remaining rows to the largest remainders; equal
    remainders go to the lower label), and each class's test rows are the rest."""
    labels = sorted(counts)
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    cont = {c: counts[c] / n * n_train for c in labels}
    train = {c: math.floor(cont[c]) for c in labels}
    left = n_train - sum(train.values())
    for c in sorted(labels, key=lambda c: (-(cont[c] - train[c]), c))[:max(left, 0)]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in labels}


def stratified_split(df: DataFrame, label: str, keys, test_size: float = TEST_SIZE,
                     seed: int = SEED) -> DataFrame:
    """Adds ``is_test``: an exact stratified split (sizes from ``test_allocation``)
    with rows chosen by a seeded hash of ``keys`` (shuffled within class).

    Rows are ordered by the hash; the top bits of the hash form buckets whose
    per-class counts (a small table) locate the cut.  Only rows of the one bucket
    per class that holds the cut are ranked.
    """
    need_of = test_allocation(class_counts(df, label), test_size)
    need = None
    for cls, k in need_of.items():
        need = (F.when(F.col(label) == cls, F.lit(k)) if need is None
                else need.when(F.col(label) == cls, F.lit(k)))
    need = (need if need is not None else F.lit(0)).cast("long")
    h = row_hash(keys, seed)
    tagged = df.select("*", h.alias("_h"), F.shiftright(h, _HASH_BITS - _BUCKET_BITS).alias("_b"))
    counts = tagged.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    run = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.select(label, "_b", "_cnt", F.sum("_cnt").over(run).alias("_cum"))
    # boundary: first bucket whose running count reaches the class's test size
    edge = (cum.where((F.col("_cum") >= need) & (need > 0))
            .groupBy(label)
            .agg(F.min("_b").alias("_eb"),
                 F.min_by(need - (F.col("_cum") - F.col("_cnt")), F.col("_b")).alias("_take")))
    # one row per class: a broadcast of proven size (the number of classes)
    marked = tagged.join(F.broadcast(edge), label, "left")
    settled = (marked.where(F.col("_eb").isNull() | (F.col("_b") != F.col("_eb")))
               .withColumn("is_test", F.coalesce(F.col("_b") < F.col("_eb"), F.lit(False))))
    rank = Window.partitionBy(label).orderBy("_h", *keys)
    at_edge = (marked.where(F.col("_b") == F.col("_eb"))
               .withColumn("is_test", F.row_number().over(rank) <= F.col("_take")))
    return settled.unionByName(at_edge).drop("_h", "_b", "_eb", "_take")


def class_rank(df: DataFrame, label: str, keys, seed: int) -> DataFrame:
    """Adds ``_rank`` (0-based position of the row in its class, in seeded-hash
    order) and ``_n`` (class size) without ranking a whole class in one task:
    rows are ranked inside their 2^16 hash buckets, shifted by the running count of
    the class's earlier buckets (a table of at most 2^16 rows per class)."""
    h = row_hash(keys, seed)
    tagged = df.select("*", h.alias("_h"), F.shiftright(h, _HASH_BITS - _BUCKET_BITS).alias("_b"))
    counts = tagged.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, "_b", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy(label)).alias("_n"))
    inside = Window.partitionBy(label, "_b").orderBy("_h", *keys)
    return (tagged.join(offsets, [label, "_b"])
            .withColumn("_rank", F.col("_off") + F.row_number().over(inside) - 1)
            .drop("_h", "_b", "_off"))


def with_fold(df: DataFrame, label: str, keys, folds: int = CV_FOLDS, seed: int = SEED + 1) -> DataFrame:
    """Stratified cross-validation folds: within every class the rows, in seeded-hash
    order, are cut into ``folds`` contiguous blocks whose sizes differ by at most
    one (as a stratified k-fold over shuffled rows does)."""
    ranked = class_rank(df, label, keys, seed)
    fold = F.floor(F.col("_rank") * F.lit(folds) / F.col("_n")).cast("int")
    return ranked.withColumn("fold", fold).drop("_rank", "_n")


def balanced_weights(df: DataFrame, label: str, out: str = "w") -> DataFrame:
    """``n / (classes * n_class)`` as in 'balanced' class weights.  The class sizes
    are one small aggregate (a row per class); the weight is a literal CASE."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    w = None
    for cls, nc in sorted(counts.items()):
        val = F.lit(n / (k * nc))
        w = F.when(F.col(label) == cls, val) if w is None else w.when(F.col(label) == cls, val)
    return df.withColumn(out, w if w is not None else F.lit(1.0))


def forest_pipeline(features: list[str], label: str, weight: str = "w", seed: int = SEED,
                    n_trees: int = N_TREES, max_depth: int = MAX_DEPTH) -> Pipeline:
    assembler = VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="error")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol=weight, numTrees=n_trees,
        maxDepth=max_depth, minInstancesPerNode=MIN_LEAF, featureSubsetStrategy="sqrt",
        bootstrap=True, seed=seed,
        # deep trees: keep each row's node id between levels instead of re-walking
        # the trees, with the id cache checkpointed every 10 levels
        cacheNodeIds=True, checkpointInterval=10)
    return Pipeline(stages=[assembler, scaler, forest])


ROWS_PER_FIT_PARTITION = 100_000


def fit(train: DataFrame, features: list[str], label: str, layout_keys=None, **kw) -> PipelineModel:
    """Balanced weights, then the scaler + forest pipeline.

    The forest seeds its bootstrap per input partition, so with ``layout_keys`` the
    rows are first given a layout that depends only on the data: a partition count
    from the row count (one per ``ROWS_PER_FIT_PARTITION``), rows
    hash-placed by the keys and sorted inside each partition.  The same data then
    gives the same forest under any session settings."""
    weighted = balanced_weights(train.withColumn(label, F.col(label).cast("double")), label)
    if layout_keys:
        n = sum(class_counts(train, label).values())
        parts = max(1, math.ceil(n / ROWS_PER_FIT_PARTITION))
        weighted = weighted.repartition(parts, *layout_keys).sortWithinPartitions(*layout_keys)
    return forest_pipeline(features, label, **kw).fit(weighted)


def predict(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    out = model.transform(df.withColumn(label, F.col(label).cast("double")))
    return out.withColumn("p_opportunity", vector_to_array("probability")[1])


def confusion(pred: DataFrame, label: str) -> DataFrame:
    """2x2 confusion table, all four cells present."""
    cells = pred.groupBy(F.col(label).cast("int").alias("actual"),
                         F.col("prediction").cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    grid = pred.sparkSession.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)],
                                             "actual int, predicted int")
    return grid.join(cells, ["actual", "predicted"], "left") \
        .select("actual", "predicted", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def report(conf: DataFrame) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted means;
    0 where a denominator is 0."""
    def cell(a, p):
        return F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n_rows"))
                     .otherwise(0))
    wide = conf.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
                    cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    rows = []
    for name, hit, pred_pos, actual in ((CLASS_NAMES[0], tn, tn + fn, tn + fp),
                                        (CLASS_NAMES[1], tp, tp + fp, tp + fn)):
        p, r = ratio(hit, pred_pos), ratio(hit, actual)
        f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
        rows.append(wide.select(F.lit(name).alias("class"), p.alias("precision"),
                                r.alias("recall"), f1.alias("f1"),
                                actual.cast("long").alias("support")))
    per = rows[0].unionByName(rows[1])
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").alias("support"))
    wsum = per.agg(F.lit("weighted avg").alias("class"),
                   *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m)
                     for m in ("precision", "recall", "f1")],
                   F.sum("support").alias("support"))
    acc = wide.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                      F.lit(None).cast("double").alias("recall"),
                      ratio(tn + tp, tn + fp + fn + tp).alias("f1"),
                      (tn + fp + fn + tp).cast("long").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(wsum)


def accuracy(pred: DataFrame, label: str) -> DataFrame:
    return pred.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"),
                    F.count(F.lit(1)).alias("n_rows"))


def importances(model: PipelineModel, features: list[str]) -> DataFrame:
    """Feature importances of the fitted forest (one small row per feature)."""
    forest = model.stages[-1]
    vals = forest.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    schema = T.StructType([T.StructField("rank", T.IntegerType()),
                           T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    # one value per feature, already on the driver as a model attribute
    ordered = sorted(zip(features, [float(v) for v in vals]), key=lambda fv: (-fv[1], fv[0]))
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(ordered)], schema)


def cross_validate(train: DataFrame, features: list[str], label: str, keys,
                   folds: int = CV_FOLDS, parallelism: int = CV_FOLDS, fitted: dict | None = None, **kw) -> DataFrame:
    """Stratified k-fold accuracy on the training rows; the scaler and class weights
    are fitted inside each fold.  The folds are independent, so up to
    ``parallelism`` of them are fitted at once (concurrent Spark jobs share the
    executors).  Returns one row per fold plus the mean and 2x population std;
    ``fitted`` receives each fold's model and held-out rows."""
    from concurrent.futures import ThreadPoolExecutor

    # every fold reads the fold-tagged rows twice (fit, evaluation): tag them once
    data = reuse(with_fold(train, label, keys, folds))

    def one(k: int):
        fit_on = data.where(F.col("fold") != k).drop("fold")
        held = data.where(F.col("fold") == k).drop("fold")
        model = fit(fit_on, features, label, layout_keys=keys, **kw)
        if fitted is not None:
            fitted[k] = (model, held)
        row = accuracy(predict(model, held, label), label).first()
        return k, (float(row["accuracy"]) if row["accuracy"] is not None else None), row["n_rows"]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        accs = sorted(pool.map(one, range(folds)))
    vals = [a for _, a, _ in accs if a is not None]
    mean = sum(vals) / len(vals) if vals else None
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / len(vals)) if vals else None
    spark = train.sparkSession
    schema = "fold int, accuracy double, n_rows long, mean_accuracy double, two_std double"
    return spark.createDataFrame([(k, a, n, mean, None if std is None else 2 * std) for k, a, n in accs],
                                 schema)

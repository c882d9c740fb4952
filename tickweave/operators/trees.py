"""A fitted forest as a table of nodes, and what follows from it: predictions, importances, size rules.

A saved forest model holds a row per node.  Read back as a plain table it can be kept, joined and
audited by any SQL engine: rows walk down their trees by joins on (tree, node), and the
importances are sums over the splits.  The node table is bounded by the number of trees and
their depth, whatever the training data, so it may be broadcast.
"""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quantiles import beside


def save_nodes(model: PipelineModel, path: str, spark: SparkSession) -> DataFrame:
    """Saves the pipeline's forest (its last stage) and returns its nodes: tree, node, left, right, feature, threshold (all
    four NULL or -1 on a leaf), gain, n_rows (training rows that reached the node), class_weights."""
    model.stages[-1].write().overwrite().save(path)
    return read_nodes(spark, path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    n = "nodeData"
    leaf = F.col(f"{n}.leftChild") < 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{n}.id").alias("node"), F.col(f"{n}.leftChild").alias("left"),
        F.col(f"{n}.rightChild").alias("right"), F.when(~leaf, F.col(f"{n}.split.featureIndex")).alias("feature"),
        # every feature is continuous: one threshold, values up to it go left
        F.when(~leaf, F.get(F.col(f"{n}.split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.col(f"{n}.gain").alias("gain"), F.col(f"{n}.rawCount").cast("long").alias("n_rows"),
        F.col(f"{n}.impurityStats").alias("class_weights"))


def scaled_rows(model: PipelineModel, df: DataFrame, keys) -> DataFrame:
    """(keys, x): the scaled feature array that the forest sees."""
    out = df
    for stage in model.stages[:-1]:
        out = stage.transform(out)
    return out.select(*keys, vector_to_array("features").alias("x"))


def walk(nodes: DataFrame, rows: DataFrame, keys, trees: int, depth: int) -> DataFrame:
    """(keys, tree, class_weights): the leaf that every row reaches in every one of ``trees`` trees."""
    steps = F.broadcast(nodes.select("tree", "node", "left", "right", "feature", "threshold"))  # trees * 2^(depth + 1) rows at most
    at = rows.select(*keys, "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        goes_left = F.get("x", F.col("feature")) <= F.col("threshold")
        node = F.when(F.col("left") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(steps, ["tree", "node"]).select(*keys, "x", "tree", node.alias("node"))
    leaves = F.broadcast(nodes.select("tree", "node", "class_weights"))
    return at.join(leaves, ["tree", "node"]).select(*keys, "tree", "class_weights")


def predict_by_nodes(nodes: DataFrame, rows: DataFrame, keys, trees: int, depth: int) -> DataFrame:
    """(keys, prediction, p_opportunity): the mean over the trees of the leaf's class shares; the likelier class,
    the lower one of equals."""
    leaves = walk(nodes, rows, keys, trees, depth)
    total = F.aggregate("class_weights", F.lit(0.0), lambda a, w: a + w)
    share = leaves.groupBy(*keys).agg(F.avg(F.get("class_weights", F.lit(1)) / total).alias("p_opportunity"),
                                      F.avg(F.get("class_weights", F.lit(0)) / total).alias("p_other"))
    return share.select(*keys, (F.col("p_opportunity") > F.col("p_other")).cast("int").alias("prediction"), "p_opportunity")


def importances_by_nodes(nodes: DataFrame, features: list[str]) -> DataFrame:
    """(rank, feature, importance): weighted gain by feature, each tree's shares summing to one."""
    weight = F.aggregate("class_weights", F.lit(0.0), lambda a, w: a + w)
    gains = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("g"))
    trees = gains.groupBy("tree").agg(F.sum("g").alias("t"))
    by = gains.join(trees, "tree").groupBy("feature").agg(F.sum(F.try_divide("g", "t")).alias("s"))
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "feature int, name string")
    held = names.join(by, "feature", "left").select(F.col("name").alias("feature"), F.coalesce("s", F.lit(0.0)).alias("s"))
    whole = F.sum("s").over(Window.partitionBy())  # one row per feature in all
    ranked = held.select("feature", F.coalesce(F.try_divide("s", whole), F.lit(0.0)).alias("importance"))
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")).cast("int"))


def node_rules(nodes: DataFrame, min_split: int, min_leaf: int, depth: int) -> DataFrame:
    """One row: trees, splits of nodes below ``min_split`` rows, leaves below ``min_leaf``, nodes without their parent's split, and
    trees whose longest path passes ``depth``."""
    child = (nodes.where("left >= 0").select("tree", F.explode(F.array("left", "right")).alias("node"))
             .groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n_parents")))
    linked = nodes.join(child, ["tree", "node"], "left")
    level = nodes.where("node = 0").select("tree", "node")
    inner = F.broadcast(nodes.where("left >= 0").select("tree", "node", "left", "right"))
    for _ in range(depth + 1):  # what is left after depth + 1 steps down lies too deep
        level = level.join(inner, ["tree", "node"]).select("tree", F.explode(F.array("left", "right")).alias("node"))
    deep = level.agg(F.count_distinct("tree").alias("n_too_deep"))
    split = F.col("left") >= 0
    rules = linked.agg(
        F.count_distinct("tree").alias("n_trees"), F.count_if(split & (F.col("n_rows") < min_split)).alias("n_small_splits"),
        F.count_if(~split & (F.col("node") > 0) & (F.col("n_rows") < min_leaf)).alias("n_small_leaves"),
        F.count_if((F.col("node") > 0) & (F.coalesce("n_parents", F.lit(0)) != 1)).alias("n_orphans"))
    return beside(rules, deep)

"""Connected components by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("low"))
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(low, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of ``links(a, b)``; the root is the smallest node reachable.

    Each round is written to the scratch folder, so lineage stays short.  A hub's edges are
    only ever joined with one row or summed up front, never gathered."""
    edges = (links.where("a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges, before, turn = scratch.keep(edges, "edges-0"), None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before, turn = state, turn + 1
        edges = scratch.keep(_small_star(_large_star(edges)), f"edges-{turn}")
        scratch.drop(f"edges-{turn - 1}")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select("v", "v").distinct()))

"""Corpus pipeline: toxicity, quality, near-duplicates, decontamination, packing.

Each stage reads what its predecessor kept; all but the last return the columns of
``documents``.  ``run`` writes every stage as Parquet in the shared checkpoint folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickweave.llm import decontaminate, packing, quality, simhash, toxicity
from tickweave.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_selected(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.word_bpe())


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_copies),
          ("decontamination", drop_contaminated), ("packing", pack)]
ORACLE_SQL = None  # classifiers and token ids are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs

"""Quality by importance resampling.

Two generative models over hashed word unigrams and bigrams: one of the target (texts
labelled good), one of the raw corpus (every document).  A document's log weight is the
log ratio of the two over its n-grams; adding Gumbel noise and keeping the largest keys
draws without replacement in proportion to the weights (Gumbel top-k).

The raw model counts every document.  The target model and the cut use at most
``MAX_FIT_ROWS`` labelled rows.  All passes are narrow: texts are never shuffled, counts
are summed inside a task before one row per bucket leaves it.
"""
from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_blocks
from .toxicity import MAX_FIT_ROWS, sampled_labels

BUCKETS = 1 << 16
SEED = 42


def word_ngrams(texts: list, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words (white-space tokens, case kept) and word pairs of each text:
    positions in ``texts`` and buckets, repeats included."""
    words = [(t or "").encode().split() for t in texts]
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    code = np.fromiter((crc32(w) for ws in words for w in ws), np.uint64, len(owner))
    inside = owner[:-1] == owner[1:]
    pair = code[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    pair = (pair >> np.uint64(24))[inside]
    codes = np.concatenate([code, pair]) % np.uint64(buckets)
    return np.concatenate([owner, owner[:-1][inside]]), codes.astype(np.int64)


def gumbel(ids: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Gumbel noise fixed by id and seed (splitmix64)."""
    z = ids.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return -np.log(-np.log(((z >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53))


def _count_task(batches):
    """(bucket, raw count, target count); rows are (text, label or null)."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for part, texts in text_blocks(batches):
        good = np.asarray(part.column(1).fill_null(0)) > 0
        owner, codes = word_ngrams(texts)
        raw += np.bincount(codes, minlength=BUCKETS)
        target += np.bincount(codes[good[owner]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    if len(seen):
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
            names=["bucket", "raw", "target"])


@dataclass
class Model:
    log_ratio: np.ndarray  # one per bucket: log p(target) - log p(raw)
    cut: float  # the smallest key that is kept

    def weights(self, texts: list) -> np.ndarray:
        owner, codes = word_ngrams(texts)
        return np.bincount(owner, weights=self.log_ratio[codes], minlength=len(texts))

    def keys(self, ids: pa.Array, weights: np.ndarray) -> np.ndarray:
        return weights + gumbel(np.asarray(ids.cast(pa.int64()).fill_null(0)))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def best_cut(keys: np.ndarray, good: np.ndarray) -> float:
    """The cut with the fewest labelled rows on the wrong side; among equals the lowest.
    Without bad rows nothing is cut off."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(keys, kind="stable")
    keys, good = keys[order], good[order]
    wrong = np.concatenate([[0], np.cumsum(good)]) + (~good).sum() - np.concatenate([[0], np.cumsum(~good)])
    at = int(np.argmin(wrong))
    return -np.inf if at == 0 else float((keys[at - 1] + keys[min(at, len(keys) - 1)]) / 2)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_FIT_ROWS) -> Model:
    """Fit on all of ``docs`` (raw) and its labelled rows outside the held-out fold (target,
    cut).  Without target texts every weight is 0 and every row is kept."""
    sample = F.broadcast(sampled_labels(labels, "quality", limit))
    rows = _rows(docs)
    counts = (rows.join(sample, "doc_id", "left").select("text", "label")
              .mapInArrow(_count_task, "bucket long, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
              .toPandas())
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    raw[counts["bucket"]] += counts["raw"]
    target[counts["bucket"]] += counts["target"]
    if not counts["target"].sum():
        return Model(np.zeros(BUCKETS), -np.inf)
    model = Model(np.log(target / target.sum()) - np.log(raw / raw.sum()), -np.inf)
    labelled = score(rows.join(sample, "doc_id"), model).select("key", "doc_id")
    known = labelled.join(sample, "doc_id").select("key", "label").toPandas()
    model.cut = best_cut(known["key"].to_numpy(), known["label"].to_numpy() > 0)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, log_weight, key) of every row.  A null or empty text has no n-grams and weight
    0; repeated rows get equal keys; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, texts in text_blocks(batches):
            weights = shared.value.weights(texts)
            keys = shared.value.keys(part.column(0), weights)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(weights), pa.array(keys)],
                names=["doc_id", "log_weight", "key"])
    return _rows(docs).mapInArrow(run, "doc_id long, log_weight double, key double")


def top_k(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows with the largest keys (ties: smaller doc_id), without a global sort:
    whole key buckets above the boundary, ranks only inside the bucket on it."""
    bucket = F.floor(F.col("key") * 1024)
    sized = scored.groupBy(bucket.alias("bucket")).count()
    above = F.sum("count").over(Window.orderBy(F.desc("bucket"))) - F.col("count")
    edge = (sized.select("bucket", "count", above.alias("above"))
            .where((F.col("above") < k) & (F.col("above") + F.col("count") >= k)).collect())
    if not edge:
        return scored if k > 0 else scored.limit(0)
    at, room = edge[0]["bucket"], k - edge[0]["above"]
    inside = scored.where(bucket == at).orderBy(F.desc("key"), "doc_id").limit(room)
    return scored.where(bucket > at).unionByName(inside)


def keep_selected(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) whose key reaches the cut: the Gumbel
    top-k for the k that the labelled rows support."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches):
        for part, texts in text_blocks(batches):
            ids = part.column(part.schema.get_field_index("doc_id"))
            keys = shared.value.keys(ids, shared.value.weights(texts))
            yield part.filter(pa.array(keys >= shared.value.cut))
    return docs.mapInArrow(run, schema)


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, log_weight, key, selected (key at or above the fitted cut)."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).withColumn("selected", F.col("key") >= F.lit(float(model.cut)))

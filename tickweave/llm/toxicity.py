"""Toxicity: a character n-gram linear classifier on naive-Bayes-scaled features.

Features are hashed character n-grams (present or not).  Each is scaled by its naive
Bayes log-count ratio between toxic and other labelled texts, and an L2-penalised
logistic regression is fitted on the scaled features.  A feature whose log odds ratio, with
half a text added to each count, is within ``MIN_Z`` standard errors of zero keeps the value
zero: on long texts those would only add noise.  The half text gives n-grams of one class
only a finite error too, so the frequent ones among them have their say.

The regression runs in one task, so its width is bounded too: it takes the ``MAX_FEATURES``
features with the largest errors from zero, the rest keep the value zero.  Without that bound
the sample of 32,768 rows took an executor over 3 GB.

The ratios and the regression use at most ``MAX_FIT_ROWS`` labelled rows, chosen by a
hash of the id; scoring reads every text whole.  Both passes are narrow: texts are never
shuffled, and what is broadcast has a fixed size (the sampled ids, one coefficient per
hash value).
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held_out, table, text_blocks

ORDERS = (4, 5, 6)
BITS = 20
MAX_FIT_ROWS = 32_768  # bound on the labelled rows a model is fitted on
MAX_FEATURES = 4_096  # bound on the features of the regression, strongest first
MIN_Z = 4.0
SMOOTHING = 0.05
HALF = 0.5  # added to each count of the log odds ratio that MIN_Z judges
PENALTY = 0.02
THRESHOLD = 0.3
BLOCK = 500_000  # characters whose n-grams are held at once


def char_ngrams(texts: list, orders: tuple = ORDERS,
                bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the texts (lower case, white space runs as one space, a space at
    either end): positions in ``texts`` and hash values, repeats included."""
    parts = [f" {' '.join((t or '').lower().split())} " for t in texts]
    chars = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4")
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    docs, codes = [], []
    for n in orders:
        if len(chars) < n:
            continue
        last = len(chars) - n + 1
        code = np.full(last, n, dtype=np.uint32)
        for k in range(n):
            code *= np.uint32(0x01000193)
            code += chars[k:k + last]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x9E3779B1)
        code >>= np.uint32(32 - bits)
        inside = owner[:last] == owner[n - 1:]
        docs.append(owner[:last][inside])
        codes.append(code[inside])
    if not docs:
        return np.empty(0, np.int32), np.empty(0, np.uint32)
    return np.concatenate(docs), np.concatenate(codes)


def present(docs: np.ndarray, codes: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, ordered by text."""
    pairs = np.unique((docs.astype(np.int64) << bits) | codes)
    return pairs >> bits, pairs & ((1 << bits) - 1)


@dataclass
class Model:
    coef: np.ndarray  # float32, one per hash value; zero where a feature has no say
    bias: float

    def score(self, texts: list) -> np.ndarray:
        docs, codes = char_ngrams(texts)
        hit = self.coef[codes] != 0
        docs, codes = present(docs[hit], codes[hit])
        logit = self.bias + np.bincount(docs, weights=self.coef[codes], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _count_task(batches):
    """(feature, texts with it, toxic texts with it); feature -1 counts the texts."""
    size = 1 << BITS
    total, toxic = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    for part, texts in text_blocks(batches, chars=BLOCK):
        label = np.asarray(part.column(1), dtype=bool)
        docs, codes = present(*char_ngrams(texts))
        total[:size] += np.bincount(codes, minlength=size)
        toxic[:size] += np.bincount(codes[label[docs]], minlength=size)
        total[size] += len(texts)
        toxic[size] += label.sum()
    seen = np.flatnonzero(total)
    if len(seen):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(seen == size, -1, seen)), pa.array(total[seen]),
             pa.array(toxic[seen])], names=["feature", "total", "toxic"])


def _present_task(kept: np.ndarray):
    def run(batches):
        for part, texts in text_blocks(batches, chars=BLOCK):
            docs, codes = char_ngrams(texts)
            at = np.minimum(np.searchsorted(kept, codes), len(kept) - 1)
            hit = kept[at] == codes
            docs, at = present(docs[hit], at[hit])
            ends = np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=len(texts)))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(1), lists], names=["label", "features"])
    return run


def _regress_task(ratio: np.ndarray):
    """One task over the bounded sample: (feature index, weight), the bias as -1."""
    def run(batches):
        whole = pa.Table.from_batches(batches)
        label = np.asarray(whole["label"].combine_chunks(), dtype=float)
        lists = whole["features"].combine_chunks()
        row = np.repeat(np.arange(len(label)), np.asarray(lists.value_lengths()))
        weights, bias = logistic(np.asarray(lists.flatten()), row, label, ratio)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(ratio)), pa.int64()),
             pa.array(np.concatenate([[bias], weights]))], names=["at", "weight"])
    return run


def logistic(feature: np.ndarray, row: np.ndarray, label: np.ndarray, ratio: np.ndarray,
             penalty: float = PENALTY, steps: int = 200) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression by full-batch Adagrad; entry (row, feature) has the
    value ``ratio[feature]``."""
    share = min(max(label.mean(), 1e-3), 1 - 1e-3)
    weights, bias = np.zeros(len(ratio)), np.log(share / (1 - share))
    value, n = ratio[feature], len(label)
    past, past_bias = np.full(len(ratio), 1e-8), 1e-8
    for _ in range(steps):
        logit = bias + np.bincount(row, weights=value * weights[feature], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(logit, -500, 500))) - label
        slope = np.bincount(feature, weights=value * error[row], minlength=len(ratio))
        slope = (slope + penalty * weights) / n
        past += slope ** 2
        past_bias += error.mean() ** 2
        weights -= 0.1 * slope / np.sqrt(past)
        bias -= 0.1 * error.mean() / np.sqrt(past_bias)
    return weights, float(bias)


def sampled_labels(labels: DataFrame, name: str, limit: int = MAX_FIT_ROWS) -> DataFrame:
    """(doc_id, label) of about ``limit`` labelled rows outside the held-out fold, chosen by
    a hash of the id.  An id with several labels counts as 1 if any of them is."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull()
                          & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.max(name) > 0).cast("int").alias("label")))
    share = min(1.0, limit / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))


def odds_z(total: Column, toxic: Column, n: int, p: int) -> Column:
    """Log odds ratio of a feature in ``total`` texts, ``toxic`` of them toxic, in standard errors;
    ``p`` of all ``n`` texts are toxic."""
    cells = [toxic + HALF, p - toxic + HALF, total - toxic + HALF, n - p - (total - toxic) + HALF]
    odds = F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])
    return odds / F.sqrt(sum((1 / c for c in cells[1:]), 1 / cells[0]))


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_FIT_ROWS) -> Model:
    """Fit on the labelled rows of ``docs`` outside the held-out fold.

    Without a text of either class every score is the share of toxic texts (0 if there
    are none)."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .join(F.broadcast(sampled_labels(labels, "toxic", limit)), "doc_id")
            .select("text", "label"))
    # written: the class sizes and the ratios read the same counts
    counts = Scratch(docs.sparkSession, "toxicity").keep(
        rows.mapInArrow(_count_task, "feature long, total long, toxic long")
        .groupBy("feature").agg(F.sum("total").alias("n"), F.sum("toxic").alias("p")), "counts")
    sizes = counts.where("feature = -1").collect()
    n, p = (sizes[0]["n"], sizes[0]["p"]) if sizes else (0, 0)
    coef = np.zeros(1 << BITS, np.float32)
    if p == 0 or p == n:
        return Model(coef, 500.0 if p else -500.0)
    a = SMOOTHING
    pos, neg = F.col("p") + a, F.col("n") - F.col("p") + a
    ratio = F.log(pos / (p + 2 * a)) - F.log(neg / (n - p + 2 * a))
    best = (counts.where("feature >= 0")
            .select("feature", ratio.alias("ratio"), F.abs(odds_z(F.col("n"), F.col("p"), n, p)).alias("z"))
            .where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
            .toPandas().sort_values("feature"))
    kept, ratios = best["feature"].to_numpy(np.int64), best["ratio"].to_numpy(float)
    if not len(kept):
        return Model(coef, float(np.log(p / (n - p))))
    fitted = (rows.mapInArrow(_present_task(kept), "label int, features array<int>")
              .repartition(1).mapInArrow(_regress_task(ratios), "at long, weight double").toPandas()
              .sort_values("at"))
    weights = fitted["weight"].to_numpy(float)
    coef[kept] = weights[1:] * ratios
    return Model(coef, float(weights[0]))


def _score_task(shared):
    def run(batches):
        for part, texts in text_blocks(batches, chars=BLOCK):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(shared.value.score(texts))], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get the model's base score, repeated
    rows one result each; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score_task(shared), "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, texts in text_blocks(batches, chars=BLOCK):
            yield part.filter(pa.array(shared.value.score(texts) < threshold))
    return docs.mapInArrow(run, docs.schema)


def op10_naive_bayes_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

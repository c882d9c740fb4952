"""Ranked lexical search by the Best Position Algorithm.

Every term of an item has an impact list: the documents that hold the term, from the
highest to the lowest contribution to a score.  Lists are read from the top.  A document met
in one list is looked up in the item's other lists at once, which gives its whole score and
marks its position in each of them.  The best position of a list is the last one up to
which every position has been seen, whether by reading or by lookup; no unseen document
can score more than the sum of the contributions at the best positions.  Reading stops when
that sum is strictly below the k-th score, so that no tie is missed.

One pass over the documents writes their lengths and the postings of the items' terms; the
corpus counts are sums over that table.  Each task of the second pass turns its postings
into lists of bounded shards and keeps k documents per item; the k-th score of a task's
earlier shards is the threshold its later shards start with.  Texts are never shuffled.
Items are handled in blocks of about ``TERM_BLOCK`` terms, so that what tasks are sent is
bounded however many items there are.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table, text_blocks
from .decontaminate import words

K = 10
TERM_BLOCK = 200_000  # terms of the items of one block, sent to every task
SHARD_POSTINGS = 1_000_000  # postings of the lists a task holds at once (one document at least)
FIRST_STEP = 32  # positions read from each list in the first round; each round doubles it

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item long, doc_id long, score long"
_POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                       ("tfs", pa.list_(pa.int32()))])
_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

# A-Z to a-z, every other ASCII character that is no digit or letter to a space; the bytes of
# all other characters belong to terms
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, with repeats, in UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()


def postings(vocabulary: dict[bytes, int]):
    """Arrow batches of (doc_id, text) -> (doc_id, n, terms, tfs) of texts with a term."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for part, texts in text_blocks(batches):
            rows, sizes, offsets, terms, tfs = [], [], [0], [], []
            for k, text in enumerate(texts):
                count = Counter(terms_of(text) if text else ())
                if not count:
                    continue
                rows.append(k)
                sizes.append(count.total())
                for term in known & count.keys():
                    terms.append(vocabulary[term])
                    tfs.append(count[term])
                offsets.append(len(terms))
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], schema=_POSTINGS)
    return run


class Lists:
    """Impact lists of one shard: postings in list order and, for lookups, in document order."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_terms: int):
        order = np.lexsort((docs, -impacts, terms))
        self.edges = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.docs, self.impacts = docs[order], impacts[order]
        self.by_doc = np.lexsort((self.docs, terms[order]))  # places in list order, by (term, document)
        self.doc_order = self.docs[self.by_doc]

    def search(self, terms: list[int], n_docs: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that hold the k best of these terms; ``floor`` is a k-th
        score known before (0 for none), strictly below which documents may be left out."""
        spans = [(int(self.edges[t]), int(self.edges[t + 1])) for t in terms if self.edges[t] < self.edges[t + 1]]
        seen = [np.zeros(hi - lo + 1, bool) for lo, hi in spans]  # the last entry stays unseen
        best = [0] * len(spans)
        met = np.zeros(n_docs, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_STEP
        while True:
            read = [self.docs[lo + depth:min(lo + depth + step, hi)] for lo, hi in spans]
            fresh = np.unique(np.concatenate(read)) if read else np.zeros(0, np.int64)
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            total = np.zeros(len(fresh), np.int64)
            for (lo, hi), marks in zip(spans, seen):
                listed = self.doc_order[lo:hi]
                at = np.minimum(np.searchsorted(listed, fresh), hi - lo - 1)
                hit = listed[at] == fresh
                places = self.by_doc[lo + at[hit]]
                total[hit] += self.impacts[places]
                marks[places - lo] = True
            docs, scores = np.concatenate([docs, fresh]), np.concatenate([scores, total])
            if len(scores) >= k:
                floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            docs, scores = docs[scores >= max(floor, 1)], scores[scores >= max(floor, 1)]
            bound = 0
            for j, (lo, hi) in enumerate(spans):
                best[j] += int(np.argmin(seen[j][best[j]:]))
                if best[j] < hi - lo:
                    bound += int(self.impacts[lo + best[j] - 1])
            if bound < max(floor, 1):
                return docs, scores
            depth, step = depth + step, step * 2


class Shard:
    """Postings gathered until they are ``SHARD_POSTINGS``."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)
        self.size += len(batch.column(2).flatten())

    def arrays(self):
        """doc ids and null marks, lengths, and per posting the document's place, term and count."""
        all_rows = pa.Table.from_batches(self.parts).combine_chunks()
        ids, terms, tfs = (all_rows.column(c).combine_chunks() for c in ("doc_id", "terms", "tfs"))
        sizes = np.diff(terms.offsets.to_numpy())
        return (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                all_rows.column("n").to_numpy(), np.repeat(np.arange(len(sizes)), sizes),
                terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64))


def impacts(tfs: np.ndarray, weights: np.ndarray, n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """Contribution of a term to a document's score (integers; divisions round down)."""
    m = 100 - 90 + (90 * n * n_docs) // n_words
    return weights * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))


def best_documents(items: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, n_words: int, k: int):
    """Arrow batches of postings -> the k best documents of every item among a task's rows.  Of
    equal scores the smaller doc_id is better, a null one last."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = {item: (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for item, _ in items}

        def flush(shard: Shard) -> None:
            ids, nulls, n, docs, terms, tfs = shard.arrays()
            value = impacts(tfs, weights[terms], n[docs], n_docs, n_words)
            used = value > 0
            lists = Lists(terms[used], docs[used], value[used], len(weights))
            for item, item_terms in items:
                top_ids, top_nulls, top_scores = tops[item]
                floor = int(top_scores[-1]) if len(top_scores) == k else 0
                found, scores = lists.search(item_terms, len(ids), k, floor)
                top_ids, top_nulls = np.concatenate([top_ids, ids[found]]), np.concatenate([top_nulls, nulls[found]])
                top_scores = np.concatenate([top_scores, scores])
                order = np.lexsort((top_ids, top_nulls, -top_scores))[:k]
                tops[item] = top_ids[order], top_nulls[order], top_scores[order]

        shard = Shard()
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            block = np.cumsum(sizes) // SHARD_POSTINGS
            edges = np.flatnonzero(np.diff(block, prepend=-1)).tolist() if len(block) else []
            for a, b in zip(edges, [*edges[1:], batch.num_rows]):
                part = batch.slice(a, b - a)
                if shard.size and shard.size + int(sizes[a:b].sum()) > SHARD_POSTINGS:
                    flush(shard)
                    shard = Shard()
                shard.add(part)
        if shard.parts:
            flush(shard)
        for item, (ids, nulls, scores) in tops.items():
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item)), pa.array(ids, pa.int64(), mask=nulls), pa.array(scores)],
                    schema=_FOUND)
    return run


def _weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _block(docs: DataFrame, items: list, scratch: Scratch, name: str, k: int) -> DataFrame:
    """The k best documents of each task for a block of items (key, terms)."""
    vocabulary = {t: j for j, t in enumerate(sorted({t.encode() for _, terms in items for t in terms}))}
    written = scratch.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                           .mapInArrow(postings(vocabulary), POSTINGS), f"postings-{name}")
    total = written.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_words")).first()
    # one number per term of the block: at most about TERM_BLOCK
    df = np.zeros(len(vocabulary), np.int64)
    for row in written.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weights = np.array([_weight(int(x), total.n_docs) for x in df], np.int64)
    wanted = [(key, [vocabulary[t.encode()] for t in terms]) for key, terms in items]
    return written.mapInArrow(best_documents(wanted, weights, total.n_docs, total.n_words, k), FOUND)


def _terms(text: Column) -> Column:
    return F.array_distinct(words(text))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of the highest score above 0 of each item.

    Texts that are null, empty or without a term are no documents and match nothing; items
    without a term have no rows, rows that share an item_id are items of their own, and so are
    rows that share a doc_id.  Equal scores rank by doc_id, a null one last; other columns are
    ignored; empty tables give no rows."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked")
    keyed = scratch.keep(items.select("item_id", _terms(F.col("text")).alias("terms")).where(F.size("terms") > 0)
                         .withColumn("item", F.monotonically_increasing_id()), "items")
    blocks = -(-(keyed.agg(F.sum(F.size("terms"))).first()[0] or 0) // TERM_BLOCK)
    found = [spark.createDataFrame([], FOUND)]
    for b in range(blocks):
        block = keyed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "terms")
        rows = sorted((r["item"], r["terms"]) for r in block.collect())
        if rows:
            found.append(_block(docs, rows, scratch, str(b), k))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .join(keyed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score"))


def op13_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP13_SQL = f"""
WITH d AS (SELECT *, len(t) AS n FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
c AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(nn) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, c GROUP BY term),
i AS (SELECT DISTINCT i, item_id, term FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark)),
s AS (SELECT i, item_id, r, d.doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll)))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN p USING (term) JOIN d USING (r), c GROUP BY i, item_id, r, d.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= {K}"""

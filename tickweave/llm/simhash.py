"""SimHash near-duplicates by the generalised pigeonhole principle.

A pair of 64-bit fingerprints within ``d`` bits, cut into ``m`` groups of bits, is within
``t_g`` bits in some group ``g`` whenever the thresholds ``t_g >= -1`` sum to ``d - m + 1``
(-1: the group is not probed).  So a fingerprint may choose its own thresholds:

1. bits are put into groups with the bits they correlate with, from the co-occurrence
   counts of all distinct fingerprints;
2. the number of candidates at each group and radius is estimated from histograms of
   parts of the groups (again over all distinct fingerprints);
3. per fingerprint, dynamic programming over the groups picks the cheapest thresholds,
   and the number of groups is the cheapest of ``GROUP_COUNTS``;
4. every fingerprint is filed under its value in each group and looked up under every
   value within its thresholds; what meets in a bucket is verified by its distance.

Any number of groups gives the same links: estimates only move cost.  Copies share a
fingerprint and take part once.  A bucket passes on a spanning forest of its links, so a
group of n near copies costs about n rows and not n squared; a bucket with very many
filed fingerprints is cut into blocks that other tasks probe.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, numbered, table, text_blocks
from .graph import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
GROUP_COUNTS = (2, 3, 4)
PART_BITS = 11  # bits of a histogram's index
BLOCK = 8_192  # filed fingerprints of one bucket that meet in one task
SAMPLE = 20_000  # fingerprints on which the number of groups is chosen
PROBE_COST = 4.0  # a row looked up, in verified candidates
FILED_AND_PROBED, FILED, PROBED = 0, 1, 2  # sorted: the filed rows of a bucket come first


# fingerprints ---------------------------------------------------------------------------

def shingle_hashes(text: str | None, size: int = SHINGLE) -> list[int]:
    words = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    digest = xxhash.xxh64_intdigest
    if not words:
        return []
    return [digest(b" ".join(words[i:i + size]), SEED)
            for i in range(max(1, len(words) - size + 1))]


def simhash(texts: list, size: int = SHINGLE) -> np.ndarray:
    """Unsigned fingerprints: a bit is set where over half of the shingle hashes have it."""
    hashes = [shingle_hashes(t, size) for t in texts]
    counts = np.array([len(h) for h in hashes], dtype=np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        flat = np.fromiter((x for h in hashes for x in h), np.uint64, counts.sum())
        bits = np.unpackbits(flat.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        over = (2 * ones > counts[full, None]).astype(np.uint8)
        out[full] = np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE, row: str | None = None) -> DataFrame:
    """(doc_id, fp) of every row, with the column ``row`` (a long) as row_key if named; null,
    empty and blank texts have fingerprint zero."""
    def run(batches):
        for part, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(simhash(texts, size).view(np.int64)), *part.columns[2:]],
                names=["doc_id", "fp", *["row_key"] * bool(row)])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *[F.col(r).alias("row_key") for r in (row,) if r])
    return rows.mapInArrow(run, "doc_id long, fp long" + ", row_key long" * bool(row))


# groups of bits and estimates -------------------------------------------------------------

def _column(batch: pa.RecordBatch, name: str = "fp") -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy().view(np.uint64)


def _co_occurrence(batches):
    total = np.zeros((64, 64))
    n = 0
    for batch in batches:
        fps = _column(batch)
        x = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                          bitorder="little").astype(np.float32)
        total += x.T @ x
        n += len(fps)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(4097)), pa.array(np.concatenate([total.ravel(), [n]]).astype(np.int64))],
            names=["cell", "n"])


def correlation(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """Absolute correlation of each two bits, and the number of fingerprints."""
    rows = nodes.mapInArrow(_co_occurrence, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()
    cells = np.zeros(4097)
    for cell, n in rows:
        cells[cell] = n
    n = max(cells[4096], 1.0)
    both = cells[:4096].reshape(64, 64) / n
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs((both - np.outer(mean, mean)) / np.outer(spread, spread)), int(cells[4096])


def group_bits(related: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of near equal width, each grown from its strongest pair by the bit with
    the largest summed correlation to the group."""
    left = list(range(64))
    groups = []
    for g in range(m):
        width = 64 // m + (g < 64 % m)
        a, b = max(combinations(left, 2), key=lambda p: (related[p], -p[0], -p[1]))
        group = [a, b]
        left = [x for x in left if x not in group]
        while len(group) < width:
            best = max(left, key=lambda x: (related[x, group].sum(), -x))
            group.append(best)
            left.remove(best)
        groups.append(group)
    return groups


def gather(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint as one number."""
    out = np.zeros(len(fps), np.uint64)
    for k, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def parts_of(group: list[int]) -> list[list[int]]:
    n = -(-len(group) // PART_BITS)
    return [list(map(int, p)) for p in np.array_split(group, n)]


def _histogram_task(parts: list[list[int]]):
    def run(batches):
        size = 1 << PART_BITS
        counts = np.zeros((len(parts), size), np.int64)
        for batch in batches:
            fps = _column(batch)
            for k, part in enumerate(parts):
                counts[k] += np.bincount(gather(fps, part).astype(np.int64), minlength=size)
        at = np.flatnonzero(counts)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])],
                                             names=["cell", "n"])
    return run


class Layout:
    """Groups of bits with their estimated candidate counts."""

    def __init__(self, groups: list[list[int]], shells: dict, n: int, distance: int):
        self.groups, self.shells, self.n, self.distance = groups, shells, n, distance

    def candidates(self, fps: np.ndarray, g: int) -> np.ndarray:
        """Estimated fingerprints within 0..distance bits in group ``g`` (columns)."""
        exact = np.zeros((len(fps), self.distance + 1))
        exact[:, 0] = 1.0
        for part in parts_of(self.groups[g]):
            shell = self.shells[tuple(part)][gather(fps, part).astype(np.int64)]
            mixed = np.zeros_like(exact)
            for a in range(self.distance + 1):
                for b in range(self.distance + 1 - a):
                    mixed[:, a + b] += exact[:, a] * shell[:, b]
            exact = mixed
        return np.cumsum(exact, axis=1) * self.n

    def thresholds(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cheapest thresholds (rows x groups, -1: not probed) and their estimated cost.

        With u = t + 1 the sum over the groups is distance + 1; ``best[:, s]`` is the least
        cost of spending s on the groups so far."""
        units = self.distance + 1
        best = np.full((len(fps), units + 1), np.inf)
        best[:, 0] = 0.0
        choice = []
        for g, group in enumerate(self.groups):
            near = self.candidates(fps, g)
            cost = np.zeros((len(fps), units + 1))
            for u in range(1, units + 1):
                cost[:, u] = PROBE_COST * len(masks(len(group), u - 1)) + near[:, u - 1]
            tried = np.full((units + 1, len(fps), units + 1), np.inf)
            for u in range(units + 1):
                tried[u, :, u:] = best[:, :units + 1 - u] + cost[:, u:u + 1]
            choice.append(np.argmin(tried, axis=0))
            best = np.min(tried, axis=0)
        spent = np.full(len(fps), units)
        out = np.zeros((len(fps), len(self.groups)), np.int64)
        for g in reversed(range(len(self.groups))):
            out[:, g] = choice[g][np.arange(len(fps)), spent]
            spent = spent - out[:, g]
        return out - 1, best[:, units]


_MASKS: dict[tuple[int, int], np.ndarray] = {}


def masks(width: int, radius: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most ``radius`` bits set."""
    if (width, radius) not in _MASKS:
        _MASKS[width, radius] = np.array(
            [sum(1 << b for b in bits) for r in range(radius + 1)
             for bits in combinations(range(width), r)], dtype=np.uint64)
    return _MASKS[width, radius]


def shells_of(counts: np.ndarray, width: int, distance: int) -> np.ndarray:
    """Share of the fingerprints at exactly 0..distance bits from each value of a part."""
    values = np.arange(1 << width)
    share = counts[:1 << width] / max(counts.sum(), 1)
    out = np.zeros((1 << width, distance + 1))
    for r in range(min(distance, width) + 1):
        for bits in combinations(range(width), r):
            out[:, r] += share[values ^ sum(1 << b for b in bits)]
    return out


def choose_layout(nodes: DataFrame, distance: int) -> Layout:
    related, n = correlation(nodes)
    plans = [group_bits(related, m) for m in GROUP_COUNTS if m <= distance + 1]
    parts = sorted({tuple(p) for groups in plans for g in groups for p in parts_of(g)})
    rows = (nodes.mapInArrow(_histogram_task([list(p) for p in parts]), "cell long, n long")
            .groupBy("cell").agg(F.sum("n")).collect())
    counts = np.zeros(len(parts) << PART_BITS)
    for cell, k in rows:
        counts[cell] = k
    counts = counts.reshape(len(parts), -1)
    shells = {p: shells_of(counts[k], len(p), distance) for k, p in enumerate(parts)}
    layouts = [Layout(groups, shells, n, distance) for groups in plans]
    if n:
        share = min(1.0, SAMPLE / n)
        some = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        fps = np.array([r[0] for r in some.select("fp").collect()], np.int64).view(np.uint64)
        layouts.sort(key=lambda x: float(x.thresholds(fps)[1].sum()))
    return layouts[0]


# probing and verifying ----------------------------------------------------------------------

def _key(g: int, values: np.ndarray) -> np.ndarray:
    return ((np.uint64(g) << np.uint64(40)) | values).view(np.int64)


def _probe_task(shared):
    def run(batches):
        layout = shared.value
        for batch in batches:
            fps = _column(batch)
            chosen, _ = layout.thresholds(fps)
            for g, group in enumerate(layout.groups):
                values = gather(fps, group)
                role = np.where(chosen[:, g] >= 0, FILED_AND_PROBED, FILED).astype(np.int32)
                yield _rows(_key(g, values), fps, role)
                for radius in range(1, layout.distance + 1):
                    at = np.flatnonzero(chosen[:, g] == radius)
                    around = masks(len(group), radius)[1:]
                    for a in range(0, len(at), step := max(1, 500_000 // len(around))):
                        own = at[a:a + step]
                        near = (values[own][:, None] ^ around[None, :]).ravel()
                        yield _rows(_key(g, near), np.repeat(fps[own], len(around)),
                                    np.full(len(near), PROBED, np.int32))
    return run


def _rows(key: np.ndarray, fps: np.ndarray, role: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(fps.view(np.int64)), pa.array(role)], names=["key", "fp", "role"])


def _forest(probes: np.ndarray, filed: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links that connect what the links of probes with filed fingerprints connect."""
    label = np.arange(len(filed))
    out = []
    for a in range(0, len(probes), 256):
        near = np.bitwise_count(probes[a:a + 256, None] ^ filed[None, :]) <= distance
        for k in np.flatnonzero(near.any(axis=1)):
            at = np.flatnonzero(near[k])
            names, first = np.unique(label[at], return_index=True)
            out.append(np.stack([np.full(len(names), probes[a + k]), filed[at[first]]]))
            if len(names) > 1:
                label[np.isin(label, names)] = names[0]
    return out


def _verify_buckets(start: np.ndarray, fps: np.ndarray, role: np.ndarray,
                    distance: int) -> np.ndarray:
    """Links (2 x n) inside the buckets that begin at ``start``."""
    sizes = np.diff(np.append(start, len(fps)))
    filed = np.add.reduceat(role != PROBED, start)
    probed = np.add.reduceat(role != FILED, start)
    work = filed * probed
    out = []
    small = (sizes > 1) & (work > 0) & (work <= 1024)
    bucket = np.repeat(np.arange(len(start)), sizes)
    at = np.flatnonzero(small[bucket] & (role != FILED))
    if len(at):
        times = filed[bucket[at]]
        a = np.repeat(at, times)
        nth = np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)
        b = np.repeat(start[bucket[at]], times) + nth
        hit = (np.bitwise_count(fps[a] ^ fps[b]) <= distance) & (a != b)
        out.append(np.stack([fps[a[hit]], fps[b[hit]]]))
    for k in np.flatnonzero(work > 1024):
        own = slice(start[k], start[k] + sizes[k])
        out += _forest(fps[own][role[own] != FILED], fps[own][role[own] != PROBED], distance)
    links = np.concatenate(out, axis=1) if out else np.empty((2, 0), np.uint64)
    links = links[:, links[0] != links[1]]
    return np.unique(np.sort(links, axis=0), axis=1)


def _verify_task(distance: int, hold: int = 200_000):
    """Rows arrive sorted by (key, block, role); memory is ``hold`` rows and one bucket's
    filed rows (``BLOCK`` at most on average)."""
    def emit(links):
        return pa.RecordBatch.from_arrays(
            [pa.array(links[0].view(np.int64)), pa.array(links[1].view(np.int64))], names=["a", "b"])

    def run(batches):
        key = block = role = np.empty(0, np.int64)
        fps = np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, np.asarray(batch.column(0))])
            block = np.concatenate([block, np.asarray(batch.column(1))])
            fps = np.concatenate([fps, _column(batch)])
            role = np.concatenate([role, np.asarray(batch.column(3))])
            if len(key) < hold:
                continue
            start = np.flatnonzero((np.diff(key, prepend=key[0] - 1) != 0)
                                   | (np.diff(block, prepend=block[0] - 1) != 0))
            last = start[-1]
            if last:
                yield emit(_verify_buckets(start[:-1], fps[:last], role[:last], distance))
                key, block, fps, role = key[last:], block[last:], fps[last:], role[last:]
            else:  # one bucket fills the buffer: probe what is here, go on with the filed rows
                yield emit(_verify_buckets(start, fps, role, distance))
                kept = role != PROBED
                key, block, fps = key[kept], block[kept], fps[kept]
                role = np.full(len(key), FILED, np.int64)
        if len(key):
            start = np.flatnonzero((np.diff(key, prepend=key[0] - 1) != 0)
                                   | (np.diff(block, prepend=block[0] - 1) != 0))
            yield emit(_verify_buckets(start, fps, role, distance))
    return run


def links(nodes: DataFrame, scratch: Scratch, distance: int = DISTANCE) -> DataFrame:
    """(a, b) with a < b: links that connect exactly the fingerprints of ``nodes(fp)`` within
    ``distance`` bits of each other (a spanning set of all such pairs, each one verified)."""
    layout = choose_layout(nodes, distance)
    shared = nodes.sparkSession.sparkContext.broadcast(layout)
    rows = nodes.select("fp").mapInArrow(_probe_task(shared), "key long, fp long, role int")
    filed = nodes.select("fp").mapInArrow(_filed_task(layout.groups), "key long")
    crowded = scratch.keep(filed.groupBy("key").count().where(F.col("count") > BLOCK)
                           .select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")),
                           "crowded")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (rows.join(crowded, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("own", own)
             .withColumn("block", F.explode(F.when(F.col("role") == FILED, F.array("own"))
                                            .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
             .select("key", "block", "fp",
                     F.when((F.col("role") == FILED_AND_PROBED) & (F.col("block") != F.col("own")),
                            PROBED).otherwise(F.col("role")).alias("role")))
    return (dealt.repartition("key", "block").sortWithinPartitions("key", "block", "role")
            .mapInArrow(_verify_task(distance), "a long, b long"))


def _filed_task(groups: list[list[int]]):
    def run(batches):
        for batch in batches:
            fps = _column(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([_key(g, gather(fps, x)) for g, x in enumerate(groups)]))],
                names=["key"])
    return run


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest doc_id of the rows
    reachable over fingerprints within ``distance`` bits.

    Texts without words have fingerprint zero and are linked like any other.  Repeated rows
    come back repeated.  A row without doc_id takes part but names no component (null if it
    is linked to such rows only).  Other columns are ignored; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marks = scratch.keep(fingerprints(docs, size), "marks")
    every = _named(marks, scratch, distance)
    return marks.join(every, "fp").select("doc_id", "fp", "component_id")


def _named(marks: DataFrame, scratch: Scratch, distance: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``marks(doc_id, fp)``; the root names the
    component even if no row of it has a doc_id."""
    nodes = scratch.keep(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(links(nodes, scratch, distance), scratch)
    linked = found.join(nodes, F.col("node") == F.col("fp")).select("fp", "root", "first")
    named = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = scratch.keep(linked.join(named, "root").select("fp", "root", "component_id"), "linked")
    return (nodes.join(linked, "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id")))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs`` (all columns as they are): the one with the smallest
    doc_id, null ids last, and among equal ids the first by a row key that is written first."""
    scratch = Scratch(docs.sparkSession, "keep-first")
    rows, key = numbered(docs, scratch)
    marks = scratch.keep(fingerprints(rows, row=key), "marks")
    every = _named(marks.select("doc_id", "fp"), scratch, DISTANCE).select("fp", "root")
    placed = scratch.keep(marks.join(every, "fp").select(
        "root", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key").alias("place")), "placed")
    kept = placed.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.row_key").alias(key))
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def op3_generalised_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

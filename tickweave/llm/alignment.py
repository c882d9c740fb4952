"""Cross-tokenizer alignment with corpus-wide counts of linked ids.

Two tokenizers cut a text at different bytes.  Where tokens of both end together a group
ends, and the two tokens that end there are linked.  Both tokenizers cut before white space
that follows something else and before a mark that follows a letter, so a text is aligned
unit by unit (a word with the white space before it, a mark), and a remembered unit is not
encoded again.

Linked pairs are counted over the corpus by minimal perfect hashing:

1. Every block of documents gives its pairs and their counts; documents with their blocks and
   the blocks' pairs are written once, so that every later read sees the same blocks.
2. The distinct pairs are dealt into shards.  A shard's hash function places its n keys onto
   0..n-1 in levels: keys alone in their slot stay, the others go to the next level.  The
   keys themselves are stored by place, to verify lookups.
3. A run of ``FAN`` blocks becomes one dense count vector per shard, and the vectors are summed
   in a tree, ``FAN`` at a time, to one vector per shard.
4. The blocks ask the shards for their pairs' counts, and a second pass over the documents
   of each block aligns them again and looks the counts up.

No step gathers more than a block of documents, a shard, or ``FAN`` vectors of one; a
pair that is frequent in every document is one entry of each block.
"""
from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Collection, Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table, text_blocks
from .packing import byte_letters

SHARD_KEYS = 4096  # distinct pairs of a shard, on average
FAN = 32  # blocks, then vectors, that are summed at once
B_IDS = 1 << 16  # a pair is the id of A times this, plus the id of B
SLOTS = 1.5  # slots per key of a hash level
CACHE_UNITS = 400_000  # units of a generation that a worker remembers
LONGEST_KEPT = 64  # longer units are not remembered
BLOCKS_PER_TASK = 1 << 33

_WHITE = " \\t\\n\\r\\x0b\\x0c\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER = "A-Za-zÀ-ÖØ-öø-ʯΑ-ΡΣ-ώЀ-ҁҊ-ӿ"
# white space and marks before which a text may be cut: A never joins them to what they follow, and
# those that a piece of B joins to it are left out
_CUT_WHITE, _CUT_MARKS = " \t\n", ".,;:!?)\""


def byte_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


_NEW = ("",)  # stands for a unit that is not remembered (None is one that is not spelled)


class Aligner:
    """Both tokenizers with their remembered units (two generations: a full one replaces the older).

    A unit is kept as (tokens of A, tokens of B, linked pairs as little-endian 32-bit numbers, groups
    as text), one that a tokenizer does not spell as None.  A unit of ASCII characters or of
    letters is encoded by rank merges over A's own vocabulary, which is A's algorithm without
    its per-call cost; any other unit by A itself."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from public_tokenizers import PATTERN
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = {c: b for b, c in enumerate(byte_letters())}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, j in self.a.get_vocab().items():
            self.a_bytes[j] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.ranks = Encoding("ranks", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            self.a_bytes[j]: j for token, j in self.a.get_vocab().items() if token not in special})
        pieces = [self.b.id_to_piece(j) for j in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(j) else p.replace("▁", " ").encode()
                        for j, p in enumerate(pieces)]
        # what B puts before a unit behind a line feed: its own space, and the line feed as a byte
        self.lead = [self.b.piece_to_id("▁"), self.b.piece_to_id("<0x0A>")]
        joined = {c for j, p in enumerate(pieces) if not self.b.is_byte(j)
                  for a, c in zip(p, p[1:].replace("▁", " ")) if a not in "▁ " or c in _CUT_MARKS}
        white = "".join(c for c in _CUT_WHITE if c not in joined)
        letter = re.compile(f"[{_LETTER}]")
        marks = "".join(c for c in _CUT_MARKS if not any(
            letter.match(a) and b == c for p in pieces for a, b in zip(p, p[1:])))
        end = f"[{white}{marks}]|$"
        self.cut = re.compile(f"[{white}]?[{_LETTER}]+(?={end})|[{marks}]+(?=[{white}]|$)|"
                              f"(?s:.+?)(?=(?<![{_WHITE}])[{white}]|(?<=[{_LETTER}])[{marks}]|\\Z)") if white and marks \
            else re.compile("(?s:.+)")
        self.plain = re.compile(f"[{white}]?[{_LETTER}]+")
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.texts = [f"{j}{mark}" for table, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;\n"))
                      for mark in marks for j in range(len(table))]
        self.units: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def parts(self, text: str) -> list[str]:
        """The units of a space and the text, as text (none for a null or empty text)."""
        return self.cut.findall(" " + text) if text else []

    def aligned(self, parts: list[str]) -> list[tuple | None]:
        """The alignment of each of the distinct units."""
        if len(self.units) > CACHE_UNITS:
            self.units, self.older = {}, self.units
        units, older = self.units, self.older
        found = list(map(units.get, parts, repeat(_NEW)))
        fresh = []
        for k in [k for k, unit in enumerate(found) if unit is _NEW]:
            unit = found[k] = older.get(parts[k], _NEW)
            if unit is _NEW:
                fresh.append(k)
            else:
                units[parts[k]] = unit
        for k, unit in zip(fresh, self._encode([parts[k] for k in fresh])):
            found[k] = unit
            if len(parts[k]) <= LONGEST_KEPT:
                units[parts[k]] = unit
        return found

    def _encode(self, parts: list[str]) -> list[tuple | None]:
        a_all, b_all = self._tokens(parts)
        found = self._grouped(parts, a_all, b_all)
        if found is None:  # some unit is not spelled: it is left out and the others go together
            whole = [k for k, (p, a, b) in enumerate(zip(parts, a_all, b_all)) if self._spelled([p], [a], [b])]
            found, rest = [None] * len(parts), self._grouped(*([x[k] for k in whole] for x in (parts, a_all, b_all)))
            for k, unit in zip(whole, rest):
                found[k] = unit
        return found

    def _tokens(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers of each unit (none of B where what it puts in front is not its own token)."""
        plain, ranks = self.plain.fullmatch, self.ranks.encode_ordinary
        a_all = [ranks(p) if p.isascii() or plain(p) else self.a.encode(p, add_special_tokens=False).ids for p in parts]
        b_all = self.b.encode([p[1:] if p[0] == " " else "\n" + p for p in parts], num_threads=1)
        for k, p in enumerate(parts):
            if p[0] != " ":
                b_all[k] = b_all[k][2:] if b_all[k][:2] == self.lead else []
            elif p == " ":
                b_all[k] = self.lead[:1]  # an empty text has no token
        return a_all, b_all

    def _spelled(self, parts: list[str], a_all: list[list[int]], b_all: list[list[int]]) -> bool:
        """Whether the tokens of both spell the units, which then end together."""
        raw = "".join(parts).encode()
        a, b = list(chain.from_iterable(a_all)), list(chain.from_iterable(b_all))
        return raw == b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b))

    def _grouped(self, parts: list[str], a_all: list[list[int]], b_all: list[list[int]]) -> list[tuple] | None:
        """Alignments of units that both tokenizers spell, all at once; None if one does not."""
        if not parts:
            return []
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a_all, b_all))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a_all, b_all))
        if not n_a.all() or not n_b.all() or not self._spelled(parts, a_all, b_all):
            return None
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])  # both end with the last unit
        last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
        if not np.array_equal(ends_a[last_a], ends_b[last_b]) or not np.array_equal(
                ends_a[last_a], np.cumsum(np.fromiter((len(p.encode()) for p in parts), np.int64, len(parts)))):
            return None
        is_end = np.zeros((2, int(ends_a[-1]) + 1), bool)
        is_end[0, ends_a], is_end[1, ends_b] = True, True
        both = is_end[0] & is_end[1]
        mark_a, mark_b = both[ends_a].astype(np.int64), both[ends_b].astype(np.int64)
        at_a, at_b = np.flatnonzero(mark_a), np.flatnonzero(mark_b)
        pairs = (a[at_a] * B_IDS + b[at_b]).astype("<u4").tobytes()
        # every token's text with what follows it: a comma, the bar after A's part of a group, a semicolon, the end of a unit
        group_a, group_b = np.cumsum(mark_a) - mark_a, np.cumsum(mark_b) - mark_b
        mark_b[last_b] = 2
        # a token of A stands behind B's tokens of the groups before its own, one of B behind A's up to its group
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.concatenate([[0], at_b + 1])[group_a]] = a + mark_a * len(self.a_bytes)
        codes[np.arange(len(b)) + at_a[group_b] + 1] = b + mark_b * len(self.b_bytes) + 2 * len(self.a_bytes)
        groups = "".join(map(self.texts.__getitem__, codes.tolist())).split("\n")
        edges = (4 * np.searchsorted(at_a, np.concatenate([[-1], last_a]), side="right")).tolist()
        return list(zip(n_a.tolist(), n_b.tolist(), [pairs[i:j] for i, j in zip(edges, edges[1:])], groups))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner (kept between tasks, with its remembered units)."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


# --- pass 1: blocks of documents and their pairs ---------------------------------------------

BLOCKS = "block long, row long, doc_id long, text string, pairs array<long>, counts array<long>"
_BLOCKS = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()),
                     ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


_NO_PAIRS = np.zeros(0, np.int64), np.zeros(0, np.int64)


def linked(units: Collection[tuple], times: Collection[int]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of units that occur ``times`` each, in order, and how often each pair is linked."""
    runs = [u[2] for u in units]
    pairs = np.frombuffer(b"".join(runs), "<u4")
    times = np.repeat(times, np.fromiter(map(len, runs), np.int64, len(runs)) // 4)
    links = pa.table({"pair": pairs, "n": times})
    sums = links.group_by("pair", use_threads=False).aggregate([("n", "sum")]).sort_by("pair")
    return sums["pair"].to_numpy().astype(np.int64), sums["n_sum"].to_numpy().astype(np.int64)


def _placed(model: Aligner, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, list[tuple | None], np.ndarray]:
    """Where the units of each text begin and end, all units as places among the distinct ones,
    with their alignments, and which texts both tokenizers spell."""
    rows = list(map(model.parts, texts))
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))])
    coded = pa.array(list(chain.from_iterable(rows)), pa.large_string()).dictionary_encode()
    at = coded.indices.to_numpy()
    units = model.aligned(coded.dictionary.to_pylist())
    broken = np.fromiter((u is None for u in units), bool, len(units))
    return edges, at, units, np.diff(np.concatenate([[0], np.cumsum(broken[at])])[edges]) == 0


def _blocks(a_path: str, b_path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = aligner(a_path, b_path)
        block = TaskContext.get().partitionId() * BLOCKS_PER_TASK
        row = block
        for part, texts in text_blocks(batches):
            edges, at, units, whole = _placed(model, texts)
            times = np.bincount(at[np.repeat(whole, np.diff(edges))], minlength=len(units))
            pairs, counts = linked(*zip(*((u, n) for u, n in zip(units, times.tolist()) if n))) if times.any() else _NO_PAIRS
            n = part.num_rows
            at = pa.array([0] + [len(pairs)] * n, pa.int32())  # the block's first row carries its pairs
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(row, row + n)), part.column(0), part.column(1),
                 pa.ListArray.from_arrays(at, pa.array(pairs)), pa.ListArray.from_arrays(at, pa.array(counts))],
                schema=_BLOCKS)
            block, row = block + 1, row + n
    return run


# --- minimal perfect hashing --------------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64 well mixed bits of each key, different ones per level."""
    x = (keys.astype(np.uint64) + np.uint64(level + 1)) * _ODD
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """A minimal perfect hash function: per level the slots that hold exactly one key.  A key's place is
    the number of such slots before its own."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for alone in levels:
            self.ranks.append(before + np.cumsum(alone) - 1)
            before += int(alone.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct."""
        levels, left = [], keys
        while len(left):
            slots = int(SLOTS * len(left)) + 1
            slot = mixed(left, len(levels)) % np.uint64(slots)
            alone = np.bincount(slot.astype(np.int64), minlength=slots) == 1
            levels.append(alone)
            left = left[~alone[slot.astype(np.int64)]]
        return cls(levels)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys; other keys get some place or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.levels, self.ranks)):
            slot = (mixed(keys[left], level) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[slot]
            out[left[hit]] = rank[slot[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out

    def pack(self) -> tuple[list[int], bytes]:
        return [len(x) for x in self.levels], b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def unpack(cls, sizes: Iterable[int], bits: bytes) -> PerfectHash:
        levels, at = [], 0
        for n in map(int, sizes):
            raw = np.frombuffer(bits, np.uint8, -(-n // 8), at)
            levels.append(np.unpackbits(raw, count=n).astype(bool))
            at += -(-n // 8)
        return cls(levels)


SHARDS = "shard long, sizes array<int>, bits binary, stored array<long>"
VECTORS = "shard long, part long, vector array<long>"
ANSWERS = "block long, pairs array<long>, counts array<long>, best array<boolean>"


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """The hash function of a shard's distinct pairs, and the pairs by place."""
    keys = np.sort(rows["pair"].to_numpy())
    table_of = PerfectHash.of(keys)
    stored = np.zeros(len(keys), np.int64)
    stored[table_of.places(keys)] = keys
    sizes, bits = table_of.pack()
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "sizes": [sizes], "bits": [bits], "stored": [stored]})


def _verified(shard: pd.Series, pairs: np.ndarray) -> np.ndarray:
    """Places of the pairs, each checked against the stored key."""
    places = PerfectHash.unpack(shard["sizes"], shard["bits"]).places(pairs)
    if len(pairs) and not (places.min() >= 0 and np.array_equal(np.asarray(shard["stored"])[places], pairs)):
        raise ValueError("a pair is not among the hashed keys")
    return places


def _dense(key, rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """The count vector of a run of blocks over one shard."""
    if not len(rows):
        return pd.DataFrame({"shard": [], "part": [], "vector": []})
    vector = np.zeros(len(shard["stored"].iloc[0]), np.int64)
    np.add.at(vector, _verified(shard.iloc[0], rows["pair"].to_numpy()), rows["n"].to_numpy())
    return pd.DataFrame({"shard": [key[0]], "part": [key[1]], "vector": [vector]})


def _summed(key, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"shard": [key[0]], "part": [key[1]], "vector": [np.sum(list(rows["vector"]), axis=0)]})


def _answered(key, rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """Counts of the pairs that a run of blocks asks one shard for."""
    if not len(rows):
        return pd.DataFrame({"block": [], "pairs": [], "counts": [], "best": []})
    asked = rows["pair"].to_numpy()
    places = _verified(shard.iloc[0], asked)
    counts, best = (np.asarray(shard[c].iloc[0])[places] for c in ("vector", "best"))
    order = np.argsort(rows["block"].to_numpy(), kind="stable")
    blocks, starts = np.unique(rows["block"].to_numpy()[order], return_index=True)
    return pd.DataFrame({"block": blocks, **{name: np.split(x[order], starts[1:])
                                             for name, x in (("pairs", asked), ("counts", counts), ("best", best))}})


def count_pairs(blocks: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(shard, part, sizes, bits, stored, vector, best): every shard, once per run of blocks that holds pairs of
    it, and what each block holds as (shard, part, block, pair, n).  ``best`` marks the pairs whose count is
    the highest of their B id."""
    held = blocks.where(F.size("pairs") > 0).select(
        "block", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))).alias("x")).select("block", "x.*")
    distinct = scratch.keep(held.select("pair").distinct(), "distinct")
    shards = -(-distinct.count() // SHARD_KEYS) or 1
    shard = F.pmod(F.xxhash64("pair"), F.lit(shards)).alias("shard")
    built = scratch.keep(distinct.select(shard, "pair").groupBy("shard").applyInPandas(_build, SHARDS), "shards")
    # blocks are numbered by task: their number among all makes runs of FAN
    order = blocks.select("block").distinct()
    dealt = scratch.keep(_numbered(order, "block"), "runs")
    held = scratch.keep(held.join(dealt, "block").select(shard, F.expr(f"number div {FAN}").alias("part"), "block", "pair", "n"),
                        "held")
    parts = scratch.keep(held.select("shard", "part").distinct(), "parts")
    vectors = scratch.keep(held.groupBy("shard", "part").cogroup(built.join(parts, "shard").groupBy("shard", "part"))
                           .applyInPandas(_dense, VECTORS), "vectors-0")
    turn = 0
    while (vectors.agg(F.max("part")).first()[0] or 0) > 0:
        turn += 1
        vectors = scratch.keep(vectors.withColumn("part", F.expr(f"part div {FAN}")).groupBy("shard", "part")
                               .applyInPandas(_summed, VECTORS), f"vectors-{turn}")
        scratch.drop(f"vectors-{turn - 1}")
    counted = built.join(vectors.select("shard", "vector"), "shard")
    flat = counted.select("shard", F.posexplode(F.arrays_zip("stored", "vector")).alias("place", "x")).select(
        "shard", "place", F.col("x.vector").alias("n"), (F.col("x.stored") % B_IDS).alias("b"))
    highest = flat.groupBy("b").agg(F.max("n").alias("highest"))
    best = (flat.join(highest, "b").groupBy("shard")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", (F.col("n") == F.col("highest")).alias("best")))),
                             lambda x: x["best"]).alias("best")))
    asked = parts.join(scratch.keep(counted.join(best, "shard"), "counted"), "shard")
    return asked, held


def _numbered(frame: DataFrame, key: str) -> DataFrame:
    """(key, number): the distinct keys numbered from 0 in order; only the tasks' sizes meet in one place."""
    tasks = frame.select(key, (F.col(key).bitwiseAND(BLOCKS_PER_TASK - 1)).alias("own"),
                         F.floor(F.col(key) / BLOCKS_PER_TASK).alias("task"))
    sizes = tasks.groupBy("task").agg((F.max("own") + 1).alias("n"))
    # one row per task of the first pass
    rows, before, starts = sorted((r["task"], r["n"]) for r in sizes.collect()), 0, []
    for task, n in rows:
        starts.append((task, before))
        before += n
    begun = frame.sparkSession.createDataFrame(starts, "task long, begun long")
    return tasks.join(begun, "task").select(key, (F.col("begun") + F.col("own")).alias("number"))


# --- pass 2 ----------------------------------------------------------------------------------------

OUT = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
       "groups_sha256 string")


def _looked_up(a_path: str, b_path: str):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        model = aligner(a_path, b_path)
        pairs, counts, best = (np.concatenate([*answers[c], np.zeros(0, np.int64)]).astype(np.int64)
                               for c in ("pairs", "counts", "best"))
        order = np.argsort(pairs, kind="stable")
        pairs, counts, best = pairs[order], counts[order], best[order]
        starts, at, units, whole = _placed(model, docs["text"])
        numbers = np.zeros((len(units), 5), np.int64)
        numbers_a, numbers_b, runs, groups = zip(*(u or (0, 0, b"", "") for u in units)) if units else ([], [], [], [])
        asked = np.frombuffer(b"".join(runs), "<u4").astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs)) // 4)])
        found = np.minimum(np.searchsorted(pairs, asked), max(len(pairs) - 1, 0))
        numbers[:, 0], numbers[:, 1] = numbers_a, numbers_b
        numbers[:, 2] = np.diff(edges)
        for column, values in ((3, best), (4, counts)):
            # units that only stand in texts without tokens may have pairs that were never counted
            of_asked = np.where(pairs[found] == asked, values[found], 0) if len(pairs) else np.zeros(len(asked), np.int64)
            numbers[:, column] = np.diff(np.concatenate([[0], np.cumsum(of_asked)])[edges])
        sums, filled = np.zeros((len(whole), 5), np.int64), np.diff(starts) > 0
        if len(at):
            sums[filled] = np.add.reduceat(numbers[at], starts[:-1][filled], axis=0)
        n_a, n_b, links, n_best, total = np.where(whole[:, None], sums, 0).T
        of_units = pa.array(groups, pa.large_string()).take(pa.array(at))
        spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), of_units), pa.scalar(";", pa.large_string()))
        digests = [hashlib.sha256(x.as_buffer()).hexdigest() if n else "" for x, n in zip(spelled, links.tolist())]
        frame = pd.DataFrame({"row": docs["row"], "doc_id": docs["doc_id"], "n_a": n_a, "n_b": n_b, "n_groups": links,
                              "n_links": links, "n_best": n_best, "count_sum": total, "groups_sha256": digests})
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame
    return run


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``.

    A group ends where tokens of both end, and there one pair is linked, so n_links equals n_groups.
    Null and empty texts, and texts that one of the tokenizers does not spell byte by byte, have no
    tokens: zeros and an empty groups_sha256, and they count for no other text.  Repeated rows
    come back repeated and each counts; other columns are ignored; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession, "alignment")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = scratch.keep(plain.mapInArrow(_blocks(a_path, b_path), BLOCKS), "blocks")
    counted, held = count_pairs(blocks, scratch)
    answers = scratch.keep(held.groupBy("shard", "part").cogroup(counted.groupBy("shard", "part"))
                           .applyInPandas(_answered, ANSWERS), "answers")
    return (blocks.select("block", "row", "doc_id", "text").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInPandas(_looked_up(a_path, b_path), OUT).drop("row"))


def op12_perfect_hash_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), byte_bpe(), piece_bpe())

"""Packing by the online sum-of-squares rule.

Documents become token ids in the tasks that read them and are packed there: a text
is never shuffled.  A document longer than a window gives whole windows first; its
remainder goes to the fill level that makes the sum of the squared counts of partly
filled windows smallest.  The counts live in one level array of ``capacity + 1``
entries, so the state of a task is bounded whatever it reads.

At the end of a task the partly filled windows are closed by cutting: the emptiest
give to the fullest until one is left, and that one is cut into powers of two, which
need no padding.
"""
from __future__ import annotations

import os
import re
import unicodedata
import zlib
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import table, text_blocks

CAPACITY = 4096
END_ID = 2
CACHE_UNITS = 700_000  # white-space units of a generation whose ids a worker remembers
MAX_OPEN = 4096  # partly filled windows held at once; beyond it they are closed by cutting
SEQUENCES_PER_TASK = 1 << 33  # sequence ids: task number times this, plus a counter

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_ARROW = pa.schema([(name, pa.int64()) for name in
                    ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                     "offset")])


# a run of letters, then ASCII punctuation: two pre-tokens whatever the letters are
_WORD = re.compile(r"([^\W\d_]+)([!-/:-@\[-^`{-~]*)")


def byte_letters() -> str:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other
    bytes for the code points from 256 on (as a table for ``str.translate``)."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(rest)) for b in range(256))


class UnitTokenizer:
    """Token ids of texts as little-endian 32-bit bytes.

    The pre-tokenizer never joins text across white space, so a text's ids are those
    of its white-space units in order; a remembered unit is not encoded again.  A unit of
    letters and trailing ASCII punctuation is the lower-case letters and the punctuation,
    each a pre-token of its own, so the letters go straight to the model.

    Units are remembered in two generations: a full one replaces the older, and units met
    again move up, so common units stay and memory is bounded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        rows = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        if len(self.units) > CACHE_UNITS:
            self.units, self.older = {}, self.units
        units, older = self.units, self.older
        for unit in set().union(*rows).difference(units):
            units[unit] = older.get(unit) or self._unit(unit)
        get = units.__getitem__
        return [b"".join(map(get, row)) for row in rows]

    def _unit(self, unit: str) -> bytes:
        word = _WORD.fullmatch(unit)
        if not word:
            return self._exact(unit)
        core, tail = word.groups()
        core = unicodedata.normalize("NFC", core).lower()
        if not core.isalpha() or "\u03c2" in core:  # a final sigma: lower() looks at context
            return self._exact(unit)
        ids = self.units.get(core) or self.older.get(core)
        if ids is None:
            piece = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
            tokens = [t.id for t in self.model.model.tokenize(piece)]
            ids = self.units[core] = pack_ids(f"<{len(tokens)}I", *tokens)
        if tail:
            if tail not in self.units:
                self.units[tail] = self._exact(tail)
            ids += self.units[tail]
        return ids

    def _exact(self, unit: str) -> bytes:
        ids = self.model.encode(unit, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)


_TOKENIZERS: dict[str, UnitTokenizer] = {}


def tokenizer(path: str) -> UnitTokenizer:
    """The worker's tokenizer (kept between tasks, with its remembered units)."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = UnitTokenizer(path)
    return _TOKENIZERS[path]


class SumOfSquares:
    """Partly filled windows by fill level.

    ``place`` returns the pieces of windows that became full.  A piece is
    (document, start, ids as bytes)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        # squares change by 2*(N[h+s]-N[h])+2 when a window moves from level h to h+s;
        # N[capacity] = -1/2 makes the same formula hold for a window that fills up
        self.count = np.zeros(capacity + 1)
        self.count[capacity] = -0.5
        self.windows: list[list[list]] = [[] for _ in range(capacity)]
        self.open = 0

    def place(self, piece: tuple) -> list | None:
        size = len(piece[2]) // 4
        if size == self.capacity:
            return [piece]
        levels = np.flatnonzero(self.count[1:self.capacity - size + 1]) + 1
        best, window = 0, None
        if len(levels):
            change = 2 * (self.count[levels + size] - self.count[levels]) + 2
            at = len(levels) - 1 - int(np.argmin(change[::-1]))  # ties: the fullest level
            if change[at] < 2 * self.count[size] + 1:
                best = int(levels[at])
        if best:
            window = self._take(best)
        else:
            window = []
        window.append(piece)
        if best + size == self.capacity:
            return window
        self._put(best + size, window)
        return None

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.open -= 1
        return self.windows[level].pop()

    def _put(self, level: int, window: list) -> None:
        self.count[level] += 1
        self.open += 1
        self.windows[level].append(window)

    def drain(self) -> list[list]:
        """Full windows cut from the open ones, fullest first; at most one stays open."""
        left = [self._take(level) for level in range(self.capacity - 1, 0, -1)
                for _ in range(len(self.windows[level]))]
        out, window, room = [], [], self.capacity
        for doc, start, ids in (piece for w in left for piece in w):
            while len(ids) // 4 >= room:
                window.append((doc, start, ids[:4 * room]))
                start, ids = start + room, ids[4 * room:]
                out.append(window)
                window, room = [], self.capacity
            if ids:
                window.append((doc, start, ids))
                room -= len(ids) // 4
        if window:
            self._put(self.capacity - room, window)
        return out

    def close(self) -> list[list]:
        """Everything that is left: full windows, then one remainder in powers of two."""
        out = self.drain()
        for level in range(self.capacity):
            if self.windows[level]:
                out += split_powers(self._take(level))
        return out


def split_powers(window: list) -> list[list]:
    """Cut a window into parts whose lengths are falling powers of two."""
    total = sum(len(ids) // 4 for _, _, ids in window)
    out, queue = [], list(reversed(window))
    while total:
        part, room = [], 1 << (total.bit_length() - 1)
        total -= room
        while room:
            doc, start, ids = queue.pop()
            take = min(room, len(ids) // 4)
            part.append((doc, start, ids[:4 * take]))
            if 4 * take < len(ids):
                queue.append((doc, start + take, ids[4 * take:]))
            room -= take
        out.append(part)
    return out


def _pack_task(path: str, capacity: int, end_id: int):
    def run(batches):
        tok, rule = tokenizer(path), SumOfSquares(capacity)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) * SEQUENCES_PER_TASK
        end = np.array([end_id], dtype="<u4").tobytes()
        rows: list[tuple] = []

        def emit(window):
            nonlocal sequence
            offset = 0
            for (doc, tokens), start, ids in window:
                n = len(ids) // 4
                rows.append((doc, start, n, zlib.crc32(ids), tokens, sequence, offset))
                offset += n
            sequence += 1

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], schema=_ARROW)
            rows.clear()
            return batch

        for part, texts in text_blocks(batches):
            for doc_id, ids in zip(part.column(0).to_pylist(), tok.encode(texts)):
                ids += end
                doc = (doc_id, len(ids) // 4)
                for a in range(0, len(ids), 4 * capacity):
                    if (full := rule.place((doc, a // 4, ids[a:a + 4 * capacity]))) is not None:
                        emit(full)
                if rule.open > MAX_OPEN:
                    for window in rule.drain():
                        emit(window)
            if rows:
                yield flush()
        for window in rule.close():
            emit(window)
        if rows:
            yield flush()
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``capacity`` tokens.

    Returns one row per piece (``SCHEMA``).  ``capacity`` is a power of two.  Null and
    empty texts hold the end id alone; rows with equal or null ids are packed each on
    their own; other columns are ignored; an empty table gives no rows.  Sequence ids
    depend on how the input is split into tasks, not on retries."""
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return rows.mapInArrow(_pack_task(tokenizer_path, capacity, end_id), SCHEMA)


def word_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_bpe())

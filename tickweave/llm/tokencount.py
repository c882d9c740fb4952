"""Token counts of a unigram model by dynamic programming shared over a trie.

A pre-token is a white-space word behind the word mark.  The best segmentation of a prefix
does not depend on what follows, so in a trie of the distinct pre-tokens each node's forward
score is computed once, from the nodes above it, however many pre-tokens pass through it.
New pre-tokens are inserted in sorted order: the trie is walked depth first and only the
path to the current pre-token is held.  The token count at a pre-token's last node is stored
and every further occurrence is a lookup.

The vocabulary file holds pieces by rank; a piece's probability follows Zipf's law over the
ranks.  A character that no piece covers costs its UTF-8 bytes, each a token of the rank
after the last.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_blocks

MARK = "▁"
CACHE_WORDS = 600_000  # pre-tokens of a generation whose counts a worker remembers


class UnigramTrie:
    """Terminal counts of pre-tokens; ``pieces`` maps a piece to its log-probability."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.endings = {p[k:] for p in pieces for k in range(len(p))}  # stops a backward match
        total = math.log(sum(1 / r for r in range(1, len(pieces) + 2)))
        self.byte = -math.log(len(pieces) + 1) - total
        self.counts: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.nodes = 0  # forward scores computed

    def insert(self, words: set[str]) -> None:
        """Store the counts of new words."""
        pieces, endings, byte = self.pieces, self.endings, self.byte
        path, score, count = "", [0.0], [0]
        for word in sorted(words):
            token = MARK + word
            shared, top = 0, min(len(path), len(token))
            while shared < top and path[shared] == token[shared]:
                shared += 1
            del score[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(token) + 1):
                best = score[end - 1] + byte * (n := len(token[end - 1].encode()))
                tokens = count[end - 1] + n
                start = end - 1
                while start >= 0 and (piece := token[start:end]) in endings:
                    if piece in pieces:
                        here = score[start] + pieces[piece]
                        if here > best or here == best and count[start] + 1 < tokens:
                            best, tokens = here, count[start] + 1
                    start -= 1
                score.append(best)
                count.append(tokens)
            self.nodes += len(token) - shared
            path = token
            self.counts[word] = count[-1]

    def totals(self, texts: list) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of each text."""
        rows = [(t or "").split() for t in texts]
        if len(self.counts) > CACHE_WORDS:
            self.counts, self.older = {}, self.counts
        new = set().union(*rows).difference(self.counts)
        for word in new.intersection(self.older):
            self.counts[word] = self.older[word]
        self.insert(new.difference(self.older))
        get = self.counts.__getitem__
        return [len(r) for r in rows], [sum(map(get, r)) for r in rows]


def zipf_pieces(path: str) -> dict[str, float]:
    """Log-probabilities of a sentencepiece file's normal pieces, by rank."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / r for r in range(1, len(names) + 2)))
    return {p: -math.log(r) - total for r, p in enumerate(names, 1)}


_TRIES: dict[str, UnigramTrie] = {}


def trie(path: str) -> UnigramTrie:
    """The worker's trie (its terminal counts are kept between tasks)."""
    if path not in _TRIES:
        _TRIES[path] = UnigramTrie(zipf_pieces(path))
    return _TRIES[path]


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row.

    Null, empty and blank texts count 0; repeated rows come back repeated; other columns are
    ignored; an empty table gives no rows."""
    def run(batches):
        counter = trie(vocabulary_path)
        for part, texts in text_blocks(batches):
            words, tokens = counter.totals(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.array(words, np.int64)),
                 pa.array(np.array(tokens, np.int64))], names=["doc_id", "n_words", "n_tokens"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def piece_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op8_trie_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), piece_vocabulary())

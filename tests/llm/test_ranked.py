"""Ranked search against brute force: ties, nulls, repeated rows, bounded shards and blocks."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import PLAIN

from tickweave.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_words = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in held:
            n, score = c.total(), 0
            m = 100 - 90 + (90 * n * n_docs) // n_words
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_terms_are_those_of_the_pattern():
    text = "AÄb ß_x-9\x00\x7fİ é.É 東京"
    assert [t.decode() for t in ranked.terms_of(text)] == terms(text)


@pytest.mark.parametrize("shard, block", [(1_000_000, 200_000), (40, 6)])
def test_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(ranked, "TERM_BLOCK", block)
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)]
    docs = [(k, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(30)], k=rng.randint(0, 25)))) for k in range(120)]
    docs += [(k, "w3 w5 w5 common") for k in range(500, 540)] + [(7, "w3 w29"), (None, "w3 w5 w5 common"), (900, None), (901, " .")]
    items = [(1, "w3 W5 w5 nowhere"), (2, "w29 w28 w27"), (3, None), (4, "... "), (2, "w29 w28 w27"), (None, "common"), (5, "absent")]
    got = ranked.rank_documents(
        spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, terms string").repartition(3),
        spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, item int"))
    assert rows(got) == brute(docs, items)


def test_edge_tables(spark, nasty, empty, benchmark):
    got = ranked.rank_documents(nasty, benchmark)
    assert rows(got) == brute([(r.doc_id, r.text) for r in nasty.collect()],
                              [(r.item_id, r.text) for r in benchmark.collect()])
    assert PLAIN and {r.item_id for r in got.collect()} == {10, 11, 14, None}
    assert ranked.rank_documents(empty, benchmark).count() == 0
    assert ranked.rank_documents(nasty, benchmark.limit(0)).count() == 0


def test_search_reads_less_than_all_and_keeps_ties():
    rng = np.random.default_rng(1)
    terms_of, docs, values = [], [], []
    for t in range(3):
        for d in rng.permutation(5000):
            terms_of.append(t)
            docs.append(d)
            values.append(1000 if d % 50 == 0 else int(rng.integers(1, 20)))
    lists = ranked.Lists(np.array(terms_of), np.array(docs), np.array(values, np.int64), 3)
    found, scores = lists.search([0, 1, 2], 5000, 10, 0)
    assert set(found[scores == 3000]) == set(range(0, 5000, 50))  # all ties of the best
    assert len(found) < 5000 and set(lists.search([0, 1, 2], 5000, 10, 3001)[0]) == set()

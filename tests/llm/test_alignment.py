"""Cross-tokenizer alignment against whole-text encoding and brute-force counts."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickweave.llm import alignment as al


@pytest.fixture(scope="module")
def model():
    return al.Aligner(al.byte_bpe(), al.piece_bpe())


def whole(model, text):
    """Token ids of both tokenizers of the whole text, or None."""
    if not text:
        return None
    a, b = model.a.encode(" " + text, add_special_tokens=False).ids, model.b.encode(text)
    raw = (" " + text).encode()
    return (a, b) if b"".join(model.a_bytes[j] for j in a) == raw == b"".join(model.b_bytes[j] for j in b) else None


def groups(model, a, b):
    ends_a, ends_b = (np.cumsum([len(x[j]) for j in ids]).tolist() for x, ids in ((model.a_bytes, a), (model.b_bytes, b)))
    out, links, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
        out.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        links.append((a[p - 1], b[q - 1]))
        i, j = p, q
    return ";".join(out), links


def brute(model, texts):
    found = [whole(model, t) for t in texts]
    aligned = [groups(model, *x) if x else ("", []) for x in found]
    count = Counter(link for _, links in aligned for link in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(len(x[0]) if x else 0, len(x[1]) if x else 0, len(links), len(links), sum(count[k] == best[k[1]] for k in links),
             sum(count[k] for k in links), hashlib.sha256(g.encode()).hexdigest() if x else "") for x, (g, links) in zip(found, aligned)]


PIECES = [*"abcXY  \n\n\t\r01'!.é東　\xa0\x1c\x85▁<|>s²ſΆά;", "'s", " the", "<|endoftext|>", "<s>", "́", "👍", "\x00", '."', "ing."]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=14).map("".join)))
def test_units_give_the_whole_texts_tokens(model, text):
    parts = model.parts(text)
    units = dict(zip(distinct := list(set(parts)), model.aligned(distinct)))
    got = None if not parts or any(units[p] is None for p in parts) else ";".join(units[p][3] for p in parts)
    x = whole(model, text)
    assert got == (groups(model, *x)[0] if x else None)


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 1 << 32, n))
        f = al.PerfectHash.of(keys)
        assert sorted(f.places(keys)) == list(range(len(keys)))  # minimal and perfect
        again = al.PerfectHash.unpack(*f.pack())
        assert np.array_equal(again.places(keys), f.places(keys))


@pytest.mark.parametrize("shard_keys, fan, chars", [(4096, 32, 2_000_000), (16, 2, 60)])
def test_brute_force(spark, model, monkeypatch, shard_keys, fan, chars):
    monkeypatch.setattr(al, "SHARD_KEYS", shard_keys)
    monkeypatch.setattr(al, "FAN", fan)
    rng = random.Random(8)
    words = ["the", "The", "token", "unbelievable", "straße", "東京", "x1", "don't", "end.", "(a)", "\n", "  "]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 20))) for _ in range(60)]
    texts += [None, "", " ", "a▁b the the", "the " * 2000, texts[0], texts[0], "<|endoftext|><s>"]
    docs = spark.createDataFrame([(k // 2 if k > 3 else None, t, 1, "x") for k, t in enumerate(texts)],
                                 "doc_id long, text string, block int, pairs string").repartition(3).cache()
    if chars < 1000:  # several blocks a task, so that the count vectors are summed in more than one round
        monkeypatch.setattr(al.text_blocks, "__defaults__", ("text", chars))
    got = al.align(docs, al.byte_bpe(), al.piece_bpe())
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted([(d, *x) for (d, _), x in zip(rows, brute(model, [t for _, t in rows]))], key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_edge_tables(nasty, empty):
    got = al.align(nasty, al.byte_bpe(), al.piece_bpe()).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in nasty.collect())
    by = {r.doc_id: r for r in got}
    assert by[3].n_a == by[4].n_b == by[3].count_sum == 0 and by[3].groups_sha256 == by[4].groups_sha256 == ""
    assert by[5].n_a > 0 and by[6].n_links >= 100_000 and by[7].n_groups > 0
    assert al.align(empty, al.byte_bpe(), al.piece_bpe()).count() == 0

"""Decontamination: shared phrases, long items, fully copied texts, row keys, both ways to join."""
import time

import pytest

from tickweave.llm import decontaminate as dc


def frames(spark, docs, items):
    return (spark.createDataFrame([(k, t) for k, t in enumerate(docs)], "doc_id long, text string").repartition(4),
            spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string"))


def run(spark, docs, items):
    return {r.doc_id: r for r in dc.contamination(*frames(spark, docs, items)).collect()}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_a_long_item_and_a_full_copy(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "MAX_BROADCAST_ROWS", limit)
    long = " ".join(f"w{k}" for k in range(20_000))
    got = run(spark, [long, "x " + long[:200_000].rsplit(" ", 1)[0], " ".join(f"w{2 * k}" for k in range(500)), "clean words only here"],
              [long, "w5 w6 w7"])
    assert (got[0].n_words, got[0].n_hit, got[0].n_items) == (20_000, 20_000, 2)
    assert got[1].n_hit == got[1].n_words - 1 and got[1].n_items == 2
    assert not got[2].contaminated and not got[3].contaminated


def test_a_phrase_in_every_item_and_document(spark):
    """A shared window makes rows by its places and a shared k-gram without a window few, not documents times items."""
    nine, ten = " ".join(f"c{k}" for k in range(9)), " ".join(f"d{k}" for k in range(10))
    docs = [f"a{k} {nine} b{k} {ten}" for k in range(600)]
    items = [f"p{k} {nine} q{k} r{k} {ten} s{k}" for k in range(600)]
    docs_frame, items_frame = frames(spark, docs, items)
    matched, sets = dc.hits(docs_frame, items_frame)
    assert matched.where("start IS NOT NULL").distinct().count() == 600  # one window each, not 600 x 600
    got = dc.contamination(docs_frame, items_frame).collect()
    assert {(r.n_hit, r.n_items, r.contaminated) for r in got} == {(10, 600, True)} and len({r.items_sha256 for r in got}) == 1
    assert sets.count() >= 1


def test_time_grows_with_the_item_and_not_its_square(spark):
    def seconds(n):
        text = " ".join(f"w{k}" for k in range(n))
        began = time.time()
        assert run(spark, [text], [text])[0].n_hit == n
        return time.time() - began
    seconds(1000)
    small, large = seconds(2_000), seconds(16_000)
    assert large < 5 * small + 5  # eight times the words


def test_clash_with_the_row_key(spark, benchmark):
    docs = spark.createDataFrame([(1, "clean", 7), (None, "one", 7), (None, "clean too", 8)], "doc_id long, text string, _row_key long")
    kept = dc.keep_clean(docs, benchmark).collect()
    assert sorted(r._row_key for r in kept) == [7, 8] and {r.text for r in kept} == {"clean", "clean too"}

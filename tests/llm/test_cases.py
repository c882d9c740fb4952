"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""
from collections import Counter

import numpy as np
from llm_cases import LONG, NASTY, PLAIN
from pyspark.sql import functions as F

import corpus_pipeline
from tickweave.llm import (decontaminate, langid, packing, quality, quotes, simhash, tokencount, topk, toxicity,
                           wrappers)
from tickweave.llm.common import Scratch

IDS = Counter(r[0] for r in NASTY)


def ids(df):
    return Counter(r[0] for r in df.select("doc_id").collect())


def test_decontamination(nasty, empty, benchmark):
    got = decontaminate.contamination(nasty, benchmark).collect()
    assert Counter(r.doc_id for r in got) == IDS
    by = {r.doc_id: r for r in got}
    assert by[1].n_hit == 14 and by[1].n_items == 2  # words 0-10 of the unnamed item, 2-13 of 10 and 14
    assert by[8].n_hit == 1 and by[8].n_items == 1 and by[8].n_words == 1
    assert not by[3].contaminated and by[4].n_words == 0 and by[6].n_words == 100_000
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert not [r for r in decontaminate.contamination(nasty, benchmark.limit(0)).collect() if r.contaminated]
    kept = decontaminate.keep_clean(nasty, benchmark)
    assert kept.columns == nasty.columns and ids(kept) == Counter([3, 4, 5, 6, 7])  # the row without doc_id is judged like others


def test_shuffled_benchmark_gives_the_same(nasty, benchmark, monkeypatch):
    want = sorted(map(str, decontaminate.contamination(nasty, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_ROWS", 0)
    assert sorted(map(str, decontaminate.contamination(nasty, benchmark).collect())) == want


def test_simhash(nasty, empty):
    got = simhash.near_duplicates(nasty)
    assert ids(got) == IDS
    by = {r.doc_id: r for r in got.collect()}
    assert by[2].component_id == 1 and by[3].component_id == by[5].component_id == 3 and by[3].fp == 0
    assert by[6].component_id == 6
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(nasty)
    assert kept.columns == nasty.columns and ids(kept) == Counter([1, 3, None, 6, 7, 8])


def test_packing(nasty, empty):
    path = packing.word_bpe()
    got = packing.pack(nasty, path).collect()
    assert {r.doc_id for r in got} == set(IDS)
    by = {r.doc_id: r for r in got}
    assert by[3].doc_tokens == by[4].doc_tokens == by[5].doc_tokens == 1
    assert sum(r.length for r in got if r.doc_id == 6) == by[6].doc_tokens
    assert packing.pack(empty, path).count() == 0


def test_quality(nasty, empty, labels):
    model = quality.fit(nasty, labels)
    got = quality.score(nasty, model)
    assert ids(got) == IDS and {r.log_weight for r in got.where("doc_id in (3, 4, 5)").collect()} == {0.0}
    assert quality.keep_selected(nasty, model).columns == nasty.columns
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0
    none = quality.fit(nasty, labels.limit(0))
    assert ids(quality.keep_selected(nasty, none)) == IDS


def test_toxicity(nasty, empty, labels):
    got = toxicity.score(nasty, toxicity.fit(nasty, labels))
    assert ids(got) == IDS and got.where("score between 0 and 1").count() == len(NASTY)
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0
    none = toxicity.fit(nasty, labels.limit(0))
    assert toxicity.score(nasty, none).agg(F.max("score")).first()[0] < 1e-9
    kept = toxicity.keep_clean(nasty, none)
    assert kept.columns == nasty.columns and ids(kept) == IDS


def test_language(spark, nasty, empty):
    model = langid.fit(nasty, Scratch(spark, "test"))
    got = langid.identify(nasty, model)
    assert ids(got) == IDS
    by = {r.doc_id: r for r in got.collect()}
    assert by[3].lang_pred == by[4].lang_pred == by[5].lang_pred == "und" and by[3].score == 0 and by[3].rejected
    assert by[6].lang_pred in model.langs
    assert langid.fit(empty, Scratch(spark, "test")) is None
    assert {r.lang_pred for r in langid.identify(nasty, None).collect()} == {"und"}


def test_token_counts(nasty, empty):
    got = tokencount.token_counts(nasty, tokencount.piece_vocabulary())
    assert ids(got) == IDS
    by = {r.doc_id: r for r in got.collect()}
    assert by[3].n_tokens == by[4].n_tokens == by[5].n_tokens == 0 and by[6].n_words == 100_000
    assert by[1].n_words == len(PLAIN.split())
    assert tokencount.token_counts(empty, tokencount.piece_vocabulary()).count() == 0


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, None, 1), (3, [nan, 1.0], 1),
            (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (None, [1.0, 1.0], 1), (6, [], 1), (7, [-1.0], 1), (200, [], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = topk.top_k(vectors).orderBy("query_id", "rank").collect()
    by = {q: [(r.vec_id, r.score) for r in got if r.query_id == q] for q in (0, 100, 200)}
    one = 5 * 1024 ** 2
    assert by[0] == [(1, one), (1, one), (100, one), (6, 0), (200, 0), (7, -(1024 ** 2))]  # every row but the query's own
    assert [v for v, _ in by[200]] == [0, 1, 1, 6, 7, 100]
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [5.0, 5.0]), (100, [0.0, 2.0]), (100, [3.0, 0.0])],
                                  "vec_id long, embedding array<float>")
    got = [(r.query_id, r.vec_id, r.score // 1024 ** 2) for r in topk.top_k(twice).orderBy("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == sorted([(0, 1, 5), (0, 100, 3), (0, 1, 1), (0, 100, 0), (100, 1, 10), (100, 0, 0), (100, 1, 0), (100, 100, 0),
                                  (100, 1, 15), (100, 0, 3), (100, 1, 3), (100, 100, 0)])
    assert topk.top_k(vectors.limit(0)).count() == 0


def test_pages(spark):
    rows = [(1, "http://h/a", "<article><p>x &amp; y</p></article>", "t", 1), (2, "http://h/b", None, "t", 1), (3, None, "", "t", 1),
            (None, "http://[bad", "<p>z", "t", 1), (4, "http://h/c", "<nav>m</nav>", "t", 1),
            (5, "http://h/d", "<p>" + LONG, "t", 1), (5, "http://h/d", "<p>" + LONG, "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int")
    got = wrappers.main_text(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and by[1].text == "x & y" and by[2].text == by[3].text == by[4].text == ""
    assert by[None].text == "z" and by[5].n_chars == len(LONG.strip())
    assert wrappers.main_text(pages.limit(0)).count() == 0


def test_conversations(spark):
    rows = [(1, 0, "u", "Hello there.", 1), (1, 0, "u", "Hello there.", 1), (1, 1, None, None, 1), (1, 2, "u", "> hello there\nyes", 1),
            (None, 0, "u", "> a\nb", 1), (2, None, "u", "c", 1), (3, 0, "u", LONG, 1), (3, 1, "u", "> " + LONG, 1)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, root int")
    got = quotes.link(chats).collect()
    by = {(r.conv_id, r.turn): r for r in got}
    assert len(got) == len(rows)  # repeats and differing messages of one turn stay
    assert by[1, 2].parent == 0 and by[1, 2].text == "yes" and by[1, 1].text == "" and by[1, 1].parent == 0
    assert by[None, 0].text == "b" and by[None, 0].root is None and by[2, None].text == "c"
    assert by[3, 1].n_linked == 1 and by[3, 1].text == ""
    assert quotes.link(chats.limit(0)).count() == 0


def test_stages_keep_the_columns(spark, nasty, empty, benchmark, labels, tmp_path):
    for name, df in (("documents", nasty), ("benchmark", benchmark), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == nasty.columns, name
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert np.all([r.length > 0 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()])

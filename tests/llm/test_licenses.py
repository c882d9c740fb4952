"""License scans: word places, levels, suppression, edge rows, agreement with SQL on an own fixture."""
import re

import duckdb

from tickweave.llm import licenses

TEXTS = [
    (1, "This work is licensed under the GNU General Public License, version 3."), (2, "Released under the MIT license."),
    (3, "licensed under CC BY-NC 4.0."), (4, "SPDX-License-Identifier: Apache-2.0"), (5, "gnu\ngeneral/public  LICENSE gnu general public license"),
    (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (7, "the gpl and the GPLv2, apache"),
    (8, None), (9, ""), (10, "mit licence; mit licensed; cc; by"), (10, "MIT License"), (None, "cc by"),
    (11, "the license of https://www.gnu.org/licenses/gpl-3.0.html or GPL 3.0 or later"), (12, "free words " * 3000 + "mit license"),
    (13, "Ünder the mit lıcense"), (14, "licensed under the apache license"), (15, "mit license mit license"),
]


def table(spark):
    return spark.createDataFrame([(*t, "s", 1.0) for t in TEXTS], "doc_id long, text string, labels string, score double").repartition(3)


def test_rules_are_hundreds_and_each_starts_with_its_keyword():
    listed = licenses.rules()
    assert len(listed) > 300 and [r[0] for r in listed] == list(range(len(listed)))
    for _, keyword, needs, pattern, label, level in listed:
        assert re.fullmatch(r"[a-z0-9]+", keyword) and re.fullmatch(r"[a-z0-9 ]+", needs) and label
        assert level == 2 or pattern.startswith(f"^({keyword}")
        re.compile(pattern)


def test_labels(spark):
    by = {(r.doc_id, r.n_words): r for r in licenses.scan(table(spark)).collect()}
    assert len(by) == len(TEXTS)

    def of(doc_id):
        return next(r for (d, _), r in by.items() if d == doc_id)
    assert of(1).labels == "gpl,gpl-3.0" and of(1).base_labels == "gpl" and of(1).first_word == of(1).last_word == 6 and of(1).score == 0.9
    assert of(2).labels == "mit" and of(3).labels == "cc-by,cc-by-nc-4.0" and of(3).base_labels == "cc-by"
    assert of(4).labels == "apache-2.0" and of(4).base_labels == "" and of(4).score == 1.0 and of(4).first_word is None
    assert of(5).n_base == 2 and (of(5).first_word, of(5).last_word) == (0, 4)
    assert of(6).labels == "mit" and of(6).n_base == 0 and of(7).labels == "gpl"
    assert of(8).labels == of(9).labels == "" and of(8).n_words == 0 and of(8).score == 0.0 and of(8).n_base == 0
    assert by[10, 6].base_labels == "cc-by" and by[10, 6].labels == "cc-by,mit" and by[10, 2].n_base == 1 and of(None).base_labels == "cc-by"
    assert of(11).labels == "gpl-3.0" and of(12).first_word == 6000 and of(13).base_labels == ""
    assert of(15).n_base == 2 and licenses.scan(table(spark).limit(0)).count() == 0


def test_containment_and_levels(spark):
    found = [r for r in licenses.detections(table(spark)).collect() if r.doc_id in (1, 14) and r.level and r.level < 9]
    kept = {(r.doc_id, r.label, r.start, r.stop) for r in found if r.kept}
    assert kept == {(1, "gpl-3.0", 3, 12), (14, "apache", 0, 5)}  # the names inside the notices are suppressed
    assert {(r.label, r.level) for r in found if not r.kept and r.doc_id == 1} >= {("gpl", 4), ("gpl-3.0", 3)}


def test_sql_says_the_same(spark):
    con = duckdb.connect()
    docs = table(spark).select("doc_id", "text").toPandas()  # noqa: F841  read by name
    con.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM docs")
    want = sorted(con.sql(licenses.OP11_SQL).fetchall(), key=repr)
    assert sorted(map(tuple, licenses.scan(table(spark)).collect()), key=repr) == want

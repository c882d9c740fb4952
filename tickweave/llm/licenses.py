"""License scans by ordered signature rules, with DataFrame functions only.

A rule is a regular expression over the lower-case words of a text, joined by single
spaces.  It starts with a literal word, its keyword.  Only places where a rule's keyword
stands are looked at, and only rules whose second literal stands behind the keyword are
tried: their expression is matched from the keyword on, over at most ``SPAN`` words.

Rules are ordered by level: identifier tags, addresses and sentences of a license's own text
(1), notices such as "licensed under the ..." (2), names with a version (3), bare names (4).
A detection that lies inside another one of the same or a stronger level is suppressed, so
"Apache License" inside "licensed under the Apache License, Version 2.0" is no detection of
its own.  Detections that merely overlap stay.

The counted base phrases are rules as well, outside the suppression.

Texts are read once and never shuffled: a place carries its few words along, and one row per
place that matched (and one per text) meets the others of its text by row number.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .decontaminate import LOWER, UPPER, words

SPAN = 24  # words a rule can look at, its keyword included
LEVELS = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.5}  # confidence of a detection by its level
BASE = 9  # level of the base phrases

# Phrases whose places are counted, and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
                "mit license": "mit"}

_L = "licen[cs]e"
# label; versions; expressions of the name, each behind a literal word.  A name with "=" in
# front only counts with a version behind it.
LICENSES = [
    ("gpl", "1.0 2.0 3.0", [f"gnu general public {_L}", "gnu gpl", "gpl", f"general public {_L}"]),
    ("lgpl", "2.0 2.1 3.0", [f"gnu (?:lesser|library) general public {_L}", "gnu lgpl", "lgpl",
                             f"lesser general public {_L}", f"library general public {_L}"]),
    ("agpl", "1.0 3.0", [f"gnu affero general public {_L}", "gnu agpl", "agpl", f"affero general public {_L}",
                         "affero gpl"]),
    ("gfdl", "1.1 1.2 1.3", [f"gnu free documentation {_L}", "gnu fdl", "gfdl"]),
    ("apache", "1.0 1.1 2.0", [f"apache (?:software |public )?{_L}", "=apache", "=asl"]),
    ("mpl", "1.0 1.1 2.0", [f"mozilla public {_L}", "mpl"]),
    ("epl", "1.0 2.0", [f"eclipse public {_L}", "=epl"]),
    ("edl", "1.0", [f"eclipse distribution {_L}"]),
    ("cpl", "1.0", [f"common public {_L}"]),
    ("cpal", "1.0", [f"common public attribution {_L}", "cpal"]),
    ("cddl", "1.0 1.1", [f"common development and distribution {_L}", "cddl"]),
    ("eupl", "1.0 1.1 1.2", [f"european union public {_L}", "eupl"]),
    ("artistic", "1.0 2.0", [f"artistic {_L}", f"perl artistic {_L}", "=artistic"]),
    ("afl", "1.1 1.2 2.0 2.1 3.0", [f"academic free {_L}", "=afl"]),
    ("osl", "1.0 1.1 2.0 2.1 3.0", [f"open software {_L}", "=osl"]),
    ("ecl", "1.0 2.0", [f"educational community {_L}"]),
    ("ofl", "1.0 1.1", [f"sil open font {_L}", f"open font {_L}", "=ofl"]),
    ("php", "3.0 3.01", [f"php {_L}"]),
    ("psf", "2.0", [f"python software foundation {_L}", f"psf {_L}", f"python {_L}"]),
    ("zpl", "1.1 2.0 2.1", [f"zope public {_L}", "=zpl"]),
    ("lppl", "1.0 1.1 1.2 1.3", [f"latex project public {_L}", "lppl"]),
    ("cecill", "1.0 1.1 2.0 2.1", ["cecill"]),
    ("bsl", "1.0", [f"boost software {_L}", "=bsl"]),
    ("busl", "1.1", [f"business source {_L}", "busl"]),
    ("sspl", "1.0", [f"server side public {_L}", "sspl"]),
    ("elastic", "1.0 2.0", [f"elastic {_L}"]),
    ("odbl", "1.0", [f"open database {_L}", "odbl"]),
    ("odc-by", "1.0", [f"open data commons attribution {_L}"]),
    ("pddl", "1.0", [f"open data commons public domain dedication and {_L}", "pddl"]),
    ("upl", "1.0", [f"universal permissive {_L}"]),
    ("mulanpsl", "1.0 2.0", [f"mulan permissive software {_L}", "mulan psl"]),
    ("apsl", "1.0 1.1 1.2 2.0", [f"apple public source {_L}", "apsl"]),
    ("npl", "1.0 1.1", [f"netscape public {_L}"]),
    ("qpl", "1.0", [f"q public {_L}"]),
    ("sgi-b", "1.0 1.1 2.0", [f"sgi free software {_L} b"]),
    ("cpol", "1.02", [f"code project open {_L}", "cpol"]),
    ("nasa", "1.3", ["nasa open source agreement"]),
    ("ipl", "1.0", [f"ibm public {_L}"]),
    ("rpl", "1.1 1.5", [f"reciprocal public {_L}"]),
    ("sissl", "1.1 1.2", [f"sun industry standards source {_L}", "sissl"]),
    ("spl", "1.0", [f"sun public {_L}"]),
    ("oldap", "2.7 2.8", [f"openldap public {_L}"]),
    ("blueoak", "1.0.0", [f"blue oak model {_L}"]),
    ("cc0", "1.0", ["cc0", "creative commons (?:zero|cc0)"]),
    ("ms-pl", "", [f"microsoft public {_L}", "ms pl"]),
    ("ms-rl", "", [f"microsoft reciprocal {_L}", "ms rl"]),
    ("w3c", "", [f"w3c (?:software (?:notice and )?)?{_L}"]),
    ("vim", "", [f"vim {_L}"]),
    ("ruby", "", [f"ruby {_L}"]),
    ("zlib", "", [f"zlib (?:libpng )?{_L}"]),
    ("libpng", "", [f"libpng {_L}"]),
    ("libtiff", "", [f"libtiff {_L}"]),
    ("ijg", "", [f"independent jpeg group {_L}", f"ijg {_L}"]),
    ("isc", "", [f"isc {_L}"]),
    ("mit", "", [f"mit {_L}", f"mit x11 {_L}", f"expat {_L}"]),
    ("mit-0", "", ["mit no attribution", "mit 0"]),
    ("x11", "", [f"x11 {_L}", f"x consortium {_L}"]),
    ("xfree86", "", [f"xfree86 {_L}"]),
    ("bsd", "", [f"bsd (?:style )?{_L}", f"berkeley software distribution {_L}"]),
    ("bsd-1-clause", "", ["bsd 1 clause"]),
    ("bsd-2-clause", "", ["bsd 2 clause", "simplified bsd", f"freebsd {_L}"]),
    ("bsd-3-clause", "", ["bsd 3 clause", "modified bsd", "revised bsd"]),
    ("bsd-4-clause", "", ["bsd 4 clause", "original bsd"]),
    ("0bsd", "", ["0bsd", "bsd zero clause", "zero clause bsd"]),
    ("ncsa", "", [f"university of illinois ncsa open source {_L}", f"ncsa open source {_L}"]),
    ("openssl", "", [f"openssl {_L}"]),
    ("postgresql", "", [f"postgresql {_L}"]),
    ("curl", "", [f"curl {_L}"]),
    ("json", "", [f"json {_L}"]),
    ("tcl", "", [f"tcl (?:tk )?{_L}"]),
    ("ntp", "", [f"ntp {_L}"]),
    ("sleepycat", "", [f"sleepycat {_L}"]),
    ("hpnd", "", ["historical permission notice and disclaimer"]),
    ("fair", "", [f"fair {_L}"]),
    ("unlicense", "", ["unlicense"]),
    ("wtfpl", "", ["wtfpl", f"do what the fuck you want to public {_L}"]),
    ("beerware", "", [f"beerware {_L}", f"beer ware {_L}"]),
]
CC_TERMS = {"by": " attribution", "nc": " non ?commercial", "sa": " share ?alike", "nd": " no ?deriv(?:ative)?s(?: works)?"}
CC_KINDS = ["by", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd"]
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

# Sentences of the licenses' own texts and their labels.
SENTENCES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of .{1,80} nor the names of its contributors may be used to endorse"),
    ("gpl", f"free software you can redistribute it and or modify it under the terms of the gnu general public {_L}"),
    ("lgpl", f"free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public {_L}"),
    ("agpl", f"free software you can redistribute it and or modify it under the terms of the gnu affero general public {_L}"),
    ("apache-2.0", "except in compliance with the license you may obtain a copy of the license at"),
    ("mpl-2.0", f"source code form is subject to the terms of the mozilla public {_L} v 2 0"),
    ("zlib", "provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("cc0-1.0", "dedicated the work to the public domain by waiving all of (?:his|her|their)"),
    ("public-domain", "public domain dedication"),
    ("public-domain", "released (?:in|in)to the public domain"),
    ("public-domain", "placed in(?:to)? the public domain"),
    ("public-domain", "dedicated to the public domain"),
    ("beerware", "beer ware license revision"),
    ("wtfpl", "do what the fuck you want to"),
    ("proprietary", "proprietary and confidential"),
    ("proprietary", "unauthorized (?:copying|use|reproduction) of this (?:file|software|document|material)"),
    ("all-rights-reserved", "all rights reserved"),
    ("commercial", "commercial licen[cs]e agreement"),
    ("eula", "end user licen[cs]e agreement"),
]
# Addresses (their words) and their labels.
ADDRESSES = [
    ("gpl-2.0", "gnu org licenses (?:old licenses )?gpl 2 0"), ("gpl-3.0", "gnu org licenses gpl 3 0"),
    ("gpl", "gnu org (?:licenses|copyleft) gpl"), ("lgpl-2.1", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu org licenses lgpl 3 0"), ("agpl-3.0", "gnu org licenses agpl 3 0"), ("gfdl", "gnu org (?:licenses|copyleft) fdl"),
    ("apache-2.0", "apache org licenses license 2 0"), ("apache-1.1", "apache org licenses license 1 1"),
    ("mpl-2.0", "mozilla org mpl 2 0"), ("mpl-1.1", "mozilla org mpl mpl 1 1"), ("epl-1.0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse org legal epl (?:v20|2 0)"), ("mit", "opensource org licenses mit"), ("isc", "opensource org licenses isc"),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause"), ("bsd-3-clause", "opensource org licenses bsd 3 clause"),
    ("apache-2.0", "opensource org licenses apache 2 0"), ("artistic-2.0", "opensource org licenses artistic 2 0"),
    ("bsl-1.0", "boost org license 1 0"), ("unlicense", "unlicense org"), ("wtfpl", "wtfpl net"), ("ofl-1.1", "scripts sil org ofl"),
    ("cc0-1.0", "creativecommons org publicdomain zero 1 0"), ("public-domain", "creativecommons org publicdomain mark 1 0"),
]

VERBS = ["licensed", "licenced", "released", "distributed", "redistributed", "available", "published", "provided", "covered", "shared"]
NOTICE = "(?:[a-z]+ ){0,2}?(?:under|by) (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?"


def _version(v: str) -> str:
    """Words of a version: "version 2", "v2 0", "2 0 or later"."""
    major, *minor = v.split(".")
    rest = "".join(f" {m}" for m in minor)
    rest = f"(?:{rest})?" if set(minor) == {"0"} else rest
    return f"(?: version| ver| v| {_L})? v?{major}{rest}(?: or (?:any )?later(?: version)?| only| international| unported)?"


def rules() -> list[tuple]:
    """(rule, keyword, needs, pattern, label, level): the whole ordered list.  ``pattern`` is matched from
    the keyword on and must end with a word; ``needs`` is a literal that stands in its match."""
    found = []

    def add(keyword: str, needs: str, body: str, label: str, level: int) -> None:
        found.append((len(found), keyword, needs, f"^({body})(?: |$)", label, level))

    named = [*LICENSES, *((f"cc-{kind}", CC_VERSIONS, [
        "creative commons" + "".join(CC_TERMS[t] for t in kind.split("-")), "cc " + kind.replace("-", " ")]) for kind in CC_KINDS)]
    for label, sentence in [*SENTENCES, *ADDRESSES]:
        first, rest = sentence.split(" ", 1)
        add(first, rest.split(" ")[-1] if re.fullmatch(r"[a-z0-9 ]+", rest) else first, sentence, label, 1)
    for stem, versions, names in named:
        for v in [f"-{v}" for v in versions.split()] or [""]:
            tag = re.sub(r"[-.]", " ", stem + v)
            add("spdx", tag.split(" ")[0], f"spdx license identifier {tag}(?: only| or later)?", stem + v, 1)
    for level in (2, 3, 4):
        for stem, versions, names in named:
            for name in names:
                body, first = name.lstrip("="), name.lstrip("=").split(" ")[0]
                known = [(stem, "")] if level != 3 and name[0] != "=" else []
                if level < 4:
                    known += [(f"{stem}-{v}", _version(v)) for v in versions.split()]
                for label, tail in known:
                    if level == 2:
                        add(VERBS[0], first, f"[a-z]+ {NOTICE}{body}{tail}", label, level)
                    else:
                        add(first, first, body + tail, label, level)
    for phrase, label in BASE_PHRASES.items():
        add(phrase.split(" ")[0], phrase, phrase, label, BASE)
    return found


RULES = "rule int, keyword string, needs string, pattern string, label string, level int"


def detections(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, start, stop, label, level, kept): every match of a rule as word places (from 0, stop
    excluded), whether it is kept or suppressed; one row without label per text besides."""
    listed = rules()
    keywords = sorted({r[1] for r in listed} | set(VERBS))
    within = ", ".join(f"'{w}'" for w in keywords)
    verbs = ", ".join(f"'{w}'" for w in VERBS)
    places = (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                          words(F.col("text")).alias("words"))
              .selectExpr("row", "doc_id", "size(words) AS n_words", f"""
                  concat(transform(filter(sequence(0, size(words)), i -> get(words, i) IN ({within})), i -> named_struct(
                      'start', i, 'keyword', IF(get(words, i) IN ({verbs}), '{VERBS[0]}', get(words, i)),
                      'context', array_join(slice(words, i + 1, {SPAN}), ' '))), array(NULL)) AS places""")
              .select("row", "doc_id", "n_words", F.explode("places").alias("place"))
              .select("row", "doc_id", "n_words", "place.*"))
    known = docs.sparkSession.createDataFrame(listed, RULES)
    matched = (places.join(F.broadcast(known), "keyword", "left")  # the rules are a fixed list
               .where("keyword IS NULL OR (contains(context, needs) AND context RLIKE pattern)")
               .selectExpr("row", "doc_id", "n_words", "start", "rule", "label", "level",
                           "start + size(split(regexp_extract(context, pattern, 1), ' ')) AS stop"))
    before = (Window.partitionBy("row").orderBy("start", F.desc("stop"), "level", "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    reach = [F.max(F.when(F.col("level") <= n, F.col("stop"))).over(before) for n in LEVELS]
    covered = F.coalesce(F.get(F.array(*reach), F.col("level") - 1), F.lit(-1))
    return matched.withColumn("kept", F.when(F.col("level") == BASE, F.lit(True))
                              .when(F.col("level") < BASE, covered < F.col("stop")))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base (places of the base phrases), first_word and last_word (their
    smallest and largest start), base_labels, labels (with those of the kept detections), score.

    The score is the highest confidence among the labels' detections, 0 without any.  Null and empty
    texts have no words, no labels (empty strings) and null places; repeated rows come back repeated;
    other columns are ignored; an empty table gives no rows."""
    found = detections(docs)
    base, weight = F.col("level") == BASE, F.create_map(*[F.lit(x) for pair in [*LEVELS.items(), (BASE, LEVELS[4])] for x in pair])

    def joined(wanted):
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(wanted, F.col("label")))))
    return (found.groupBy("row", "doc_id", "n_words")
            .agg(F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
                 F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"), joined(base).alias("base_labels"),
                 joined(F.col("kept")).alias("labels"),
                 F.coalesce(F.max(F.when(F.col("kept"), F.element_at(weight, F.col("level")))), F.lit(0.0)).alias("score"))
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
                    "base_labels", "labels", "score"))


def op11_ordered_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    listed = rules()
    values = ",\n".join("({}, '{}', '{}', '{}', '{}', {})".format(*r) for r in listed)
    within = ", ".join(f"'{w}'" for w in sorted({r[1] for r in listed} | set(VERBS)))
    verbs = ", ".join(f"'{w}'" for w in VERBS)
    weight = " ".join(f"WHEN {n} THEN {w}" for n, w in LEVELS.items())
    return f"""
WITH rules(rule, keyword, needs, pattern, label, level) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
p AS (SELECT r, i - 1 AS start, CASE WHEN w[i] IN ({verbs}) THEN '{VERBS[0]}' ELSE w[i] END AS keyword,
             array_to_string(list_slice(w, i, i + {SPAN - 1}), ' ') AS context
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE w[i] IN ({within})),
m AS (SELECT r, start, rule, label, level, start + len(string_split(regexp_extract(context, pattern, 1), ' ')) AS stop
      FROM p JOIN rules USING (keyword) WHERE contains(context, needs) AND regexp_matches(context, pattern)),
s AS (SELECT *, level = {BASE} OR NOT EXISTS (
          SELECT 1 FROM m b WHERE b.r = a.r AND b.start <= a.start AND b.stop >= a.stop AND b.level <= a.level
             AND (b.start, -b.stop, b.level, b.rule) < (a.start, -a.stop, a.level, a.rule)) AS kept FROM m a),
g AS (SELECT r, count(*) FILTER (level = {BASE}) AS n_base, min(start) FILTER (level = {BASE}) AS first_word,
             max(start) FILTER (level = {BASE}) AS last_word,
             array_to_string(list_sort(list(DISTINCT label) FILTER (level = {BASE})), ',') AS base_labels,
             array_to_string(list_sort(list(DISTINCT label) FILTER (kept)), ',') AS labels,
             max(CASE level {weight} ELSE {LEVELS[4]} END) FILTER (kept) AS score FROM s GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (r)"""


OP11_SQL = _sql()

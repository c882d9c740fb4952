"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are grouped into k-grams; of every ``w`` consecutive k-gram hashes the smallest is
kept (the rightmost of equals).  Two texts that share ``w + k - 1`` words keep the same
hash inside the shared span, so with ``w + k - 1`` equal to the window length no shared
window is missed.  Kept document hashes are joined to the kept benchmark hashes, and a hit is
extended word by word to the windows around it, which must be windows of the benchmark.

A benchmark text shorter than a window is one window of its own length: its k-gram is the
whole text (``k`` its length, ``w`` 1).

A hit is extended to windows and not to items: the windows are distinct, so a phrase that is in
every item and every document costs one row per place, and a common k-gram that begins no
shared window costs a few.  Which items a document holds follows from the sets of items of its
windows; documents with the same sets share one union.

Documents are read once and their texts are never shuffled while the benchmark's distinct kept hashes
are within ``MAX_BROADCAST_ROWS`` (counted first); beyond that both sides are shuffled by
hash and a kept hash carries the words around it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, numbered, table

WINDOW = 10
GRAM = 5
MAX_BROADCAST_ROWS = 1_000_000  # distinct benchmark hashes (8 bytes each) sent to every task
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# a kept hash and its place in one number: 33 bits of the hash, then the place counted down,
# so that the smallest number is the smallest hash and, among equals, the rightmost
_PLACE = (1 << 31) - 1


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case (``lower`` does just that on ASCII texts)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lowered = (F.when(F.octet_length(text) == F.length(text), F.lower(text))
               .otherwise(F.translate(text, UPPER, LOWER)))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _grams(window: int, gram: int) -> str:
    """Hashed k-grams with their places (from 0), of texts that hold a window at all."""
    parts = ", ".join(f"get(words, i + {j})" for j in range(gram))
    return (f"CASE WHEN size(words) >= {window} THEN transform(sequence(0, size(words) - {gram}), i -> "
            f"shiftleft(shiftright(xxhash64({parts}, {window}), 31), 31) | CAST({_PLACE} - i AS BIGINT)) END")


def _kept(column: str, span: int) -> str:
    """Winnowed numbers: the smallest of every ``span`` neighbours, each once."""
    if span == 1:
        return f"coalesce({column}, array())"
    near = ", ".join(f"get({column}, i + {j})" for j in range(span))
    return (f"CASE WHEN {column} IS NULL THEN array() ELSE array_distinct(transform("
            f"sequence(0, size({column}) - {span}), i -> least({near}))) END")


def fingerprints(rows: DataFrame, short: list[int]) -> DataFrame:
    """Adds ``kept`` (array of numbers) to rows with ``words``; ``short`` are the lengths of
    benchmark texts below a window."""
    lengths = [(WINDOW, GRAM)] + [(n, n) for n in short]
    grams = rows.select("*", *[F.expr(_grams(w, k)).alias(f"_g{w}") for w, k in lengths])
    kept = [_kept(f"_g{w}", w - k + 1) for w, k in lengths]
    return grams.select(*rows.columns, F.expr(f"concat({', '.join(kept)})").alias("kept"))


def _place(number: str) -> str:
    return f"CAST({_PLACE} - ({number} & {_PLACE}) AS INT)"


def _benchmark(benchmark: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """Kept hashes (hash, window length), distinct windows (gram, set_id), their sets of items (set_id, items), and the
    lengths of short items."""
    items = scratch.keep(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
        .where(F.size("words") > 0).distinct().withColumn("window", F.least(F.size("words"), F.lit(WINDOW))), "items")
    short = sorted(r[0] for r in items.where(F.col("window") < WINDOW).select("window").distinct().collect())
    # explode would put a filter on its array below the projections and make it once more for every element
    hashes = scratch.keep(fingerprints(items.select("words").distinct(), short).select(F.explode_outer("kept").alias("number"))
                          .where("number IS NOT NULL").select(F.expr("shiftright(number, 31)").alias("hash")).distinct(), "hashes")
    grams = items.select("item_id", F.expr(
        "explode_outer(transform(sequence(0, size(words) - window), i -> slice(words, i + 1, window)))").alias("gram"))
    held = scratch.keep(grams.groupBy("gram").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
                        .withColumn("set_id", F.sha2(F.to_json("items"), 256)), "windows")
    return hashes, held.select("gram", "set_id"), held.select("set_id", "items").distinct(), short


def _around(at: str, size: str, lengths: list[int]) -> str:
    """First words of the windows that can hold a hit at ``at`` of a text of ``size`` words, with their length: a k-gram of
    a long window may stand at any of its places, a short window is its k-gram."""
    first, last = f"greatest(0, {at} - {WINDOW - GRAM})", f"least({at}, {size} - {WINDOW})"
    long = f"""CASE WHEN {first} <= {last} THEN transform(sequence({first}, {last}),
        s -> named_struct('start', s, 'length', {WINDOW})) ELSE array() END"""
    brief = [f"IF({at} + {n} <= {size}, array(named_struct('start', {at}, 'length', {n})), array())" for n in lengths]
    return f"concat({', '.join([long, *brief])})"


def hits(docs: DataFrame, benchmark: DataFrame, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, n_words, start, stop, set_id): every place of a row where a window of the benchmark stands, as word
    places from 0, stop excluded, and one row without place per row besides; and (set_id, items), the items
    of the windows.  ``row`` is a key of the rows of ``docs``, if they have one."""
    scratch = Scratch(docs.sparkSession, "winnow")
    hashes, windows, sets, short = _benchmark(benchmark, scratch)
    rows = docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    local = hashes.count() <= MAX_BROADCAST_ROWS
    marked = fingerprints(rows, short).select(
        "row", "doc_id", F.size("words").alias("n_words"), "words",
        F.explode_outer(F.concat("kept", F.array(F.lit(None).cast("long")))).alias("number"))
    at = _place("number")
    # a hit carries only the words that a window around it can hold: never the whole text once per hit
    before = f"greatest(0, {at} - {WINDOW - GRAM})"
    excerpt = F.expr(f"slice(words, {before} + 1, {2 * WINDOW - GRAM})").alias("words")
    if local:
        near = F.broadcast(hashes)
    else:
        near = hashes
        marked = marked.select("row", "doc_id", "n_words", "number", F.when(F.col("number").isNotNull(), excerpt).alias("words"))
    near = near.withColumn("known", F.lit(True))
    found = marked.join(near, F.expr("shiftright(number, 31) = hash"), "left").where("number IS NULL OR known").select(
        "row", "doc_id", "n_words", F.when(F.col("number").isNotNull(), excerpt if local else F.col("words")).alias("words"),
        F.expr(before).alias("before"), F.expr(at).alias("at"), F.col("number").isNotNull().alias("hit"))
    places = found.select("row", "doc_id", "n_words", F.explode_outer(F.expr(
        f"""CASE WHEN hit THEN transform({_around('at', 'n_words', short)},
            p -> named_struct('start', p.start, 'gram', slice(words, p.start - before + 1, p.length))) END""")).alias("p"))
    # the same window is reached from up to six kept hashes; which of its places counts once is settled by the caller
    matched = (places.join(windows, F.col("p.gram") == F.col("gram"), "left").where("p IS NULL OR set_id IS NOT NULL")
               .select("row", "doc_id", "n_words", F.col("p.start").alias("start"), (F.col("p.start") + F.size("gram")).alias("stop"),
                       "set_id"))
    return matched, sets


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of a window),
    n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits; repeated rows come back repeated, each
    with its own counts; items without words match nothing, equal item ids count once and a
    null item id is not listed; other columns are ignored; empty tables are fine."""
    scratch = Scratch(docs.sparkSession, "contamination")
    matched, sets = hits(docs, benchmark)
    covered = F.expr("""aggregate(array_sort(places), named_struct('n', 0L, 'stop', 0),
        (a, x) -> named_struct('n', a.n + greatest(0, x.stop - greatest(a.stop, x.start)),
                               'stop', greatest(a.stop, x.stop)), a -> a.n)""")
    per_row = scratch.keep(
        matched.groupBy("row", "doc_id")
        .agg(F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_set("set_id")).alias("set_ids"),
             F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "stop"))).alias("places"))
        .select("doc_id", "n_words", covered.alias("n_hit"),
                F.when(F.size("set_ids") > 0, F.array_join("set_ids", ",")).alias("held"), "set_ids"), "rows")
    # documents that hold the same sets share one union of items
    held = per_row.where("held IS NOT NULL").select("held", "set_ids").distinct()
    listed = (held.select("held", F.explode("set_ids").alias("set_id")).join(sets, "set_id")
              .select("held", F.explode_outer("items").alias("item")).groupBy("held")
              .agg(F.array_sort(F.collect_set("item")).alias("items"))
              .select("held", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("digest")))
    return (per_row.join(listed, "held", "left")
            .select("doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) without a benchmark window, each
    judged by its own text and not by others with its doc_id, rows without doc_id too."""
    rows, key = numbered(docs, Scratch(docs.sparkSession, "keep-clean"))
    matched, _ = hits(rows, benchmark, F.col(key))
    dirty = matched.where("start IS NOT NULL").select(F.col("row").alias(key)).distinct()
    return rows.join(dirty, key, "left_anti").select(*docs.columns)


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, len(w) AS n, least(len(w), {WINDOW}) AS win
      FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, win, list_slice(w, i, i + win - 1) AS g
       FROM (SELECT *, unnest(range(1, n - win + 2)) AS i FROM b)),
dw AS (SELECT doc_id, i, win, list_slice(w, i, i + win - 1) AS g
       FROM (SELECT doc_id, w, win, unnest(range(1, len(w) - win + 2)) AS i
             FROM d, (SELECT DISTINCT win FROM b) WHERE len(w) >= win)),
hit AS (SELECT DISTINCT doc_id, i, dw.win, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.g = bw.g),
place AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + win)) AS p FROM hit) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN place USING (doc_id) LEFT JOIN item USING (doc_id)"""

"""Quotation linking: reply-ordered conversations without quoted text.

DataFrame functions only.  A line's quote level is the number of its leading ``>`` marks; a
run of lines of one level is a passage.  Passages and the messages' own text are cut into
normalised sentences (letters and digits, lower case), so re-wrapped quotes still match, and
each sentence is hashed.  A quoted sentence is joined to the latest earlier message of the
conversation with that sentence among its own; the message named by most sentences of a
passage (at least half, ties to the later) is its original.  A message replies to the original
of its outermost linked passage, else to the message before it.

No step gathers a conversation: "latest earlier" is found in blocks of ``BLOCK`` turns and
across blocks, and roots and depths by pointer doubling on (conversation, turn).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

BLOCK = 1024
MARKS = r"^((?:[ \t]*>)+)"
ATTRIBUTION = r"(?:wrote|writes|schrieb|a écrit|escribió)[ \t]*:[ \t]*$"
OUTSIDE = r"[^\p{L}\p{N}]+"
MESSAGE = ["conv_id", "turn", "message"]  # a message's place and its own number


def _lines(text: Column) -> Column:
    """Lines as (level, content)."""
    return F.transform(
        F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r", ""), "\n"),
        lambda line: F.struct(
            F.length(F.translate(F.regexp_extract(line, MARKS, 1), " \t", "")).alias("level"),
            F.regexp_replace(line, MARKS, "").alias("content")))


def _own() -> Column:
    """Unquoted lines, without lines that only announce the quote below them."""
    return F.btrim(F.expr(rf"""
        array_join(transform(filter(lines, (x, i) -> x.level = 0 AND NOT
            (x.content RLIKE '{ATTRIBUTION}' AND coalesce(get(lines, i + 1).level, 0) > 0)),
            x -> x.content), '\n')"""), F.lit(" \t\n"))


def _sentences(text: Column) -> Column:
    """Distinct hashes of the normalised sentences of a text."""
    normal = F.transform(F.split(F.lower(text), r"[.!?]+"),
                         lambda s: F.trim(F.regexp_replace(s, OUTSIDE, " ")))
    return F.array_distinct(F.transform(F.filter(normal, lambda s: s != ""), lambda s: F.xxhash64(s)))


def latest_before(rows: DataFrame, keys: list[str], source: str, name: str) -> DataFrame:
    """Adds ``name``: the largest ``turn`` below the row's among rows with equal keys where
    ``source`` holds.  Ordered work is limited to ``BLOCK`` turns at a time."""
    rows = rows.withColumn("_block", F.floor(F.col("turn") / BLOCK))
    mine = F.when(F.col(source), F.col("turn"))
    inside = (Window.partitionBy(*keys, "_block").orderBy("turn")
              .rangeBetween(Window.unboundedPreceding, -1))
    blocks = rows.groupBy(*keys, "_block").agg(F.max(mine).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "_block", F.max("_last").over(earlier).alias("_before"))
    return (rows.withColumn("_near", F.max(mine).over(inside)).join(blocks, [*keys, "_block"])
            .withColumn(name, F.coalesce("_near", "_before")).drop("_block", "_near", "_before"))


def _links(messages: DataFrame) -> DataFrame:
    """(message, n_passages, n_linked, original) of messages with quoted passages."""
    lines = (messages.where(F.exists("lines", lambda x: x["level"] > 0))
             .select(*MESSAGE, F.posexplode("lines").alias("at", "line"))
             .select(*MESSAGE, "at", "line.level", "line.content"))
    order = Window.partitionBy(*MESSAGE).orderBy("at")
    new_run = (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int")
    passages = (lines.withColumn("_new", new_run)
                .withColumn("passage", F.sum("_new").over(order)).where("level > 0")
                .groupBy(*MESSAGE, "passage", "level")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "content"))),
                                              lambda x: x["content"]), " ").alias("quoted"))
                .select(*MESSAGE, "passage", "level", _sentences(F.col("quoted")).alias("units")))
    asked = passages.select(*MESSAGE, "passage", "level", F.size("units").alias("n_units"),
                            F.explode("units").alias("unit"), F.lit(False).alias("is_own"))
    own = (messages.select(*MESSAGE, F.explode(_sentences(F.col("own"))).alias("unit"))
           .select(*MESSAGE, F.lit(None).cast("long").alias("passage"), F.lit(None).cast("int").alias("level"),
                   F.lit(None).cast("int").alias("n_units"), "unit", F.lit(True).alias("is_own")))
    found = (latest_before(asked.unionByName(own), ["conv_id", "unit"], "is_own", "origin")
             .where("NOT is_own AND origin IS NOT NULL")
             .groupBy(*MESSAGE, "passage", "level", "n_units", "origin").agg(F.count("*").alias("n"))
             .groupBy(*MESSAGE, "passage", "level", "n_units")
             .agg(F.max(F.struct("n", "origin")).alias("best"))
             .where("2 * best.n >= n_units"))
    linked = (found.groupBy("message")
              .agg(F.count("*").alias("n_linked"),
                   F.max(F.struct((-F.col("level")).alias("outer"), F.col("best.n"), F.col("best.origin")))
                   .alias("best"))
              .select("message", "n_linked", F.col("best.origin").alias("original")))
    return (passages.groupBy("message").agg(F.count("*").alias("n_passages"))
            .join(linked, "message", "left"))


def _threads(replies: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, root, depth) from (conv_id, turn, parent), in log2(depth) rounds."""
    state = scratch.keep(replies.select("conv_id", "turn", "parent",
                                        F.when(F.col("parent").isNull(), F.col("turn")).alias("root"),
                                        F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth")), "threads-0")
    turn = 0
    while state.where("root IS NULL").limit(1).count():
        turn += 1
        above = state.select("conv_id", F.col("turn").alias("parent"), F.col("parent").alias("_next"),
                             F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        pending = state.where("root IS NULL")  # only messages whose root is still open are joined
        moved = pending.drop("root").join(above, ["conv_id", "parent"], "left").select(
            "conv_id", "turn", F.when(F.col("_root").isNull(), F.col("_next")).alias("parent"),
            F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"))
        state = scratch.keep(state.where("root IS NOT NULL").unionByName(moved), f"threads-{turn}")
        scratch.drop(f"threads-{turn - 1}")
    return state.select("conv_id", "turn", "root", "depth")


def link(conversations: DataFrame) -> DataFrame:
    """Messages without their quotes and with their place in the thread:
    conv_id, turn, role, text, parent, root, depth, n_passages, n_linked.

    Sorting by (conv_id, root, depth, turn) gives reply order: every message after the one it
    answers.  A null or empty text has no lines to quote and keeps an empty text.  Rows that
    share conv_id and turn are messages of their own, with their own quotes and parent; what
    answers that turn stands in the thread of its first message by role and text (nulls first).  Rows
    without conv_id or turn come back as they are, without quotes and without a
    thread.  Other columns are ignored; an empty table gives no rows."""
    scratch = Scratch(conversations.sparkSession, "quotes")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    keyed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    split = lambda frame: frame.withColumn("lines", _lines(F.col("text"))).withColumn("own", _own())
    numbered = scratch.keep(rows.where(keyed).withColumn("message", F.monotonically_increasing_id()), "rows")
    heads = numbered.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text", "message")).alias("m"))
    messages = scratch.keep(split(numbered).drop("text"), "messages")
    before = latest_before(messages.select(*MESSAGE, F.lit(True).alias("is_own")), ["conv_id"],
                           "is_own", "previous").drop("is_own")
    replies = scratch.keep(
        before.join(_links(messages), "message", "left")
        .join(heads.select(F.col("m.message").alias("message"), F.lit(True).alias("head")), "message", "left")
        .select(*MESSAGE, F.coalesce("original", "previous").alias("parent"), F.col("head").isNotNull().alias("head"),
                F.coalesce("n_passages", F.lit(0).cast("long")).alias("n_passages"),
                F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked")), "replies")
    turns = _threads(replies.where("head").select("conv_id", "turn", "parent"), scratch)
    above = turns.select("conv_id", F.col("turn").alias("parent"), "root", F.col("depth").alias("_depth"))
    threads = replies.drop("head").join(above, ["conv_id", "parent"], "left").select(
        "message", "parent", F.coalesce("root", "turn").alias("root"), F.coalesce(F.col("_depth") + 1, F.lit(0)).alias("depth"),
        "n_passages", "n_linked")
    placed = messages.select(*MESSAGE, "role", F.col("own").alias("text")).join(threads, "message")
    loose = split(rows.where(~keyed)).select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.lit(None).cast("long").alias("parent"),
        F.lit(None).cast("long").alias("root"), F.lit(0).alias("depth"),
        F.lit(0).cast("long").alias("n_passages"), F.lit(0).cast("long").alias("n_linked"))
    return (placed.select(loose.columns).unionByName(loose))


def reply_ordered(linked: DataFrame) -> DataFrame:
    """The messages range-partitioned and sorted in reply order; a long conversation spans
    several partitions."""
    order = ["conv_id", "root", "depth", "turn"]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(link(table(spark, sf_dir, "conversations")))


OP1_SQL = rf"""
WITH RECURSIVE msg AS (
  SELECT row_number() OVER () AS message, conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) = 1 AS head
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
line AS (
  SELECT conv_id, turn, message, i, regexp_extract(ln, '{MARKS}', 1) AS mark, regexp_replace(ln, '{MARKS}', '') AS content
  FROM (SELECT conv_id, turn, message, unnest(ls) AS ln, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT conv_id, turn, message, string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)) AS ls FROM msg))),
lvl AS (SELECT *, length(translate(mark, ' ' || chr(9), '')) AS level FROM line),
nxt AS (SELECT *, lead(level, 1, 0) OVER w AS below, lag(level, 1, -1) OVER w AS above FROM lvl
        WINDOW w AS (PARTITION BY conv_id, turn, message ORDER BY i)),
own AS (SELECT conv_id, turn, message, trim(coalesce(string_agg(content, chr(10) ORDER BY i)
          FILTER (level = 0 AND NOT (regexp_matches(content, '{ATTRIBUTION}') AND below > 0)), ''), ' ' || chr(9) || chr(10)) AS text
        FROM nxt GROUP BY conv_id, turn, message),
run AS (SELECT *, sum(CASE WHEN level <> above THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn, message ORDER BY i) AS passage FROM nxt),
psg AS (SELECT conv_id, turn, message, passage, level, string_agg(content, ' ' ORDER BY i) AS quoted FROM run WHERE level > 0
        GROUP BY conv_id, turn, message, passage, level),
ask AS (SELECT DISTINCT conv_id, turn, message, passage, level, unit FROM (
          SELECT conv_id, turn, message, passage, level,
                 trim(regexp_replace(unnest(regexp_split_to_array(lower(quoted), '[.!?]+')), '{OUTSIDE}', ' ', 'g')) AS unit FROM psg)
        WHERE unit <> ''),
src AS (SELECT DISTINCT conv_id, turn, unit FROM (
          SELECT conv_id, turn,
                 trim(regexp_replace(unnest(regexp_split_to_array(lower(text), '[.!?]+')), '{OUTSIDE}', ' ', 'g')) AS unit FROM own)
        WHERE unit <> ''),
near AS (SELECT a.conv_id, a.turn, a.message, a.passage, a.level, a.unit, max(s.turn) AS origin
         FROM ask a JOIN src s ON a.conv_id = s.conv_id AND a.unit = s.unit AND s.turn < a.turn GROUP BY ALL),
vote AS (SELECT conv_id, turn, message, passage, level, origin, count(*) AS n FROM near GROUP BY ALL),
best AS (SELECT v.conv_id, v.turn, v.message, v.passage, level, max(row(n, origin)) AS b FROM vote v
         GROUP BY ALL),
size AS (SELECT conv_id, turn, message, passage, count(*) AS n_units FROM ask GROUP BY ALL),
okay AS (SELECT conv_id, turn, message, passage, level, b[1] AS n, b[2] AS origin FROM best JOIN size USING (conv_id, turn, message, passage)
         WHERE 2 * b[1] >= n_units),
lnk AS (SELECT message, count(*) AS n_linked, max(row(-level, n, origin))[3] AS original FROM okay GROUP BY ALL),
cnt AS (SELECT message, count(*) AS n_passages FROM psg GROUP BY ALL),
prv AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM (SELECT DISTINCT conv_id, turn FROM msg)),
rep AS (SELECT m.message, m.conv_id, m.turn, m.role, m.head, coalesce(original, previous) AS parent,
               coalesce(n_passages, 0) AS n_passages, coalesce(n_linked, 0) AS n_linked
        FROM msg m JOIN prv USING (conv_id, turn) LEFT JOIN lnk USING (message) LEFT JOIN cnt USING (message)),
thr AS (SELECT conv_id, turn, turn AS root, 0 AS depth FROM rep WHERE head AND parent IS NULL
        UNION ALL SELECT r.conv_id, r.turn, t.root, t.depth + 1 FROM rep r JOIN thr t ON r.conv_id = t.conv_id AND r.parent = t.turn WHERE r.head)
SELECT rep.conv_id, rep.turn, role, own.text AS text, parent, coalesce(thr.root, rep.turn) AS root,
       CAST(coalesce(thr.depth + 1, 0) AS INTEGER) AS depth, CAST(n_passages AS BIGINT) AS n_passages, CAST(n_linked AS BIGINT) AS n_linked
FROM rep JOIN own USING (message) LEFT JOIN thr ON thr.conv_id = rep.conv_id AND thr.turn = rep.parent"""

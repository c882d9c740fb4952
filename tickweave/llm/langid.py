"""Language identification by interpolated Kneser-Ney character models.

Texts become lower-case runs of letters and their combining marks with single spaces, in
UTF-16; the model predicts each 16-bit unit (a character, but for those beyond U+FFFF, which
are two) from the three before it, so four of them fill a 64-bit key and no two n-grams
share one.  Counts come from every training text.  The highest order uses
counts, the lower ones the number of different left neighbours; each order is interpolated
with the next lower one, down to a uniform distribution.  A model is, per order, a sorted
array of packed n-grams with one probability per language, and a sorted array of contexts
with one back-off weight per language.  Where those could hold more than ``MAX_CELLS``
probabilities, the counts of every order stay written tables instead, and the texts' distinct
4-grams are joined with them: the same probabilities, and no count is left out.

The language with the lowest cross-entropy per character wins.  Its confidence is a softmax
over the entropies whose scale, and the confidence below which a text is rejected, are
calibrated on every training row: losses are summed in the tasks, the threshold is an exact
distributed quantile.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import quantiles
from .common import Scratch, held_out, table, text_blocks

ORDER = 4
CHAR_BITS = 16  # of a UTF-16 unit
MAX_CELLS = 16_000_000  # probabilities of one order (n-grams x languages) a model may hold in memory
SCALES = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0)  # of the softmax, of which the calibration chooses one
LOST = 0.001  # share of right answers that calibrated rejection may cost
UNKNOWN = "und"

_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")  # numerals like Roman or raised ones are no letters


def lower_keys(n: int) -> int:
    """The bits of an n-gram key of a lower order."""
    return (1 << CHAR_BITS * n) - 1


def char_keys(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of the texts' letters: positions in ``texts`` and keys.  A text without
    letters has none."""
    words = [_WORDS.findall((t or "").lower()) for t in texts]
    parts = [f"   {' '.join(w)} ".encode("utf-16-le") if w else b"" for w in words]
    chars = np.frombuffer(b"".join(parts), "<u2").astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(p) // 2 for p in parts])
    if len(chars) < ORDER:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    last = len(chars) - ORDER + 1
    keys = np.zeros(last, np.int64)
    for k in range(ORDER):
        keys = (keys << CHAR_BITS) | chars[k:k + last]
    inside = owner[:last] == owner[ORDER - 1:]
    return owner[:last][inside], keys[inside]


def _count_task(batches):
    """(lang, key, n): counts are summed in the task before they leave it."""
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for part, texts in text_blocks(batches):
        langs = part.column(1).to_pylist()
        names = sorted(set(langs))
        number = np.array([names.index(x) for x in langs])
        owner, keys = char_keys(texts)
        for k, name in enumerate(names):
            new, n = np.unique(keys[number[owner] == k], return_counts=True)
            if name in found:
                new, at = np.unique(np.concatenate([found[name][0], new]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([found[name][1], n])).astype(np.int64)
            found[name] = new, n
    for name, (keys, n) in found.items():
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys)), pa.array(keys), pa.array(n)], names=["lang", "key", "n"])


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


@dataclass
class Model:
    langs: list[str]
    grams: dict = field(default_factory=dict)  # order: sorted keys
    probability: dict = field(default_factory=dict)  # order: keys x languages
    contexts: dict = field(default_factory=dict)  # order: sorted contexts
    backoff: dict = field(default_factory=dict)  # order: contexts x languages
    floor: float = 1.0  # uniform probability of a character
    scale: float = 20.0
    reject_below: float = 0.0
    tables: "Tables | None" = None  # the written counts of a model too large for memory

    def add_order(self, n: int, keys: np.ndarray, counts: np.ndarray, discount: np.ndarray):
        """Interpolated probabilities of the n-grams of an order, counts x languages."""
        contexts, at = np.unique(keys >> CHAR_BITS, return_inverse=True)
        total = np.zeros((len(contexts), len(self.langs)))
        kinds = np.zeros_like(total)
        np.add.at(total, at, counts)
        np.add.at(kinds, at, counts > 0)
        seen = total > 0
        backoff = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
        own = np.maximum(counts - discount, 0) / np.where(seen, total, 1)[at]
        lower = self.chance(n - 1, keys & lower_keys(n - 1))
        self.grams[n], self.contexts[n] = keys, contexts
        self.probability[n] = (own + backoff[at] * lower).astype(np.float32)
        self.backoff[n] = backoff.astype(np.float32)

    def chance(self, n: int, keys: np.ndarray) -> np.ndarray:
        """Probability of each n-gram's last character after the others, by language."""
        if n == 0:
            return np.full((len(keys), len(self.langs)), self.floor, np.float32)
        at, hit = _find(self.grams[n], keys)
        if hit.all():
            return self.probability[n][at]
        out = np.empty((len(keys), len(self.langs)), np.float32)
        out[hit] = self.probability[n][at[hit]]
        rest = keys[~hit]
        where, known = _find(self.contexts[n], rest >> CHAR_BITS)
        weight = np.ones((len(rest), len(self.langs)), np.float32)
        weight[known] = self.backoff[n][where[known]]
        out[~hit] = weight * self.chance(n - 1, rest & lower_keys(n - 1))
        return out

    def entropies(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character by language, and the number of characters."""
        owner, keys = char_keys(texts)
        n = np.bincount(owner, minlength=len(texts))
        bits = -np.log(self.chance(ORDER, keys))
        total = np.stack([np.bincount(owner, weights=bits[:, k], minlength=len(texts))
                          for k in range(len(self.langs))], axis=1)
        return total / np.maximum(n, 1)[:, None], n

    def confidence(self, entropy: np.ndarray) -> np.ndarray:
        gap = entropy - entropy.min(axis=1, keepdims=True)
        return 1 / np.exp(-self.scale * gap).sum(axis=1)


def _discount(once, twice):
    return np.clip((once + 0.5) / (once + 2 * twice + 1), 0.1, 0.9)


class Tables:
    """Counts of every order as written tables, joined with the keys that are to be scored."""

    def __init__(self, counts: DataFrame, langs: list[str], scratch: Scratch):
        self.langs, self.scratch, self.turn = langs, scratch, 0
        number = F.create_map(*[F.lit(x) for k, name in enumerate(langs) for x in (name, k)])
        order = scratch.keep(counts.select(number[F.col("lang")].alias("lang"), "key",
                                           F.col("n").cast("double").alias("n")), f"order-{ORDER}")
        self.grams, self.contexts, self.discount = {}, {}, {}
        for n in range(ORDER, 0, -1):
            if n < ORDER:  # different left neighbours, from the order above
                order = scratch.keep(order.groupBy("lang", F.col("key").bitwiseAND(F.lit(lower_keys(n))).alias("key"))
                                     .agg(F.count("*").cast("double").alias("n")), f"order-{n}")
            rare = {(r["lang"], r["n"]): r["kinds"] for r in order.where("n <= 2").groupBy("lang", "n")
                    .agg(F.count("*").alias("kinds")).collect()}
            once, twice = (np.array([rare.get((k, x), 0) for k in range(len(langs))], float) for x in (1.0, 2.0))
            self.discount[n] = _discount(once, twice)
            entries = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
            self.grams[n] = scratch.keep(order.groupBy(F.col("key").alias(f"k{n}")).agg(entries.alias("counts")), f"grams-{n}")
            sums = F.map_from_entries(F.collect_list(F.struct("lang", F.struct("total", "kinds"))))
            self.contexts[n] = scratch.keep(
                order.groupBy("lang", F.shiftright("key", CHAR_BITS).alias(f"c{n}"))
                .agg(F.sum("n").alias("total"), F.count("*").cast("double").alias("kinds"))
                .groupBy(f"c{n}").agg(sums.alias("sums")), f"contexts-{n}")
        self.floor = 1.0 / (self.grams[1].count() + 1)

    def chances(self, keys: DataFrame) -> DataFrame:
        """(key, p): probability of each 4-gram's last character after the others, by language."""
        last = len(self.langs) - 1
        p = f"array_repeat(CAST({self.floor!r} AS DOUBLE), {last + 1})"
        found = keys.withColumn("p", F.expr(p))
        for n in range(1, ORDER + 1):
            grams, contexts = self.grams[n], self.contexts[n]
            if n == 1:  # one context, and one row per character
                grams, contexts = F.broadcast(grams), F.broadcast(contexts)
            d = "array(" + ", ".join(f"{x!r}D" for x in self.discount[n].tolist()) + ")"
            found = (found.withColumn(f"k{n}", F.col("key") if n == ORDER else F.col("key").bitwiseAND(F.lit(lower_keys(n))))
                     .withColumn(f"c{n}", F.shiftright(f"k{n}", CHAR_BITS))
                     .join(grams, f"k{n}", "left").join(contexts, f"c{n}", "left")
                     .select("key", F.expr(f"""transform(sequence(0, {last}), i -> CASE
                         WHEN try_element_at(sums, i) IS NULL THEN p[i]
                         ELSE (greatest(coalesce(try_element_at(counts, i), 0D) - {d}[i], 0D)
                               + {d}[i] * try_element_at(sums, i).kinds * p[i]) / try_element_at(sums, i).total
                         END)""").alias("p")))
        return found

    def entropies(self, rows: DataFrame) -> DataFrame:
        """The rows of ``rows(tag, text)`` as (tag, n, entropy): characters and cross-entropy by
        language, zeros without letters."""
        self.turn += 1

        def run(batches):
            for part, texts in text_blocks(batches):
                owner, keys = char_keys(texts)
                ids = part.column(2).to_numpy()
                at = np.lexsort((keys, owner))
                owner, keys = owner[at], keys[at]
                start = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(keys, prepend=-1) != 0))
                n = np.diff(np.append(start, len(keys)))
                none = np.arange(len(texts))  # one row without key, for texts without letters
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.concatenate([none, owner[start]]))),
                     pa.array(ids[np.concatenate([none, owner[start]])]),
                     pa.concat_arrays([pa.nulls(len(none), pa.int64()), pa.array(keys[start], pa.int64())]),
                     pa.array(np.concatenate([0 * none, n]))], names=["tag", "row", "key", "n"])
        tag = dict(rows.dtypes)["tag"]
        grams = self.scratch.keep(rows.select("tag", "text", F.monotonically_increasing_id().alias("row"))
                                  .mapInArrow(run, f"tag {tag}, row long, key long, n long"), f"texts-{self.turn}")
        chances = self.scratch.keep(self.chances(grams.where("key IS NOT NULL").select("key").distinct()),
                                    f"chances-{self.turn}")
        sums = [F.sum(-F.log(F.col("p")[k]) * F.col("n")).alias(f"s{k}") for k in range(len(self.langs))]
        found = (grams.where("key IS NOT NULL").join(chances, "key").groupBy("row")
                 .agg(F.sum("n").alias("chars"), *sums)
                 .select("row", "chars", F.array(*[F.col(f"s{k}") / F.col("chars") for k in range(len(self.langs))])
                         .alias("entropy")))
        return (grams.where("key IS NULL").select("tag", "row").join(found, "row", "left")
                .select("tag", F.coalesce("chars", F.lit(0).cast("long")).alias("n"),
                        F.coalesce("entropy", F.array_repeat(F.lit(0.0), len(self.langs))).alias("entropy")))


def build(counts: DataFrame, langs: list[str], scratch: Scratch | None = None) -> Model:
    """The model of all counted 4-grams ``counts(lang, key, n)``: in memory, or written tables
    where an order could hold more than ``MAX_CELLS`` probabilities."""
    model = Model(langs)
    sizes = (counts.groupBy("lang", F.least("n", F.lit(3)).alias("n"))
             .agg(F.count("*").alias("kinds")).toPandas())
    if sizes["kinds"].sum() > MAX_CELLS // max(1, len(langs)):
        model.tables = Tables(counts, langs, scratch or Scratch(counts.sparkSession, "langid"))
        model.floor = model.tables.floor
        return model
    rows = counts.toPandas()
    number = {x: k for k, x in enumerate(langs)}
    keys, at = np.unique(rows["key"].to_numpy(np.int64), return_inverse=True)
    table_ = np.zeros((len(keys), len(langs)))
    table_[at, rows["lang"].map(number).to_numpy(int)] = rows["n"]
    orders = {ORDER: (keys, table_)}
    for n in range(ORDER - 1, 0, -1):  # different left neighbours, from the order above
        above, kinds = orders[n + 1]
        keys, at = np.unique(above & lower_keys(n), return_inverse=True)
        table_ = np.zeros((len(keys), len(langs)))
        np.add.at(table_, at, kinds > 0)
        orders[n] = keys, table_
    model.floor = 1.0 / (len(orders[1][0]) + 1)
    for n in range(1, ORDER + 1):
        keys, table_ = orders[n]
        if n == ORDER:
            once = [sizes.loc[(sizes["lang"] == x) & (sizes["n"] == k), "kinds"].sum()
                    for k in (1, 2) for x in langs]
            once, twice = np.array(once, float).reshape(2, -1)
        else:
            once, twice = (table_ == 1).sum(axis=0), (table_ == 2).sum(axis=0)
        model.add_order(n, keys, table_, _discount(once, twice))
    return model


def measure(rows: DataFrame, model: Model) -> DataFrame:
    """The rows of ``rows(tag, text)`` as (tag, n, entropy): characters and cross-entropy by
    language, zeros without letters."""
    if model.tables:
        return model.tables.entropies(rows)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, texts in text_blocks(batches):
            entropy, n = shared.value.entropies(texts)
            ends = np.arange(len(texts) + 1, dtype=np.int32) * entropy.shape[1]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, entropy.ravel())],
                names=["tag", "n", "entropy"])
    return rows.select("tag", "text").mapInArrow(run, f"tag {dict(rows.dtypes)['tag']}, n long, entropy array<double>")


def _by_language(entropy: pa.ListArray) -> np.ndarray:
    return entropy.flatten().to_numpy().reshape(len(entropy), -1)


def calibrate(model: Model, known: DataFrame) -> None:
    """From all rows of ``known(lang, entropy)``, read twice, set the softmax scale with the least
    log loss and the rejection threshold that loses a share ``LOST`` of the right answers."""
    number = {x: k for k, x in enumerate(model.langs)}

    def judged(batches):
        for batch in batches:
            if batch.num_rows:
                yield _by_language(batch.column(1)), np.array([number[x] for x in batch.column(0).to_pylist()])

    def losses(batches):
        for entropy, truth in judged(batches):
            gap = entropy - entropy.min(axis=1, keepdims=True)
            own = gap[np.arange(len(truth)), truth]
            loss = [float((x * own + np.log(np.exp(-x * gap).sum(axis=1))).sum()) for x in SCALES]
            yield pa.RecordBatch.from_arrays([pa.array([loss], pa.list_(pa.float64()))], names=["loss"])
    known = known.select("lang", "entropy")
    total = known.mapInArrow(losses, "loss array<double>").agg(
        *[F.sum(F.col("loss")[k]) for k in range(len(SCALES))]).first()
    if total[0] is None:
        return
    model.scale = SCALES[total.index(min(total))]
    light = Model(model.langs, scale=model.scale)

    def right(batches):
        for entropy, truth in judged(batches):
            entropy = entropy[entropy.argmin(axis=1) == truth]
            yield pa.RecordBatch.from_arrays([pa.array(light.confidence(entropy))], names=["confidence"])
    low = quantiles(known.mapInArrow(right, "confidence double"), "confidence", [LOST], ["low"]).first()["low"]
    if low is not None:
        model.reject_below = low


def _learnt() -> Column:
    """Whether a row may be learnt from: outside the held-out fold, neither lang nor text null."""
    return ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()


def learn(docs: DataFrame, scratch: Scratch) -> Model | None:
    """The model of all training rows, not calibrated yet; None if no such row has letters."""
    rows = docs.where(_learnt()).select(F.col("text").cast("string").alias("text"),
                                        F.col("lang").cast("string").alias("lang"))
    counts = scratch.keep(rows.mapInArrow(_count_task, "lang string, key long, n long")
                          .groupBy("lang", "key").agg(F.sum("n").alias("n")), "counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    model = build(counts, langs, scratch) if langs else None
    scratch.drop("counts")
    return model


def fit(docs: DataFrame, scratch: Scratch) -> Model | None:
    """Learn from text and lang of rows outside the held-out fold with neither of them null;
    None if no such row has letters."""
    model = learn(docs, scratch)
    if model is None:
        return None
    rows = docs.where(_learnt()).select(F.col("lang").cast("string").alias("tag"),
                                        F.col("text").cast("string").alias("text"))
    known = scratch.keep(measure(rows, model).where("n > 0").withColumnRenamed("tag", "lang"), "known")
    calibrate(model, known)
    scratch.drop("known")
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row.

    ``und`` with score 0, rejected, where a text is null or has no letters (or nothing was
    learned).  Other rows name a learned language even if rejected, so that a caller may
    decide.  Repeated rows come back repeated; an empty table gives no rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("tag"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select(F.col("tag").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    return judge(measure(rows, model).withColumnRenamed("tag", "doc_id"), model)


def judge(measured: DataFrame, model: Model) -> DataFrame:
    """The rows that ``identify`` returns, from ``measured(doc_id, n, entropy)``."""
    light = Model(model.langs, scale=model.scale, reject_below=model.reject_below)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                n, entropy = batch.column(1).to_numpy(), _by_language(batch.column(2))
                lang = np.where(n > 0, np.array(light.langs, object)[entropy.argmin(axis=1)], UNKNOWN)
                score = np.where(n > 0, light.confidence(entropy), 0.0)
                low = (score < light.reject_below) | (lang == UNKNOWN)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(low)],
                    names=["doc_id", "lang_pred", "score", "rejected"])
    return (measured.select("doc_id", "n", "entropy")
            .mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean"))


def fit_identify(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``identify`` of the rows that ``fit`` learns from and of the others: every text is scored
    once, for the calibration and for its prediction."""
    model = learn(docs, scratch)
    if model is None:
        return identify(docs, None)
    tag = F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                   F.when(_learnt(), F.col("lang").cast("string")).alias("lang"))
    rows = docs.select(tag.alias("tag"), F.col("text").cast("string").alias("text"))
    measured = scratch.keep(measure(rows, model).select("tag.doc_id", "tag.lang", "n", "entropy"), "entropies")
    calibrate(model, measured.where("lang IS NOT NULL AND n > 0"))
    return judge(measured, model)


def op9_kneser_ney_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fit_identify(docs, Scratch(spark, "langid")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")

"""Toxicity by class-conditional Kneser-Ney word models.

Two models, one learned from toxic and one from ordinary texts.  As in Kneser-Ney's
lower orders, a word counts by the number of distinct words it follows, so a passage that
many documents repeat counts once.  A rare expression's probability falls back from its
class's counts to the counts that both classes share:

    P_c(w) = (k_c(w) - D) / K_c + (held back by D) / K_c * P(w)
    P(w)   = (k(w) + 1) / (K + words + 1)

k counts distinct predecessors exactly, over all counted rows; K sums them; without a class
they are summed over both.  D is Kneser-Ney's own discount of a count of 1, of 2 and of 3 or
more, estimated from how many counts of all labelled rows are 1, 2, 3 and 4; it is less than
the count, so a word seen once keeps evidence.  A text's length-normalised
log-likelihoods are compared (toxic less ordinary, per word) over the whole text and over
its most telling expression of 1, 2 or 3 words; a logistic curve fitted on labelled rows
held back from the counts turns the comparison into a score.

Counts cover every labelled row handed in but the curve's.  They are a table with a row for
every word, by its 64-bit hash, so the model grows with the labelled vocabulary.  All words
that weren't counted are alike.  Up to HELD_WORDS words (counted first; 12 bytes each) are sent
to the tasks that score; of a larger vocabulary nothing is: the words of every distinct text are
joined to the table, salted for frequent words, and each text is scored from the rows it found.
Both ways give the same scores.

Defined results: null and empty texts are scored like a text that says nothing (the
curve at zero difference).  Without rows of both classes every score is 0.  Extra
columns and repeated rows pass through ``score`` (columns named whole, expression, score, predicted, _judged,
_text or _found are replaced), ``labelled`` keeps key and text alone; texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendfeat.llm import _text as T
from lendfeat.llm._store import settle
from lendfeat.operators.joins import salted_join

#: Discounts where the counts of counts give none.
FALLBACK = (0.5, 1.0, 1.5)
EXPRESSIONS = (1, 2, 3)
#: Words that are held by a task at most.
HELD_WORDS = 1 << 24
#: Fit bound: rows the logistic curve is fitted on, chosen by hash.
MAX_CURVE_ROWS = 20_000
_START = np.uint64(0x51ED270B27220AEB)
_NONE = (np.zeros(0, np.uint64), np.zeros(0, np.float32))


def _pairs(batches):
    """Per chunk and class: distinct pairs of neighbours (the class in the lowest bit), with the second word."""
    for batch in batches:
        for label in (0, 1):
            for _, data, ends in T.chunks(batch.filter(pc.equal(batch["label"], label))["text"]):
                h, _, _, end = T.words(data, ends)
                before = np.empty_like(h)
                before[1:] = h[:-1]
                first = T.begins(end)
                before[first[first < end]] = _START
                pair, at = np.unique(T.mix(before * np.uint64(0x9E3779B97F4A7C15) + h) >> np.uint64(1), return_index=True)
                pair = (pair << np.uint64(1)) | np.uint64(label)
                yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(h[at].view(np.int64))], ["pair", "word"])


@dataclass
class KneserNey:
    """words: hashes of the counted words, ascending; evidence[i]: log-likelihood of words[i], toxic less ordinary;
    unknown: that of any other word; curve: weights of the logistic curve; table: (word, evidence) where
they are too many to be held, then words and evidence are empty."""

    words: np.ndarray
    evidence: np.ndarray
    unknown: float
    curve: np.ndarray
    table: DataFrame | None = None

    def of(self, h: np.ndarray) -> np.ndarray:
        """Evidence of each word."""
        if not len(self.words):
            return np.full(len(h), self.unknown)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.evidence[at].astype(float), self.unknown)

    def differences(self, texts: pa.Array) -> np.ndarray:
        """Per text: mean difference over its words, and the largest sum over an expression."""
        out = np.zeros((len(texts), 2))
        for at, data, ends in T.chunks(texts):
            h, _, _, end = T.words(data, ends)
            d, words = self.of(h), np.diff(end, prepend=0)
            rows = slice(at, at + len(ends))
            out[rows, 0] = T.per_text(d, end) / np.maximum(1, words)
            out[rows, 1] = np.max([_best(d, end, words, n) for n in EXPRESSIONS], axis=0)
        return out

    def scores(self, differences: np.ndarray) -> np.ndarray:
        if not len(self.curve):
            return np.zeros(len(differences))
        return 1 / (1 + np.exp(-np.clip(_features(differences) @ self.curve, -30, 30)))


def _best(d: np.ndarray, end: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Largest sum over n successive words of each text, divided by the root of n (0 in a shorter text)."""
    best = np.zeros(len(end))
    sums = np.lib.stride_tricks.sliding_window_view(d, n).sum(1) if len(d) >= n else d[:0]
    text_of = np.repeat(np.arange(len(end)), words)[: len(sums)]
    kept = np.flatnonzero(np.arange(len(sums)) + n <= end[text_of])
    if len(kept):
        starts = np.flatnonzero(np.diff(text_of[kept], prepend=-1))
        best[text_of[kept][starts]] = np.maximum.reduceat(sums[kept], starts) / n**0.5
    return best


def _features(differences: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(differences)), np.clip(differences * [10, 1], -10, 10)])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Newton's method on a bounded sample."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
    return b


#: Slots of the filter that keeps unlabelled texts out of the join; its size is fixed.
FILTER_SLOTS = 1 << 20


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text of docs with the columns of labels.  Only texts whose key falls in a labelled slot are shuffled."""
    docs = docs.select(key, text)
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_SLOTS)).cast("int").alias("_slot")
    wanted = labels.select(slot).distinct()  # at most FILTER_SLOTS rows
    likely = docs.withColumn("_slot", slot).join(F.broadcast(wanted), "_slot", "left_semi").drop("_slot")
    return likely.join(labels.hint("merge"), key)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Kneser-Ney's discounts of counts 1, 2 and 3 or more (Chen and Goodman), n: how many counts are 1 to 4."""
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        d = tuple(c - (c + 1) * y * n[c] / n[c - 1] for c in (1, 2, 3))
        if all(0 < x < c for c, x in zip((1, 2, 3), d)):
            return d
    return FALLBACK


def _kept(k: Column, d: tuple[float, float, float]) -> Column:
    return F.when(k >= 3, k - d[2]).when(k == 2, 2 - d[1]).when(k == 1, 1 - d[0]).otherwise(0.0)


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic") -> KneserNey:
    """Counts from nine tenths of the rows (by hash of the text), curve from the rest.

    ``labelled`` is read twice, once for either part."""
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where("text is not null and label in (0, 1)")
    part = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(10))
    pairs = rows.where(part != 0).mapInArrow(_pairs, "pair long, word long").distinct()
    by_label = [F.count_if(F.col("pair").bitwiseAND(1) == c).alias(f"k{c}") for c in (0, 1)]
    counts = settle(pairs.groupBy("word").agg(*by_label), "toxicity-counts")
    of_count = [F.count_if(F.col(f"k{c}") == n).alias(f"n{c}{n}") for c in (0, 1) for n in (1, 2, 3, 4)]
    sums = counts.agg(F.sum("k0").alias("k0"), F.sum("k1").alias("k1"), F.count("*").alias("n"), *of_count).first()
    if not sums["k0"] or not sums["k1"]:
        return KneserNey(np.zeros(0, np.uint64), np.zeros(0, np.float32), 0.0, np.zeros(0))
    d = discounts([sums[f"n0{n}"] + sums[f"n1{n}"] for n in (1, 2, 3, 4)])
    kept = [_kept(F.col(f"k{c}"), d) / sums[f"k{c}"] for c in (0, 1)]
    held_back = [1 - x for x in counts.agg(*[F.sum(k) for k in kept]).first()]
    shared = (F.col("k0") + F.col("k1") + 1) / (sums["k0"] + sums["k1"] + sums["n"] + 1)
    ordinary, toxic = (kept[c] + held_back[c] * shared for c in (0, 1))
    known = counts.select("word", F.log(toxic / ordinary).cast("float").alias("evidence"))
    model = KneserNey(np.zeros(0, np.uint64), np.zeros(0, np.float32), float(np.log(held_back[1] / held_back[0])), np.zeros(0))
    if sums["n"] > HELD_WORDS:
        model.table = settle(known, "toxicity-evidence")
    else:
        model.words, model.evidence = _ascending(known.toArrow())

    curve = settle(rows.where(part == 0), "toxicity-curve")
    rate = min(1.0, MAX_CURVE_ROWS / max(1, curve.count()))
    sample = compare(curve.where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1_000_003)) < rate * 1_000_003), model).select("label", "whole", "expression").toArrow()
    x, y = np.column_stack([sample["whole"].to_numpy(), sample["expression"].to_numpy()]), sample["label"].to_numpy().astype(float)
    # with one class only, no curve can be fitted: an expression e^2 times likelier in toxic texts is even odds
    model.curve = _logistic(_features(x), y) if len(y) and 0 < y.mean() < 1 else np.array([-2.0, 0.0, 1.0])
    return model


def _ascending(found: pa.Table | pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    column = found.field if isinstance(found, pa.StructArray) else found.column
    words, evidence = column("word").to_numpy().view(np.uint64), column("evidence").to_numpy()
    order = np.argsort(words)
    return words[order], evidence[order]


def _vocabulary(batches):
    """The distinct words of each text."""
    for batch in batches:
        for at, data, ends in T.chunks(batch["text"]):
            h, _, _, end = T.words(data, ends)
            text = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
            order = np.lexsort((h, text))
            h, text = h[order], text[order]
            first = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))[: len(h)]
            yield pa.RecordBatch.from_arrays([batch["_text"].take(pa.array(text[first] + at)), pa.array(h[first].view(np.int64))], ["_text", "word"])


def _looked_up(docs: DataFrame, model: KneserNey, text: str) -> DataFrame:
    """docs with _judged, from a join of each distinct text's words with the model's table."""
    unknown, curve = model.unknown, model.curve

    @F.arrow_udf("struct<whole double, expression double, score double>")
    def judge(texts: pa.Array, found: pa.Array) -> pa.Array:
        d = np.zeros((len(texts), 2))
        for i in range(len(texts)):  # a text's own rows are a small model
            own = found[i].values if found[i].is_valid else None
            words = _NONE if own is None else _ascending(own)
            d[i] = KneserNey(*words, unknown, curve).differences(texts.slice(i, 1))[0]
        p = KneserNey(*_NONE, unknown, curve).scores(d)
        return pa.StructArray.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(p)], ["whole", "expression", "score"])

    key = F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"), 256)
    each = docs.select(key.alias("_text"), F.col(text).alias("text")).where("text is not null").dropDuplicates(["_text"])
    each = settle(each, "toxicity-texts")
    words = settle(each.mapInArrow(_vocabulary, "_text string, word long"), "toxicity-vocabulary")
    rows = salted_join(words, model.table, "word", "inner").groupBy("_text").agg(F.collect_list(F.struct("word", "evidence")).alias("_found"))
    judged = each.join(rows, "_text", "left").select("_text", judge("text", "_found").alias("_judged"))
    silent = docs.sparkSession.range(1).select(F.lit("").alias("text"), F.lit(None).cast("array<struct<word: long, evidence: float>>").alias("_found"))
    # null texts, which may be many, are judged without the join
    nothing = silent.select(judge("text", "_found").alias("s")).first()["s"]
    alike = F.struct(*[F.lit(float(nothing[c])).alias(c) for c in ("whole", "expression", "score")])
    said = docs.where(F.col(text).isNotNull()).withColumn("_text", key).drop("_judged", "_found")
    said = said.join(settle(judged, "toxicity-judged"), "_text").drop("_text")
    return said.unionByName(docs.where(F.col(text).isNull()).drop("_text", "_found").withColumn("_judged", alike))


def _held(docs: DataFrame, model: KneserNey, text: str) -> DataFrame:
    """docs with _judged, from the words that every task holds."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<whole double, expression double, score double>")
    def judge(texts: pa.Array) -> pa.Array:
        d = held.value.differences(texts)
        return pa.StructArray.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(held.value.scores(d))], ["whole", "expression", "score"])

    return docs.withColumn("_judged", judge(F.col(text)))


def compare(docs: DataFrame, model: KneserNey, text: str = "text") -> DataFrame:
    """docs with whole, expression (see KneserNey.differences) and score (0 to 1)."""
    judged = (_held if model.table is None else _looked_up)(docs, model, text)
    return judged.withColumns({c: F.col(f"_judged.{c}") for c in ("whole", "expression", "score")}).drop("_judged")


def score(docs: DataFrame, model: KneserNey, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from 0.5 on)."""
    return compare(docs, model, text).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Language identification by language-bitmask n-gram filters.

A Bloom filter is sliced by language: every slot holds one bit per language, so the
AND over an n-gram's slots names *all* languages that contain it.  A text's bits are
counted per language, each count is corrected by that language's false-positive rate
(its fill to the power of the number of hashes), and the largest corrected count
decides.  N-grams are byte n-grams of lower-cased words with a blank at either end.

Defined results: null text or text without a letter gives ``und`` and score 0.  Letters
of which no n-gram is known give the most frequent learned language and score 0; ties go
to the more frequent language, then by name.  No labelled rows: every text is ``und``.
Extra columns, repeated rows and texts of any length pass through unchanged; columns named lang_pred,
score, margin or _judged are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendfeat.llm import _text as T

UNDETERMINED = "und"
ORDERS = (3, 5)
SLOT_BITS = 20
HASHES = 2
#: Fit bound: documents per language that the filter is built from, chosen by hash of the text.
MAX_DOCS = 3000
#: An n-gram belongs to a language if seen this often there and this often against its best language.
MIN_COUNT, MIN_SHARE = 2, 0.05
_SEPARATE = np.where(T.IS_LETTER, np.arange(256), 32).astype(np.uint8)


def _ngrams(data: np.ndarray):
    """For each order: start and hash of each n-gram whose inner bytes are all letters."""
    flat = np.full(len(data) + 1, 32, np.uint8)  # a blank before the first text too; others have the last text's end
    flat[1:] = _SEPARATE[data]
    blank = np.zeros(len(flat) + 1, np.int32)
    np.cumsum(flat == 32, dtype=np.int32, out=blank[1:])
    prefix = T.prefix_hash(flat)
    for n in ORDERS:
        start = np.flatnonzero(blank[n - 1 : len(flat)] == blank[1 : len(flat) - n + 2]) if len(flat) >= n else np.zeros(0, np.int64)
        yield start, T.range_hash(prefix, start, start + n)


def _slots(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(SLOT_BITS * k)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class LanguageFilter:
    """languages by falling frequency; masks[w, slot] has the bits of languages 64w to 64w+63."""

    languages: list[str]
    masks: np.ndarray
    false_positive: np.ndarray


def _count_ngrams(batches):
    for batch in batches:
        for key in batch["lang_no"].unique().to_pylist():
            of = batch.filter(pc.equal(batch["lang_no"], key))
            for _, data, _ in T.chunks(of["text"]):
                for _, grams in _ngrams(data):
                    h, c = np.unique(grams, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), key, np.int32)), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["lang_no", "gram", "n"])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = MAX_DOCS) -> LanguageFilter:
    """Filter learned from rows with text and language (about ``max_docs`` texts a language, whole)."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [r["lang"] for r in counted]
    width = max(1, -(-len(languages) // 64))
    masks = np.zeros((width, 1 << SLOT_BITS), np.uint64)
    if languages:
        spark = labelled.sparkSession
        rates = spark.createDataFrame([(r["lang"], i, min(1.0, max_docs / r["count"])) for i, r in enumerate(counted)], "lang string, lang_no int, rate double")
        sample = rows.join(F.broadcast(rates), "lang").where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.col("rate") * 1_000_003)
        grams = sample.select("lang_no", "text").mapInArrow(_count_ngrams, "lang_no int, gram long, n long").groupBy("lang_no", "gram").agg(F.sum("n").alias("n"))
        share = F.col("n") / F.col("rate_docs")
        sizes = spark.createDataFrame([(i, float(min(r["count"], max_docs))) for i, r in enumerate(counted)], "lang_no int, rate_docs double")
        kept = (
            grams.where(F.col("n") >= MIN_COUNT)
            .join(F.broadcast(sizes), "lang_no")
            .withColumn("share", share)
            .withColumn("most", F.max("share").over(Window.partitionBy("gram")))
            .where(F.col("share") >= MIN_SHARE * F.col("most"))
        )
        slot = F.explode(F.array(*[F.shiftrightunsigned("gram", SLOT_BITS * k).bitwiseAND((1 << SLOT_BITS) - 1) for k in range(HASHES)]))
        bits = (
            kept.select((F.col("lang_no") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, lang_no % 64)").alias("bit"), slot.alias("slot"))
            .groupBy("word", "slot")
            .agg(F.expr("bit_or(bit)").alias("bits"))
        )
        found = bits.toArrow()  # at most 2**SLOT_BITS rows for each 64 languages
        masks[found["word"].to_numpy(), found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    filled = np.array([((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    narrow = np.uint8 if len(languages) <= 8 else np.uint64  # eight languages fit a table that stays in cache
    return LanguageFilter(languages, masks.astype(narrow), filled**HASHES)


def _counts(texts: pa.Array, model: LanguageFilter) -> tuple[np.ndarray, np.ndarray]:
    """Corrected hits [text, language] and n-grams of each text."""
    hits, total = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    for at, data, ends in T.chunks(texts):
        rows = slice(at, at + len(ends))
        for start, h in _ngrams(data):
            ends_n, slots = np.searchsorted(start, ends), _slots(h)
            total[rows] += np.diff(ends_n, prepend=0)
            for w in range(len(model.masks)):
                mask = model.masks[w][slots[0]]
                for s in slots[1:]:
                    mask &= model.masks[w][s]
                for i in range(64 * w, min(64 * w + 64, len(model.languages))):
                    hits[rows, i] += T.per_text((mask & mask.dtype.type(1 << i % 64)) != 0, ends_n)
    fp = model.false_positive
    return np.maximum(0, hits - total[:, None] * fp) / np.maximum(1e-9, 1 - fp), total


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (share of n-grams that the language knows), margin (over the next language)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang int, score double, margin double>")
    def judge(texts: pa.Array) -> pa.Array:
        hits, total = _counts(texts, held.value)
        if not hits.shape[1]:
            best, score, margin = np.full(len(hits), -1), np.zeros(len(hits)), np.zeros(len(hits))
        else:
            best = hits.argmax(1)
            top = hits.max(1)
            second = np.sort(hits, 1)[:, -2] if hits.shape[1] > 1 else 0 * top
            score = np.minimum(1, top / np.maximum(1, total))
            margin = (top - second) / np.maximum(1e-9, top)
        return pa.StructArray.from_arrays([pa.array(best.astype(np.int32)), pa.array(score), pa.array(margin)], ["lang", "score", "margin"])

    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    names = F.array(*[F.lit(x) for x in model.languages]) if model.languages else F.array(F.lit(UNDETERMINED))
    known = lettered & (F.col("_judged.lang") >= 0)
    return (
        docs.withColumn("_judged", judge(F.col(text)))
        .withColumn("lang_pred", F.when(known, F.get(names, F.col("_judged.lang"))).otherwise(UNDETERMINED))
        .withColumn("score", F.when(known, F.col("_judged.score")).otherwise(0.0))
        .withColumn("margin", F.when(known, F.col("_judged.margin")).otherwise(0.0))
        .drop("_judged")
    )

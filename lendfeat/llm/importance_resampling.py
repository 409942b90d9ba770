"""Target-distribution importance resampling with hashed n-gram features.

A text's features are its words (runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased) and its pairs of consecutive words joined by a space; a feature's bucket is its CRC-32 modulo
``BUCKETS``.  A bucket's gain is the floored 1000-fold log ratio of its smoothed shares in the target and in
the corpus; a document's weight is the floored mean gain of its features, its score adds Gumbel noise from a
hash of its id, and of the documents with ``least`` words the given percentage with the highest scores is drawn.

Head-tail vocabulary: a first pass over all texts counts words and pairs chunk by chunk and gives those that
hold 1 / ``SHARE`` of a chunk, so every feature with that share of the corpus is a candidate.  The ``HEAD`` most
frequent of each kind are broadcast: words with their exact CRC state (from which a pair's CRC goes on), pairs
with their bucket.  Any other feature takes a direct CRC over its bytes, for a pair from the left word's state
on.  Both give the same bucket, so the head only saves work; bucket totals are exact sums over all features.

Scale: a task gives at most SHARE candidates a chunk and one count a bucket; head (16 bytes an entry), totals and
gains have a fixed size.  Ranks come from a range partitioning of narrow rows, not from one task.  Features
of the head are told apart by 64-bit hashes.

Defined results: null and wordless texts have no features, weight 0 and are never drawn; null ids hash
as an empty id and come first among equal scores; repeated rows are scored and drawn each by itself; an empty corpus
gives no rows, an empty target is smoothed like any other.  Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendfeat.llm import _text as T
from lendfeat.llm._store import settle
from lendfeat.operators.ranking import rank_within

BUCKETS = 10_000
SHARE = 1 << 13
HEAD = 1 << 16
#: Words of more bytes are left to zlib.
LONG = 48
_WORD, _PAIR = 0, 1

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
MEMBER = T.IS_WORD & (_byte != 95)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()
_FULL = np.uint32(0xFFFFFFFF)


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end], each going on from a state (0: none)."""
    size = end - start
    c = state.astype(np.uint32) ^ _FULL
    active = np.flatnonzero(size <= LONG)
    for k in range(LONG):
        active = active[size[active] > k]
        if not len(active):
            break
        now = c[active]
        c[active] = _CRC[(now ^ data[start[active] + k]) & 255] ^ now >> np.uint32(8)
    c ^= _FULL
    for i in np.flatnonzero(size > LONG).tolist():
        c[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(state[i]))
    return c


def _spaced(crc: np.ndarray) -> np.ndarray:
    """The state after one more space."""
    c = crc ^ _FULL
    return (_CRC[(c ^ np.uint32(32)) & 255] ^ c >> np.uint32(8)) ^ _FULL


class _Slots:
    """Values by 64-bit key; of keys that share a slot, the first given is kept."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(8, int(2 * len(keys)).bit_length()))
        slot = (keys >> self.shift).astype(np.int64)
        slot, first = np.unique(slot, return_index=True)
        self.keys = np.zeros(1 << (64 - int(self.shift)), np.uint64)
        self.values = np.zeros(len(self.keys), np.uint32)
        self.keys[slot], self.values[slot] = keys[first], values[first]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, whether the key is held)."""
        slot = (keys >> self.shift).astype(np.int64)
        return self.values[slot], (self.keys[slot] == keys) & (keys != 0)


class Head:
    """CRC states of frequent words and buckets of frequent pairs; empty without any."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray], pairs: tuple[np.ndarray, np.ndarray]):
        self.words, self.pairs = _Slots(*words), _Slots(*pairs)


def no_head() -> Head:
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    return Head(none, none)


class _Features:
    """Words and pairs of a chunk of texts: hashes, bytes, and which word pairs up with its follower."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data = LOWER[data]
        self.word, self.start, self.end, self.stop = T.words(self.data, ends, MEMBER)
        follows = np.ones(len(self.word), bool)
        follows[self.stop[self.stop > 0] - 1] = False
        self.left = np.flatnonzero(follows)
        self.pair = T.mix(self.word[self.left] * T.U64(0x9E3779B97F4A7C15) + self.word[self.left + 1])
        self.n = np.diff(self.stop, prepend=0)

    def crcs(self, at: np.ndarray) -> np.ndarray:
        """Direct CRC of words."""
        return crc32(self.data, self.start[at], self.end[at], np.zeros(len(at), np.uint32))

    def pair_buckets(self, left: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Direct buckets of pairs, from the left words' CRC."""
        return crc32(self.data, self.start[left + 1], self.end[left + 1], _spaced(state)) % np.uint32(BUCKETS)

    def buckets(self, head: Head) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all words and all pairs."""
        state, held = head.words.find(self.word)
        tail = np.flatnonzero(~held)
        state[tail] = self.crcs(tail)
        pair, held = head.pairs.find(self.pair)
        tail = np.flatnonzero(~held)
        pair[tail] = self.pair_buckets(self.left[tail], state[self.left[tail]])
        return state % np.uint32(BUCKETS), pair


def _texts(df: DataFrame, text: str, key: str | None = None) -> DataFrame:
    return df.select(*([F.col(key).cast("long").alias("doc_id")] if key else []), F.col(text).alias("text"))


def candidates(docs: DataFrame, text: str = "text", share: int = SHARE) -> DataFrame:
    """(kind, key, crc, n): the words (CRC state) and pairs (bucket) that hold 1 / share of a chunk, with
    their count over the chunks where they do."""

    def run(batches):
        for batch in batches:
            for _, data, ends in T.chunks(batch["text"], lower=False):
                f = _Features(data, ends)
                words, first, n = np.unique(f.word, return_index=True, return_counts=True)
                often = n * share >= len(f.word)
                words, first, n = words[often], first[often], n[often]
                pairs, at, k = np.unique(f.pair, return_index=True, return_counts=True)
                often = k * share >= len(f.pair)
                pairs, at, k = pairs[often], f.left[at[often]], k[often]
                crc = np.concatenate([f.crcs(first), f.pair_buckets(at, f.crcs(at))])
                kind = np.repeat(np.array([_WORD, _PAIR], np.int32), [len(words), len(pairs)])
                columns = kind, np.concatenate([words, pairs]).view(np.int64), crc.astype(np.int64), np.concatenate([n, k]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "key", "crc", "n"])

    found = _texts(docs, text).mapInArrow(run, "kind int, key long, crc long, n long")
    return found.groupBy("kind", "key").agg(F.first("crc").alias("crc"), F.sum("n").alias("n"))


def frequent(docs: DataFrame, text: str = "text", size: int = HEAD, share: int = SHARE) -> Head:
    """The most frequent words and pairs, size of each at most."""
    every = settle(candidates(docs, text, share), "head-candidates")

    def most(kind: int):
        top = every.where(F.col("kind") == kind).orderBy(F.desc("n"), "key").limit(size).select("key", "crc").toArrow()
        return top["key"].to_numpy().view(np.uint64), top["crc"].to_numpy().astype(np.uint32)

    return Head(most(_WORD), most(_PAIR))


def totals(docs: DataFrame, head: Head, text: str = "text") -> DataFrame:
    """(bucket, n): exact feature counts over all texts."""
    sent = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, data, ends in T.chunks(batch["text"], lower=False):
                for b in _Features(data, ends).buckets(sent.value):
                    total += np.bincount(b, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    return _texts(docs, text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket from the totals of corpus and target."""
    spark = source.sparkSession
    both = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    for name, df in (("s", source), ("t", target)):
        both = both.join(df.withColumnRenamed("n", name), "bucket", "left").fillna(0, [name])
    row = both.agg(F.sum("s"), F.sum("t")).first()
    of = lambda n: F.col(n).cast("double")
    ratio = (of("t") + 1) * F.lit(float(row[0] + BUCKETS)) / ((of("s") + 1) * F.lit(float(row[1] + BUCKETS)))
    table = both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).toArrow()  # BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    out[table["bucket"].to_numpy()] = table["gain"].to_numpy()
    return out


def weigh(docs: DataFrame, head: Head, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast((head, gain))

    def run(batches):
        for batch in batches:
            for at, data, ends in T.chunks(batch["text"], lower=False):
                f = _Features(data, ends)
                words, pairs = f.buckets(sent.value[0])
                n_pairs = np.maximum(f.n - 1, 0)
                total = T.per_text(sent.value[1][words], f.stop) + T.per_text(sent.value[1][pairs], np.cumsum(n_pairs))
                n = f.n + n_pairs
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, len(ends)), *[pa.array(x.astype(np.int64)) for x in (f.n, n, weight)]], ["doc_id", "n_words", "n_features", "weight"])

    return _texts(docs, text, doc_id).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least: int = 20, seed: int = 7, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank (null if it isn't drawn)."""
    head = frequent(docs, text)
    gain = gains(totals(docs, head, text), totals(target, head, target_text))
    hashed = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((hashed + 0.5) / 4294967296.0))).cast("long")
    scored = settle(weigh(docs, head, gain, doc_id, text).withColumn("score", F.col("weight") + noise), "resample-scores")
    able = scored.where(F.col("n_words") >= least).withColumn("falling", -F.col("score"))
    drawn = percent * able.count() // 100
    ranked = rank_within(able, [], ["falling", "doc_id", "weight", "n_features"], name="place")
    ranked = ranked.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).unionByName(rest.select(*columns))

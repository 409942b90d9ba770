"""Exact, reproducible sampling and splitting.

Rows are ordered by a seeded hash of the key (the same formula runs in the SQL
oracle); each kind of draw and each seed has an order of its own.  Every operator here only needs to know where a row's exact
rank falls relative to a few cut points (the test share, n, the smallest
class, the fold boundaries), so ``segment_by_rank`` settles whole hash buckets
from a 65,536-bucket histogram and ranks only the rows of buckets that
straddle a cut.  No operator shuffles or sorts the full data, and none puts a
class into one task.  Sizes are exact (``floor(f * n_c + 1/2)`` per class),
which ``DataFrame.sampleBy`` cannot promise.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendfeat.operators.ranking import hash_bucket, rank_within, segment_by_rank, seeded_hash_keys

HASH = "__h"
SEG = "__seg"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _segmented(df: DataFrame, key, by: list[str], seed: int, purpose: str, cuts) -> DataFrame:
    """Segment of each row's rank inside ``by`` ordered by (hash of the key, key)."""
    keys = _keys(key)
    hashed = df.withColumn(HASH, seeded_hash_keys(keys, seed, purpose))
    order = [F.col(HASH), *[F.col(k) for k in keys]]
    return segment_by_rank(hashed, by, order, hash_bucket(HASH), cuts, name=SEG).drop(HASH)


def _share(n: Column, fraction: float) -> Column:
    """round-half-up of fraction * n in integer arithmetic (exact, engine-independent)."""
    f = Fraction(fraction).limit_denominator(1_000_000)
    return F.floor((n * F.lit(2 * f.numerator) + F.lit(f.denominator)) / F.lit(2 * f.denominator)).cast("bigint")


def sample_n(df: DataFrame, key, n: int, seed: int = 44) -> DataFrame:
    """Exactly min(n, rows) rows, the n smallest (hash, key); ``key`` may be a list."""
    out = _segmented(df, key, [], seed, "sample", lambda gn, gmin: [F.lit(n).cast("bigint")])
    return out.where(F.col(SEG) == 0).drop(SEG)


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float = 0.2,
                     seed: int = 44, flag: str = "is_test") -> DataFrame:
    """Add ``flag`` = 1 for round(test_fraction * n_c) rows of every class."""
    out = _segmented(df, key, [label], seed, "split", lambda gn, gmin: [_share(gn, test_fraction)])
    return out.withColumn(flag, (F.col(SEG) == 0).cast("int")).drop(SEG)


def split(df: DataFrame, key: str, label: str, test_fraction: float = 0.2, seed: int = 44):
    """(train, test) frames of the stratified split."""
    marked = stratified_split(df, key, label, test_fraction, seed)
    return (marked.where(F.col("is_test") == 0).drop("is_test"),
            marked.where(F.col("is_test") == 1).drop("is_test"))


def folds(df: DataFrame, key: str, label: str, k: int, seed: int = 44, name: str = "fold") -> DataFrame:
    """Stratified fold 0..k-1; fold f holds ranks floor(n_c f/k)+1 .. floor(n_c (f+1)/k) of each class."""
    cuts = lambda gn, gmin: [F.floor(gn * j / k).cast("bigint") for j in range(1, k)]
    return _segmented(df, key, [label], seed, "fold", cuts).withColumnRenamed(SEG, name) \
        .withColumn(name, F.col(name).cast("int"))


def downsample(df: DataFrame, key: str, label: str, seed: int = 44) -> DataFrame:
    """X3 + U2: every class cut to the smallest class's size, without replacement.

    The minority keeps all rows; the majority keeps its n_min first rows in hash
    order.  The reference's union of the two parts is this one filter.  Rows without
    a label are no class and are left out."""
    known = df.where(F.col(label).isNotNull())
    out = _segmented(known, key, [label], seed, "downsample", lambda gn, gmin: [gmin])
    return out.where(F.col(SEG) == 0).drop(SEG)


def shuffled(df: DataFrame, key, seed: int = 44) -> DataFrame:
    """Rows in the order of (seeded hash of the key, key), the same however they are partitioned."""
    keys = _keys(key)
    return df.orderBy(seeded_hash_keys(keys, seed, "shuffle"), *keys)


def shuffled_batches(df: DataFrame, key, size: int, seed: int = 44) -> DataFrame:
    """X4 for mini-batches: ``pos``, the row's place (from 0) in the order of (seeded hash of the key, key), and
    ``batch`` = pos div size.  Ranked over a range partitioning, so no task orders all rows."""
    keys = _keys(key)
    hashed = df.withColumn(HASH, seeded_hash_keys(keys, seed, "shuffle"))
    ranked = rank_within(hashed, [], [HASH, *keys], name="pos").withColumn("pos", F.col("pos") - 1).drop(HASH)
    return ranked.withColumn("batch", F.expr(f"pos div {int(size)}"))

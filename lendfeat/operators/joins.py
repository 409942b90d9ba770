"""Joins that a hot key doesn't stop.

AQE splits a skewed partition only where it sees one and the join type allows it.  ``salted_join`` needs no
such luck: heavy keys are counted first, their rows on the large side are dealt over as many salts as their
count asks for, and the matching rows of the other side are repeated once a salt.  All other keys keep one
salt, so the join stays one shuffle of each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with this share of the rows is heavy; at most 1 / HEAVY_SHARE keys are, so their table may be broadcast.
HEAVY_SHARE = 1 / 2000
#: Rows without a key match nothing and are dealt over so many salts.
NULL_SALTS = 64
_SALT, _SALTS = "__salt", "__salts"


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> DataFrame:
    """(key, rows, salts) of every key with at least ``share`` of the rows; a salt takes about that share.

    One aggregate with partial counts, checkpointed; at most 1 / share rows."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).checkpoint()
    total = counts.agg(F.sum("rows")).first()[0] or 0
    least = max(2.0, total * share)
    return counts.where(F.col("rows") >= least).withColumn(_SALTS, F.ceil(F.col("rows") / F.lit(least)).cast("int")).checkpoint()


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", share: float = HEAVY_SHARE) -> DataFrame:
    """``left.join(right, key, how)`` (inner or left) for a left side with hot keys.

    Salts come from a hash of the row, so a recomputed task deals its rows alike."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    heavy = F.broadcast(heavy_keys(left, key, share).select(key, _SALTS))
    dealt = F.xxhash64(*[F.col(c) for c in left.columns])
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce(F.col(_SALTS), F.lit(1)))
    many = left.join(heavy, key, "left").withColumn(_SALT, F.pmod(dealt, salts.cast("bigint")).cast("int")).drop(_SALTS)
    few = right.join(heavy, key, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))).drop(_SALTS)
    return many.join(few, [key, _SALT], how).drop(_SALT)

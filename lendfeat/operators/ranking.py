"""Exact ranks inside groups without sending a whole group to one task.

``Window.partitionBy(g).orderBy(o)`` puts every row of a group into one task;
a group holding a third of the data (one client, one class) then runs on a
single core.  ``rank_within`` range-partitions the rows by (group, order) and
ranks inside each part of a group; ``segment_by_rank`` needs only where a rank
falls and settles whole hash buckets from a histogram.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendfeat.session import scratch_path

HASH_BUCKET_WIDTH = 65536  # 2^16 buckets per group for hash orders


def seeded_hash(key: str | Column, seed: int, purpose: str = "") -> Column:
    """Deterministic 32-bit hash: the first eight hex digits of md5("purpose:seed:key").

    The same formula runs in SQL; another seed or purpose gives an unrelated order."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{purpose}:{seed}:"), k.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def seeded_hash_keys(keys, seed: int, purpose: str = "") -> Column:
    """Chain ``seeded_hash`` over a composite integer key."""
    h = None
    for k in keys:
        c = F.col(k) if isinstance(k, str) else k
        h = seeded_hash(c if h is None else h + c, seed, purpose)
    return h


def hash_bucket(h: str | Column) -> Column:
    """Top 16 bits of a 32-bit hash: 65,536 buckets, monotone in the hash."""
    c = F.col(h) if isinstance(h, str) else h
    return F.floor(c / F.lit(HASH_BUCKET_WIDTH)).cast("bigint")


def rank_within(df: DataFrame, by: list[str], order: list[str], *, name: str = "rank") -> DataFrame:
    """Add ``name`` = exact 1-based ``row_number()`` within ``by`` ordered by the columns ``order``.

    Rows are range-partitioned by (by, order) and written once, with the number of
    their range; a group that fills many ranges is ranked range by range, in
    parallel, and each range adds the rows of the group's earlier ranges (one
    row per group and range).  ``order`` must be unique within a group for the
    result to be deterministic."""
    ranged = df.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()).checkpoint()
    keys = [*by, "__range"]
    counts = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"__o_{k}") for k in keys],
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = ranged.withColumn("__in", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    cond = [inside[k].eqNullSafe(offsets[f"__o_{k}"]) for k in keys]
    ranked = inside.join(offsets, cond, "inner").withColumn(name, F.col("__off") + F.col("__in"))
    return ranked.drop("__range", "__off", "__in", *[f"__o_{k}" for k in keys])


def segment_by_rank(df: DataFrame, by: list[str], order: list, bucket: Column,
                    cuts: Callable[[Column, Column], list[Column]], *, name: str = "segment") -> DataFrame:
    """Add ``name`` = how many cut points lie below the row's exact rank in its group.

    ``cuts(group_size, smallest_group_size)`` gives the cut points of a group as
    expressions of its size.  Rows are ranked by ``order`` inside ``by``;
    ``bucket`` must be monotone in that order and take a bounded number of
    values per group.  The (group, bucket) histogram is written, so the planner
    knows its bytes and broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` only.

    Only buckets that straddle a cut point need real ranks: every other bucket
    lies wholly between two cuts and is settled by a broadcast join with the
    histogram, without moving its rows.  The rows of straddling buckets (at
    most one bucket per cut and group) are the only ones shuffled and sorted.
    Once it is written, the input is read twice more (settled
    rows, straddling rows): checkpoint an expensive input first.
    """
    keyed = df.withColumn("__b", bucket)
    keys = [*by, "__b"]
    hist = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    gsize = F.sum("__n").over(Window.partitionBy(*by))
    h = (hist.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
         .withColumn("__gn", gsize))
    h = h.withColumn("__gmin", F.min("__gn").over(Window.partitionBy()))
    points = cuts(F.col("__gn"), F.col("__gmin"))

    def seg(rank: Column) -> Column:
        return reduce(add, [(p < rank).cast("int") for p in points], F.lit(0))

    h = h.select(*[F.col(k).alias(f"__o_{k}") for k in keys], "__off",
                 seg(F.col("__off") + 1).alias("__first"), seg(F.col("__off") + F.col("__n")).alias("__last"),
                 *[p.alias(f"__cut{i}") for i, p in enumerate(points)])
    path = scratch_path(df.sparkSession, "rank_histogram")
    h.write.parquet(path)
    h = df.sparkSession.read.schema(h.schema).parquet(path)
    cond = [keyed[k].eqNullSafe(h[f"__o_{k}"]) for k in keys]
    joined = keyed.join(h, cond, "inner")
    settled = joined.where(F.col("__first") == F.col("__last")).withColumn(name, F.col("__first"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    rank = F.col("__off") + F.row_number().over(inside)
    edge_seg = reduce(add, [(F.col(f"__cut{i}") < rank).cast("int") for i in range(len(points))], F.lit(0))
    edge = joined.where(F.col("__first") != F.col("__last")).withColumn(name, edge_seg)
    drop = ["__b", "__off", "__first", "__last", *[f"__o_{k}" for k in keys],
            *[f"__cut{i}" for i in range(len(points))]]
    return settled.unionByName(edge).drop(*drop)

"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``replicas`` virtual nodes on a ring of ``CELLS`` cells; a key belongs to
the first node clockwise from its hash.  Loads are bounded by the row law: with N rows,
a shard holds N / shards rows, rounded up for the first N mod shards.  Arcs (the cells
before a node) are settled clockwise; rows that overflow a full shard go on clockwise to the
next one with room, so counts differ by at most one and only overflowing rows leave home.

DataFrame and SQL functions only.  Ranks come from counts of small slices (a ring cell and
a hash of key and text), so neither a hot key nor a hot shard meets in one task, equal rows are counted
and ranked as one, and places depend on the rows alone; the ring, its arcs and their segments have a fixed size.

Defined results: null keys share one place on the ring, null texts have size 8 and no
checksum, repeated rows each get a slot of their own, an empty table gives no rows.
Columns of the input but key and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendfeat.llm._store import expand, large, settle

CELLS = 1 << 16
SLICES = 256

_SETTLE = """
aggregate(arcs,
  named_struct('free', caps, 'out', cast(array() as array<struct<arc:int,lo:bigint,hi:bigint,shard:int,base:bigint>>)),
  (s, a) -> aggregate(
    array_distinct(concat(slice(owners, a.arc + 1, size(owners)), slice(owners, 1, a.arc))),
    named_struct('free', s.free, 'rest', a.n, 'out', s.out),
    (t, shard) -> if(t.rest = 0 or t.free[shard] = 0, t, named_struct(
      'free', transform(t.free, (f, i) -> if(i = shard, f - least(f, t.rest), f)),
      'rest', t.rest - least(t.rest, t.free[shard]),
      'out', concat(t.out, array(named_struct('arc', a.arc, 'lo', a.n - t.rest, 'hi', a.n - t.rest + least(t.rest, t.free[shard]), 'shard', shard, 'base', caps[shard] - t.free[shard]))))),
    t -> named_struct('free', t.free, 'out', t.out)))
"""


def ring(docs: DataFrame, shards: int, replicas: int) -> DataFrame:
    """One row: owners, the shard of each node clockwise, and nodes, their cells."""
    nodes = docs.sparkSession.range(shards * replicas).select((F.col("id") % shards).cast("int").alias("shard"), F.pmod(F.xxhash64("id", F.lit("node")), F.lit(CELLS)).cast("int").alias("cell"))
    return nodes.agg(F.sort_array(F.collect_list(F.struct("cell", "shard"))).alias("ring")).selectExpr("ring.shard as owners", "ring.cell as nodes")


def assign(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", replicas: int = 64) -> DataFrame:
    """Key, size (UTF-8 bytes and 8), text_crc32, shard, slot (gapless from 0 in its shard), home (the shard of an unbounded ring)."""
    # equal rows are one group with its count until their ranks are known, so that places depend on content alone
    rows = docs.select(
        F.col(key).alias(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.col(text)).alias("text_crc32"),
        F.xxhash64(F.col(key)).alias("hash"),
        F.xxhash64(F.col(key), F.col(text)).alias("whole"),
    )
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    rows = settle(rows.withColumn("cell", F.pmod("hash", F.lit(CELLS)).cast("int")).withColumn("slice", F.pmod("whole", F.lit(SLICES)).cast("int")), "shard-rows")

    around = ring(docs, shards, replicas)
    # the cells after the last node belong to the first one
    spans = "explode(concat(transform(nodes, (c, i) -> named_struct('arc', i, 'lo', if(i = 0, 0, nodes[i - 1] + 1), 'hi', c)), array(named_struct('arc', 0, 'lo', element_at(nodes, -1) + 1, 'hi', %d))))"
    cells = around.selectExpr(f"{spans % (CELLS - 1)} as s").where("s.lo <= s.hi").selectExpr("s.arc", "explode(sequence(s.lo, s.hi)) as cell")

    counts = rows.groupBy("cell", "slice").agg(F.sum("n").alias("n")).join(F.broadcast(cells), "cell")
    before = Window.partitionBy("arc").orderBy("cell", "slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = settle(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "shard-counts")
    arcs = counts.groupBy("arc").agg(F.sum("n").alias("n"))
    # one row of fixed size: the arcs' counts beside the ring
    parts = arcs.select(F.struct("arc", "n").alias("arc"), F.lit(None).cast("array<int>").alias("owners")).unionByName(around.select("owners"), allowMissingColumns=True)
    segments = (
        parts.agg(F.sort_array(F.collect_list("arc")).alias("arcs"), F.coalesce(F.sum("arc.n"), F.lit(0)).alias("total"), F.first("owners", ignorenulls=True).alias("owners"))
        .withColumn("caps", F.expr(f"transform(sequence(0, {shards - 1}), i -> total div {shards} + if(i < total % {shards}, 1L, 0L))"))
        .select(F.explode(F.expr(f"({_SETTLE}).out")).alias("s"), "owners")
        .select("s.*", F.expr("owners[s.arc]").alias("home"))
    )
    segments = settle(segments, "shard-segments")  # at most one row for each node and shard
    earlier = Window.partitionBy("cell", "slice").orderBy("hash", "whole", key, "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("rank", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(counts.select("cell", "slice", "arc", "before"), ["cell", "slice"])
    placed = expand(placed.select(key, "size", "text_crc32", "n", "arc", (F.col("rank") + F.col("before")).alias("rank")), "n", "copy", large(rows, "n")).withColumn("rank", F.col("rank") + F.col("copy"))
    within = (placed["arc"] == segments["arc"]) & (placed["rank"] >= segments["lo"]) & (placed["rank"] < segments["hi"])
    return placed.join(F.broadcast(segments), within).select(placed[key], "size", "text_crc32", "shard", (F.col("rank") - F.col("lo") + F.col("base")).alias("slot"), "home")

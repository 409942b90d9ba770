"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule takes the golden-ratio point frac(i * phi) through the cumulative
target weights to a source.  A source's slots are ranked; its r-th slot takes the r-th block of
``block`` words of the source's shuffled texts, laid end to end, a second time round once
used up.  Slots beyond a source's target are left out, slots that the points leave short are
appended at the end, and the last block is cut, so every source's words meet its target.

Targets: sources by code point (null last) weigh 3, 1, 2, repeating, and share 150 % of all
words; a target stops at twice its source's words and the excess is reshared by weight.
That is the level L with sum(min(2 S, L w)) = total, which is the largest of the levels
obtained by assuming the first k sources (by 2 S / w) full.

DataFrame and SQL functions only.  Offsets and ranks come from sums over small buckets, so a
hot source is never ordered in one task.  A text's place is a hash of key, text and seed, so a key that many
texts share is spread too; equal rows are counted and laid as one.

Defined results: a null source is a source of its own, null and wordless texts have size 0
and are never taken, repeated rows are taken each by itself, an empty table gives no rows.
Extra columns are not read.  Nothing depends on partitions or the order of rows: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendfeat.llm._store import expand, large, settle

BLOCK = 256
BUCKETS, RUN = 1 << 16, 1 << 16
GRID = 1 << 10
POINTS = 1 << 31
GOLDEN = 1327217885  # the golden ratio's fraction of POINTS, odd
WORD = r"[^\x20\x09-\x0D]+"


def _before(columns: list[str], order: list[str]):
    return Window.partitionBy(*columns).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source (source, source_size): source_no (code point order, null last), weight, target."""
    numbered = sources.withColumn("source_no", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int"))
    weighed = numbered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights) + 1))
    full = F.col("source_size") * most
    upto = Window.orderBy(full / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(upto), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    return weighed.withColumn("level", level).withColumn("target", F.least(full, F.col("weight") * F.max("level").over(everything))).drop("level")


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots (slot, source_no, rank) that meet every source's quota of floor(target) words."""
    plan = plan.withColumn("quota", F.ceil(F.floor("target") / block).cast("long"))
    total = plan.agg(F.sum("quota")).first()[0] or 0
    spark = plan.sparkSession
    upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    ends = plan.where("quota > 0").withColumn("end", F.round(F.sum("quota").over(upto) / total * POINTS).cast("long") if total else F.lit(0))
    ends = ends.withColumn("start", F.coalesce(F.lag("end").over(Window.orderBy("source_no")), F.lit(0)))
    step = POINTS // GRID
    parts = ends.where("start < end").select("source_no", "quota", "start", "end", F.explode(F.expr(f"sequence(start div {step}, (end - 1) div {step})")).alias("grid"))
    parts = settle(parts, "mix-parts")  # a row for each source, and one for each cell of the grid
    points = spark.range(total).withColumnRenamed("id", "slot").withColumn("point", F.expr(f"pmod(pmod(slot, {POINTS}) * {GOLDEN}L, {POINTS}L)")).withColumn("grid", F.expr(f"point div {step}"))
    slots = points.join(parts, "grid").where("point >= start and point < end").withColumn("run", F.expr(f"slot div {RUN}"))
    runs = slots.groupBy("source_no", "run").agg(F.count("*").alias("n"))
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(_before(["source_no"], ["run"])), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("source_no", "run").orderBy("slot")) - 1
    slots = slots.withColumn("rank", rank).join(runs.select("source_no", "run", "before"), ["source_no", "run"]).withColumn("rank", F.col("rank") + F.col("before"))
    had = runs.groupBy("source_no").agg(F.sum("n").alias("had"))
    short = plan.join(had, "source_no", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < quota")
    short = short.select(F.lit(total).cast("long").alias("slot"), "source_no", F.explode(F.expr("sequence(had, quota - 1)")).alias("rank"))
    return slots.where("rank < quota").select("slot", "source_no", "rank").unionByName(short)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces): a row per document with size, source_size, target and taken, and the
    schedule's pieces (slot, source_no, offset of the text in its source, round, start, length)."""
    # equal rows are one group with its count until their offsets are known, so that order depends on content alone
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(key), F.col(text), F.lit(seed)).alias("hash"),
    )
    rows = rows.groupBy("doc_id", "source", "size", "hash").agg(F.count("*").alias("n"))
    rows = settle(rows.withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)).cast("int")), "mix-rows")
    spread = large(rows, "n")
    plan = settle(targets(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "mix-targets")

    rows = rows.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    small = ["source_no", "bucket"]
    sums = rows.groupBy(*small).agg(F.sum(F.col("size") * F.col("n")).alias("sum"))
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(_before(["source_no"], ["bucket"])), F.lit(0))).drop("sum")
    inner = F.coalesce(F.sum(F.col("size") * F.col("n")).over(_before(small, ["hash", "doc_id", "size"])), F.lit(0))
    laid = rows.withColumn("inner", inner).join(sums, small).withColumn("offset", F.col("before") + F.col("inner"))
    laid = expand(laid.select("doc_id", "source_no", "size", "source_size", "target", "offset", "n"), "n", "copy", spread).withColumn("offset", F.col("offset") + F.col("copy") * F.col("size"))
    laid = settle(laid.drop("n", "copy"), "mix-laid")

    rounds = laid.where("size > 0").withColumn("round", F.explode(F.array(F.lit(0), F.lit(1))))
    rounds = rounds.withColumn("lo", F.expr("offset + round * source_size")).withColumn("hi", F.least(F.expr("lo + size"), F.floor("target")))
    cut = rounds.where("lo < hi").withColumn("rank", F.explode(F.expr(f"sequence(lo div {block}, (hi - 1) div {block})")))
    cut = cut.withColumn("from", F.greatest("lo", F.col("rank") * block)).withColumn("to", F.least("hi", (F.col("rank") + 1) * block))
    pieces = cut.join(schedule(plan, block), ["source_no", "rank"]).select("slot", "source_no", "offset", "round", (F.col("from") - F.col("lo")).alias("start"), (F.col("to") - F.col("from")).alias("length"))
    taken = pieces.groupBy("source_no", "offset").agg(F.sum("length").alias("taken"))
    own = laid.withColumn("offset", F.when(F.col("size") > 0, F.col("offset")))
    documents = own.join(taken, ["source_no", "offset"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source_no")
    return documents, pieces

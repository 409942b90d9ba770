"""Results written once to the shared scratch folder and read again (cuts lineage, survives lost executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendfeat.session import scratch_path

#: Slots of a prefilter: a broadcast of at most so many integers, whatever the input.
SLOTS = 1 << 20

_written: dict[str, list[str]] = {}


def settle(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _written.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(spark: SparkSession) -> int:
    """How many tables this application has settled so far."""
    return len(_written.get(spark.sparkContext.applicationId, []))


def release(docs: DataFrame, since: int) -> None:
    """Deletes the tables settled after the first ``since`` ones, but for those that ``docs`` reads.

    For a caller whose results so far are all in ``docs``, which has been written."""
    spark = docs.sparkSession
    paths = _written.get(spark.sparkContext.applicationId, [])
    read, kept = docs.inputFiles(), []
    for path in paths[since:]:
        bare = path.split(":", 1)[-1].lstrip("/")
        if any(f"/{bare}/" in f for f in read):
            kept.append(path)
            continue
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    paths[since:] = kept


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS)).cast("int")


def slots(wanted: DataFrame, key: str) -> DataFrame:
    """The slots that the 64-bit hashes in a column take: at most SLOTS integers, written once."""
    return settle(wanted.select(_slot(F.col(key)).alias("__slot")).distinct(), "slots")


def likely(df: DataFrame, key: Column, held: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of df whose hash takes one of the slots (left_semi), or surely none of the wanted hashes (left_anti),
    without a shuffle.  An exact join of the likely rows follows."""
    return df.withColumn("__slot", _slot(key)).join(F.broadcast(held), "__slot", how).drop("__slot")


#: Rows that one task numbers of a group.
BLOCK = 1 << 12


def large(groups: DataFrame, n: str) -> bool:
    """Whether any of the (settled) groups has more rows than a block."""
    return bool(groups.where(F.col(n) > BLOCK).limit(1).count())


def expand(groups: DataFrame, n: str, index: str, spread: bool) -> DataFrame:
    """n rows for every row of groups, numbered from 0 in ``index``; ``spread`` (see large) deals the blocks of
    large groups to different tasks."""
    blocks = groups.withColumn("__block", F.explode(F.expr(f"sequence(0L, ({n} - 1) div {BLOCK})")))
    if spread:
        blocks = blocks.repartition("__block", *[c for c in groups.columns if c != n])
    row = F.expr(f"sequence(__block * {BLOCK}L, least({n}, (__block + 1) * {BLOCK}L) - 1)")
    return blocks.withColumn(index, F.explode(row)).drop("__block")

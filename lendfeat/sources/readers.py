"""Readers and writers (S1-S5) with explicit schemas.

Parts that share a schema are read in one scan (``spark.read.parquet(*paths)``), never one frame
per file followed by a union; CSV is read with a declared schema, never by
inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, FractionalType, IntegerType,
                               LongType, NullType, NumericType, ShortType, StructField, StructType, TimestampType)

from lendfeat.session import scratch_path

TARGET_SCHEMA = "id BIGINT, flag INT"
CORRUPT = "__line"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One parquet table."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds both: integers grow, integers beside floats become double, decimals keep
    digits on both sides, dates become timestamps.  Other pairs have none (ValueError)."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale)
        if digits + scale <= 38:
            return DecimalType(digits + scale, scale)
    for order in ((ByteType, ShortType, IntegerType, LongType), (FloatType, DoubleType), (DateType, TimestampType)):
        if isinstance(a, order) and isinstance(b, order):
            return max((a, b), key=lambda t: order.index(type(t)))
    if isinstance(a, NumericType) and isinstance(b, NumericType) and (isinstance(a, FractionalType) or isinstance(b, FractionalType)):
        return DoubleType()
    raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def union_schema(schemas) -> StructType:
    """Every column of the schemas, in order of first appearance, nullable, with the widest of its types."""
    types: dict[str, DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            try:
                types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
            except ValueError as e:
                raise ValueError(f"column {f.name}: {e}") from None
    return StructType([StructField(n, t, True) for n, t in types.items()])


def read_parts(spark: SparkSession, paths, schema: StructType | str | None = None) -> DataFrame:
    """S2 + U1: numbered parts as one table.

    With a schema, one scan of it.  Without, the parts' footers decide: the table has every column of any part,
    NULL where a part lacks it, in the widest of its types.  Parts that agree share one scan, so there
    are as many scans as there are different schemas."""
    paths = list(paths)
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    alike: dict[str, tuple[StructType, list[str]]] = {}
    for path in paths:
        own = spark.read.option("mergeSchema", True).parquet(path).schema
        alike.setdefault(own.json(), (own, []))[1].append(path)
    if len(alike) == 1:
        (own, _), = alike.values()
        return spark.read.schema(own).parquet(*paths)
    whole, out = union_schema(own for own, _ in alike.values()), None
    for own, some in alike.values():
        have = set(own.names)
        part = spark.read.schema(own).parquet(*some).select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole.fields])
        out = part if out is None else out.unionByName(part)
    return out


def part_files(base: str) -> str:
    """Glob of the numbered part files Spark writes into a table folder."""
    return f"{base.rstrip('/')}/part-*.parquet"


def read_csv(spark: SparkSession, path: str, schema: StructType | str = TARGET_SCHEMA,
             header: bool = True) -> DataFrame:
    """S3: CSV with a header and a declared schema."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S3 with malformed rows kept apart: (good rows, rejects).

    A line with a value that its column's type can't hold, or with too few or too many fields, is a reject:
    (file, line).  Every line is parsed with all columns and written once, by verdict, since what Spark calls
    malformed otherwise depends on the columns a query happens to read."""
    parsed = (spark.read.schema(f"{schema}, {CORRUPT} STRING").option("header", header).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    parsed = parsed.withColumn("__file", F.input_file_name()).withColumn("__rejected", F.col(CORRUPT).isNotNull())
    at = scratch_path(spark, "csv-checked")
    parsed.write.partitionBy("__rejected").parquet(at)
    table = spark.read.schema(parsed.schema).parquet(at)
    good = table.where(~F.col("__rejected")).drop(CORRUPT, "__file", "__rejected")
    return good, table.where("__rejected").select(F.col("__file").alias("file"), F.col(CORRUPT).alias("line"))


def reject_counts(good: DataFrame, rejects: DataFrame) -> DataFrame:
    """(n_good, n_rejected) of a checked read."""
    both = good.select(F.lit(False).alias("bad")).unionByName(rejects.select(F.lit(True).alias("bad")))
    return both.agg(F.count_if(~F.col("bad")).alias("n_good"), F.count_if("bad").alias("n_rejected"))


def write_parquet(df: DataFrame, path: str) -> None:
    """Feature table to parquet."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Predictions to CSV with a header and no index."""
    df.write.mode("overwrite").option("header", header).csv(path)


def write_manifest(spark: SparkSession, names, path: str) -> None:
    """A feature manifest as a text file, one name per line, in order."""
    rows = [(i, n) for i, n in enumerate(names)]
    (spark.createDataFrame(rows, "pos int, name string").orderBy("pos")
     .coalesce(1).select("name").write.mode("overwrite").text(path))


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """The ordered feature names of a manifest file (one column's worth of names, bounded)."""
    return [r[0] for r in spark.read.text(path).collect() if r[0]]

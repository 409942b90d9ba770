"""Parts with different columns, malformed CSV rows, salted joins, Arrow functions with state."""


import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, LongType, ShortType, StringType, TimestampType

from lendfeat.functions import history as H
from lendfeat.functions import udf as U
from lendfeat.operators import joins as J
from lendfeat.sources import readers as R


def test_parts_lacking_a_column_or_with_a_wider_type(spark, tmp_path):
    frames = [
        spark.createDataFrame([(1, 2, "x")], "id int, n int, s string"),
        spark.createDataFrame([(1 << 40, "y")], "id bigint, s string"),
        spark.createDataFrame([(3, 0.5, True)], "id int, n double, extra boolean"),
        spark.createDataFrame([(4, 7, "z")], "id int, n int, s string"),
    ]
    paths = [str(tmp_path / str(i)) for i in range(len(frames))]
    for df, p in zip(frames, paths):
        df.write.parquet(p)
    got = R.read_parts(spark, paths)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("id", "bigint"), ("n", "double"), ("s", "string"), ("extra", "boolean")]
    assert {tuple(r) for r in got.collect()} == {(1, 2.0, "x", None), (1 << 40, None, "y", None), (3, 0.5, None, True), (4, 7.0, "z", None)}
    # one scan for each schema, not for each part; a given schema is one scan
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(got).count("FileScan") == 3 and plan(R.read_parts(spark, [paths[0], paths[3]])).count("FileScan") == 1
    assert plan(R.read_parts(spark, paths, "id bigint, s string")).count("FileScan") == 1
    spark.createDataFrame([("a",)], "id string").write.parquet(str(tmp_path / "odd"))
    with pytest.raises(ValueError, match="column id"):
        R.read_parts(spark, [paths[0], str(tmp_path / "odd")])


def test_wider_types():
    assert R.wider(ShortType(), LongType()) == LongType() and R.wider(LongType(), DoubleType()) == DoubleType()
    assert R.wider(DateType(), TimestampType()) == TimestampType()
    assert R.wider(DecimalType(10, 2), DecimalType(8, 4)) == DecimalType(12, 4)
    with pytest.raises(ValueError):
        R.wider(IntegerType(), StringType())


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,flag\n1,0\n2,x\n3\n4,1,9\n,1\n5,\n99999999999999999999,1\n")
    good, rejects = R.read_csv_checked(spark, str(path), "id BIGINT, flag INT")
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, 0), (None, 1), (5, None)], key=str)
    assert {r["line"] for r in rejects.collect()} == {"2,x", "3", "4,1,9", "99999999999999999999,1"}
    assert all(r["file"].endswith("t.csv") for r in rejects.collect())
    # the verdict doesn't depend on the columns that are read
    assert good.select("id").count() == 3 and rejects.select("line").count() == 4
    assert tuple(R.reject_counts(good, rejects).first()) == (3, 4)


def test_salted_join_spreads_a_hot_client(spark):
    n = 30_000
    loans = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("id"), F.col("id").alias("rn"))
    loans = loans.unionByName(spark.range(2000).select(F.lit(None).cast("long").alias("id"), F.col("id").alias("rn")))
    targets = spark.range(600).select("id", (F.col("id") % 2).alias("flag")).where("id <> 11")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        for how in ("left", "inner"):
            got, want = J.salted_join(loans, targets, "id", how, share=1 / 200), loans.join(targets, "id", how)
            assert got.columns == want.columns and got.count() == want.count()
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
            spread = got.where("id = 7").groupBy(F.spark_partition_id().alias("p")).count().agg(F.count("*"), F.max("count")).first()
            assert spread[0] > 20 and spread[1] < n / 3 / 5
            plain = want.where("id = 7").groupBy(F.spark_partition_id().alias("p")).count().count()
            assert plain == 1
        assert J.heavy_keys(loans, "id", 1 / 200).count() <= 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert J.salted_join(loans.where("false"), targets, "id").count() == 0
    with pytest.raises(ValueError):
        J.salted_join(loans, targets, "id", "full")


def test_arrow_function_remembers_within_a_partition(spark):
    names = [f"enc_paym_{k}" for k in range(5)]
    rows = [(i, [(i * 7 + k) % 4 if (i + k) % 9 else None for k in range(5)]) for i in range(400)]
    df = spark.createDataFrame([(i, *v) for i, v in rows], "id int, " + ", ".join(f"{n} int" for n in names)).repartition(3)
    U.register_iterator(spark, "memo_features", lambda: U.StatusMemo(names, most=10), U.StatusMemo.TYPE)
    got = df.selectExpr("id", f"memo_features(array({', '.join(names)})) AS s").select("id", "s.*")
    want = df.select("id", *[c.alias(n) for n, c in H.status_features(H.status_vector(names)).items()]).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert df.where("false").selectExpr(f"memo_features(array({', '.join(names)})) AS s").count() == 0

    def numbered():
        seen = [0]

        def number(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = list(range(seen[0], seen[0] + len(batch)))
            seen[0] += len(batch)
            return pa.RecordBatch.from_arrays([batch["id"], pa.array(at, pa.int64())], ["id", "n"])

        return number

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        out = U.partition_apply(df, numbered, "id int, n long").withColumn("p", F.spark_partition_id())
        # the count goes on over a partition's batches and starts anew in the next
        assert all(r["lo"] == 0 and r["hi"] == r["n"] - 1 for r in out.groupBy("p").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("n")).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

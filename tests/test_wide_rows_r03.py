"""Loans are ranked on narrow rows, and wide rows run in compiled methods."""

from pyspark.sql import functions as F


def _orders(spark, n=600):
    return spark.range(n).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("2-HIGH").alias("o_orderpriority"), F.lit("O").alias("o_orderstatus"),
        F.expr("date_add(DATE'2020-01-01', cast(id % 50 as int))").alias("o_orderdate"))


def test_loans_are_ranked_on_narrow_rows(spark, monkeypatch):
    from lendfeat.sources import loans as L

    moved, rank = [], L.rank_within
    monkeypatch.setattr(L, "rank_within", lambda df, *a, **kw: moved.append(df.columns) or rank(df, *a, **kw))
    out = L.loans_from_orders(_orders(spark))
    assert len(moved[0]) == 5
    assert out.columns[:4] == ["id", "rn", "pre_cat_a", "enc_cat_b"] and out.count() == 600
    assert out.groupBy("id").agg(F.max("rn").alias("m"), F.count("*").alias("n")).where("m != n").count() == 0


def test_queries_run_wide_rows_in_compilable_methods(spark, tmp_path):
    import __spark_entry__ as e

    _orders(spark).write.parquet(str(tmp_path / "orders.parquet"))
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 65535)
    assert e.queries()["overdue_fraction"](spark, str(tmp_path)).count() == 600
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000

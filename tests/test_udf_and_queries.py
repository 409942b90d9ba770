"""D1/D2 extension points (cross-checked against the native C1) and the driver contract."""

import numpy as np

from lendfeat.functions import history as H
from lendfeat.functions.udf import chunked_apply, row_function
from lendfeat.roles import ColumnRoles


def test_row_function_matches_native_run(spark):
    def longest_run_numpy(mat: np.ndarray) -> np.ndarray:
        # brute force, independent of the native fold; defined here so it ships by value
        best = np.zeros(len(mat), dtype=np.int32)
        cur = np.zeros(len(mat), dtype=np.int32)
        for k in range(mat.shape[1]):
            od = np.isin(mat[:, k], (1, 2))
            cur = np.where(od, cur + 1, 0)
            best = np.maximum(best, cur)
        return best

    from lendfeat.sources.loans import loans

    lo = loans(spark, "/root/testdata/sf0.001")
    roles = ColumnRoles.from_schema(lo.schema)
    sh = lo.withColumns(H.shifted_status(roles.status, roles.shifted))
    out = sh.select("id", "rn", H.longest_overdue_run(roles.status).alias("native"),
                    row_function(longest_run_numpy, "int", roles.status).alias("udf"))
    assert out.where("native != udf").count() == 0
    assert out.count() == lo.count()


def test_chunked_apply(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS v")
    out = chunked_apply(df, lambda p: p.assign(w=p.v * 2), "id long, v long, w long")
    assert out.where("w != v * 2").count() == 0 and out.count() == 1000


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 150
    assert df.columns[0] == "id" and "has_loans" in df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 40


def test_rewritten_orders_are_derived_again(spark, tmp_path):
    from lendfeat.sources.loans import loans

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    path = str(tmp_path / "orders.parquet")
    orders.where("o_orderkey % 2 = 0").write.parquet(path)
    half = loans(spark, str(tmp_path)).count()
    assert loans(spark, str(tmp_path)).inputFiles() == loans(spark, str(tmp_path)).inputFiles()  # written once
    orders.write.mode("overwrite").parquet(path)
    assert half < loans(spark, str(tmp_path)).count() == orders.count()

"""Cramer's V, chi-square, Fisher score, value counts: known answers and properties."""

import pytest
from pyspark.sql import functions as F

from lendfeat.operators import profile as P


def _rows_from_table(table):
    rows = []
    for i, line in enumerate(table):
        for j, n in enumerate(line):
            rows.extend([(i, j)] * n)
    return rows


# (table, chi2, V) from FIXTURES.md
CASES = [
    ([[40, 10], [10, 40]], 33.64, 0.574133),
    ([[50, 0], [0, 50]], 96.04, 0.979794),
    ([[10, 20], [30, 40]], 0.446429, 0.0),
    ([[20, 0, 0], [0, 30, 0], [0, 0, 50]], 200.0, 1.0),
    ([[30, 5, 5], [5, 30, 25]], 46.924603, 0.673518),
    ([[60, 40]], 0.0, 0.0),
]


@pytest.mark.parametrize("table,chi2,v", CASES)
def test_cramers_v_known(spark, table, chi2, v):
    df = spark.createDataFrame(_rows_from_table(table), "x int, y int")
    m = P.association_matrix(df, ["x", "y"])
    r = m.where((F.col("col_x") == "x") & (F.col("col_y") == "y")).first()
    assert r["chi2"] == pytest.approx(chi2, abs=1e-5)
    assert r["v"] == pytest.approx(v, abs=1e-6)


def test_association_properties(spark):
    from lendfeat.sources.loans import loans

    lo = loans(spark, "/root/testdata/sf0.001")
    cols = ["pre_cat_a", "enc_cat_b", "is_zero_loans5", "is_zero_loans530", "enc_paym_0", "enc_paym_11"]
    rows = P.association_matrix(lo, cols).collect()
    assert len(rows) == len(cols) ** 2
    v = {(r["col_x"], r["col_y"]): r["v"] for r in rows}
    for (a, b), val in v.items():
        assert 0.0 <= val <= 1.0 + 1e-12
        assert val == pytest.approx(v[(b, a)])


def test_cooccurrence_matches_groupby(spark):
    from lendfeat.sources.loans import loans

    lo = loans(spark, "/root/testdata/sf0.001")
    cells = P.cooccurrence_cells(lo, ["pre_cat_a", "enc_cat_b"]).where(
        (F.col("cx") == "pre_cat_a") & (F.col("cy") == "enc_cat_b"))
    got = {(int(r["vx"]), int(r["vy"])): r["n"] for r in cells.collect()}
    want = {(r["pre_cat_a"], r["enc_cat_b"]): r["n"] for r in P.contingency(lo, "pre_cat_a", "enc_cat_b").collect()}
    assert got == want


def test_nulls_drop_out_of_a_pair(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 2), (None, 2), (2, 2), (1, 1)], "x int, y int")
    m = P.association_matrix(df, ["x", "y"])
    r = m.where((F.col("col_x") == "x") & (F.col("col_y") == "y")).first()
    assert r["n"] == 4


def test_fisher_known(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (3, 1), (4, 1), (5, 1), (7, 1)][:6], "f int, target int")
    r = P.fisher_scores(df, ["f"], "target").first()
    assert r["score"] == pytest.approx(1.5)


def test_fisher_constant_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 0)], "f int, target int")
    assert P.fisher_scores(df, ["f"], "target").first()["score"] is None


def test_value_counts_and_levels(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 5), (3, 6)], "a int, b int")
    vc = {(r["column"], r["value"]): r["n"] for r in P.value_counts(df, ["a", "b"]).collect()}
    assert vc == {("a", 1): 2, ("a", 2): 1, ("a", 3): 1, ("b", 5): 2, ("b", 6): 1}
    assert P.learn_levels(df, ["a", "b"]) == {"a": [1, 2, 3], "b": [5, 6]}
    with pytest.raises(ValueError):
        P.learn_levels(df, ["a", "b"], max_levels=2)


def test_value_count_matrix_keeps_missing_as_null(spark):
    df = spark.createDataFrame([(0, 3), (0, 3), (1, 3)], "a int, b int")
    got = {r["column"]: r for r in P.value_count_matrix(df, ["a", "b"]).collect()}
    assert got["a"]["code_0"] == 2 and got["a"]["code_1"] == 1 and got["a"]["code_3"] is None
    assert got["b"]["code_3"] == 3 and got["b"]["code_0"] is None


def test_class_ratio_directions(spark):
    df = spark.createDataFrame([(0, True), (0, False), (0, True), (1, True)], "t int, s boolean")
    r = P.class_ratio(df, "t", F.col("s")).first()
    assert r["ratio_0_to_1"] == 3.0 and r["subset_ratio_1_to_0"] == 0.5


def test_association_band_selects_strong_pairs(spark):
    # a and b nearly identical (V in the band), c independent of both
    rows = [(i % 3, (i % 3) if i % 20 else (i + 1) % 3, (i // 3) % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    m = P.association_matrix(df, ["a", "b", "c"])
    band = {(r["col_x"], r["col_y"]) for r in P.association_band(m).collect()}
    assert ("a", "b") in band and ("b", "a") in band
    # c only meets itself (a 0/1 column's self-V is just under 1 after the 2x2 correction)
    assert not band & {("a", "c"), ("c", "a"), ("b", "c"), ("c", "b")}
    v_ab = m.where("col_x = 'a' AND col_y = 'b'").first()["v"]
    assert 0.7 < v_ab <= 0.999


def test_fisher_by_key_equals_row_grain(spark):
    from lendfeat.sources.loans import loans, targets

    lo = loans(spark, "/root/testdata/sf0.001")
    tg = targets(spark, "/root/testdata/sf0.001").withColumnRenamed("flag", "target")
    feats = [c for c in lo.columns if c != "id"]
    a = {r["feature"]: (r["score"], r["rank"]) for r in P.fisher_scores_by_key(lo, feats, "id", tg, "target").collect()}
    b = {r["feature"]: (r["score"], r["rank"]) for r in P.fisher_scores(lo.join(tg, "id", "left"), feats, "target").collect()}
    assert a.keys() == b.keys()
    for f in a:
        if b[f][0] is None:
            assert a[f][0] is None
        else:
            assert a[f][0] == pytest.approx(b[f][0], rel=1e-9)


def test_association_any_levels_and_partitions(spark):
    # 6,000 levels in one column, one value pair of which a third of the rows hold
    rows = spark.range(9000).selectExpr("IF(id < 3000, 0, id - 2999) AS a", "IF(id < 3000, 0, id % 97) AS b",
                                        "IF(id % 10 = 0, NULL, id % 3) AS c")
    want = None
    for parts, cells in ((1, P.MAX_CELLS), (8, P.MAX_CELLS), (3, 50)):  # 50: every batch is yielded at once
        m = P.association_matrix(rows.repartition(parts), ["a", "b", "c"], max_cells=cells)
        got = {(r["col_x"], r["col_y"]): (r["n"], r["r"], r["k"], round(r["chi2"], 6), round(r["v"], 9)) for r in m.collect()}
        want = want or got
        assert got == want
    assert want["a", "b"][:3] == (9000, 6001, 97) and want["a", "c"][0] == 8100


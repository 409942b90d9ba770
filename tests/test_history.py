"""C1-C3 on hand-made status vectors (known answers) and NULL handling."""

import pytest
from pyspark.sql import functions as F

from lendfeat.functions import history as H

STATUS = [f"enc_paym_{k}" for k in range(25)]

# (vector, longest run, fraction, history length)
CASES = [
    ([3] * 25, 0, 0.0, 0),
    ([0] + [3] * 24, 0, 0.0, 0),
    ([1, 2, 1, 0, 2] + [3] * 20, 3, 0.8, 4),
    ([0, 1, 3, 1, 1, 2] + [3] * 18 + [0], 3, 4 / 6, 24),
    ([2] + [3] * 23 + [1], 1, 1.0, 24),
    ([1] * 25, 25, 1.0, 24),
]


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, *vec) for i, (vec, *_rest) in enumerate(CASES)]
    return spark.createDataFrame(rows, ["case"] + STATUS)


def test_status_features_known_answers(vectors):
    out = vectors.select("case", *[c.alias(n) for n, c in H.status_features(STATUS).items()])
    got = {r["case"]: r for r in out.collect()}
    for i, (_vec, run, frac, length) in enumerate(CASES):
        assert got[i]["num_loan_months"] == run
        assert got[i]["frac_loan_months"] == pytest.approx(frac)
        assert got[i]["credit_history_length"] == length


def test_shift_only_feeds_features(spark):
    # raw 4 in month 11 is code 3 after the shift: inactive, not overdue
    vec = [0] * 25
    vec[11] = 4
    df = spark.createDataFrame([tuple(vec)], STATUS)
    shifted = H.status_vector(STATUS, ("enc_paym_11",))
    r = df.select(H.overdue_fraction(shifted).alias("f"), H.credit_history_length(shifted).alias("l")).first()
    assert r["f"] == 0.0 and r["l"] == 24
    vec[24] = 3
    df = spark.createDataFrame([tuple(vec)], STATUS)
    r = df.select(H.credit_history_length(shifted).alias("l")).first()
    assert r["l"] == 23


def test_null_status_is_active_not_overdue(spark):
    vec = [3] * 25
    vec[5] = None
    vec[4] = 1
    vec[6] = 2
    df = spark.createDataFrame([tuple(vec)], "struct<" + ",".join(f"{c}:int" for c in STATUS) + ">")
    r = df.select(*[c.alias(n) for n, c in H.status_features(STATUS).items()]).first()
    assert r["credit_history_length"] == 6
    assert r["num_loan_months"] == 1  # NULL breaks the run
    assert r["frac_loan_months"] == pytest.approx(2 / 3)


def test_no_python_udf_in_plan(vectors):
    plan = vectors.select(*H.status_features(STATUS).values())._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan

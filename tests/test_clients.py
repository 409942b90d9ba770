"""Client features (D3): known aggregate, has_loans modes, train/serve alignment, persistence."""

from pyspark.sql import functions as F

from lendfeat.operators.clients import ClientFeatures, ClientFeaturesModel
from lendfeat.roles import EXCLUDED_COLS, FLAG_COLS

STATUS = [f"enc_paym_{k}" for k in range(25)]
COLS = ["id", "rn", "pre_cat_a", *EXCLUDED_COLS, *FLAG_COLS, *STATUS]


def _loan(id_, rn, cat, flags=None, status=None):
    flags = flags or {}
    status = status or {}
    vals = {"id": id_, "rn": rn, "pre_cat_a": cat, **{c: 0 for c in EXCLUDED_COLS}}
    vals.update({f: flags.get(f, 1) for f in FLAG_COLS})
    vals.update({s: status.get(s, 4 if s in ("enc_paym_11", "enc_paym_20", "enc_paym_24") else 3) for s in STATUS})
    return tuple(vals[c] for c in COLS)


def _frame(spark, rows):
    schema = ", ".join(f"{c} {'bigint' if c in ('id', 'rn') else 'int'}" for c in COLS)
    return spark.createDataFrame(rows, schema)


def test_known_client_aggregate(spark):
    rows = [_loan(7, 1, 3, {"is_zero_loans5": 0}, {"enc_paym_11": 4}),
            _loan(7, 2, 5, {"is_zero_loans5": 0}, {"enc_paym_11": 1})]
    df = _frame(spark, rows)
    r = ClientFeatures().fit(df).transform(df).first()
    assert r["rn_max"] == 2 and r["has_loans"] == 1
    assert r["is_zero_loans5"] == 0.0 and r["is_zero_loans530"] == 1.0
    assert r["pre_cat_a_3"] == 0.5 and r["pre_cat_a_5"] == 0.5
    # encoded on raw codes, features on shifted ones (raw 1 -> 0 is paid, active)
    assert r["enc_paym_11_4"] == 0.5 and r["enc_paym_11_1"] == 0.5
    assert r["credit_history_length_max"] == 11
    assert r["num_loan_months_max"] == 0


def test_has_loans_modes(spark):
    rows = [_loan(1, 1, 1, {"is_zero_loans5": 0}), _loan(1, 2, 1, {"is_zero_loans5": 1})]
    df = _frame(spark, rows)
    assert ClientFeatures().fit(df).transform(df).first()["has_loans"] == 0
    assert ClientFeatures(hasLoansMode="any_loan").fit(df).transform(df).first()["has_loans"] == 1


def test_rn_max_zero_gives_null_not_error(spark):
    df = _frame(spark, [_loan(3, 0, 1)])
    r = ClientFeatures().fit(df).transform(df).first()
    assert r["rn_max"] == 0 and r["is_zero_loans5"] is None


def test_unseen_and_missing_levels(spark):
    train = _frame(spark, [_loan(1, 1, 1), _loan(2, 1, 2)])
    score = _frame(spark, [_loan(3, 1, 2), _loan(3, 2, 9)])  # level 9 unseen, level 1 missing
    model = ClientFeatures().fit(train)
    out = model.transform(score)
    assert out.columns == ["id", *model.getManifest()]
    r = out.first()
    assert r["pre_cat_a_1"] == 0.0 and r["pre_cat_a_2"] == 0.5
    assert "pre_cat_a_9" not in out.columns


def test_manifest_alignment_fills_and_orders(spark):
    df = _frame(spark, [_loan(1, 1, 1)])
    model = ClientFeatures().fit(df).setManifest(["has_loans", "pre_cat_a_7", "rn_max"])
    out = model.transform(df)
    assert out.columns == ["id", "has_loans", "pre_cat_a_7", "rn_max"]
    assert out.first()["pre_cat_a_7"] == 0.0


def test_save_load_same_output(spark, tmp_path):
    df = _frame(spark, [_loan(1, 1, 1), _loan(1, 2, 2), _loan(2, 1, 2)])
    model = ClientFeatures().fit(df)
    path = str(tmp_path / "cf")
    model.write().overwrite().save(path)
    loaded = ClientFeaturesModel.load(path)
    assert loaded.getManifest() == model.getManifest()
    a = sorted(map(tuple, model.transform(df).collect()))
    b = sorted(map(tuple, loaded.transform(df).collect()))
    assert a == b


def test_one_aggregate_one_shuffle(spark):
    from lendfeat.sources.loans import loans

    lo = loans(spark, "/root/testdata/sf0.001")
    out = ClientFeatures().fit(lo).transform(lo)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1
    assert "PythonUDF" not in plan


def test_invariant_to_partitioning(spark):
    from lendfeat.sources.loans import loans

    lo = loans(spark, "/root/testdata/sf0.001")
    model = ClientFeatures().fit(lo)
    a = sorted(map(tuple, model.transform(lo).collect()))
    b = sorted(map(tuple, model.transform(lo.repartition(3).orderBy(F.rand(1))).collect()))
    assert a == b


def test_manifest_file_round_trip(spark, tmp_path):
    from lendfeat.sources.readers import read_manifest, write_manifest

    df = _frame(spark, [_loan(1, 1, 1), _loan(2, 1, 2)])
    model = ClientFeatures().fit(df)
    path = str(tmp_path / "features")
    write_manifest(spark, model.getManifest(), path)
    names = read_manifest(spark, path)
    assert names == model.getManifest()
    assert model.setManifest(names[:3]).transform(df).columns == ["id", *names[:3]]


def test_width_bound(spark):
    import pytest

    df = _frame(spark, [_loan(1, 1, 1), _loan(2, 1, 2)])
    with pytest.raises(ValueError, match="exceed maxFeatures"):
        ClientFeatures(maxFeatures=10).fit(df)

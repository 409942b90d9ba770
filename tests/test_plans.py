"""Plan shape guards for the scale properties the README claims."""

import re

from lendfeat.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cramers_v_reads_the_loans_once(spark):
    p = _plan(Q.QUERIES["cramers_v"](spark, SF))
    assert p.count("FileScan parquet") == 1
    assert p.count("MapInPandas") == 1
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fisher_joins_targets_only_at_client_grain(spark):
    p = _plan(Q.QUERIES["fisher_score"](spark, SF))
    join = min(i for i in (p.find("SortMergeJoin"), p.find("BroadcastHashJoin"), p.find("ShuffledHashJoin")) if i >= 0)
    # the loans reach the join only through a per-client aggregate
    assert re.search(r"HashAggregate\(keys=\[id#\d+L\]", p[join:])


def test_sampling_never_ranks_a_whole_class(spark):
    for name in ("stratified_split", "folds", "downsample_union", "sample_n"):
        p = _plan(Q.QUERIES[name](spark, SF))
        for spec in re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)", p):
            assert "__b" in spec, (name, spec)  # every rank runs inside one hash bucket


def test_wide_features_have_no_python(spark):
    for name in ("client_features", "level_counts", "numeric_max", "relative_features"):
        p = _plan(Q.QUERIES[name](spark, SF))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name

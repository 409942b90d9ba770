"""DuckDB oracle parity for key registered queries on the smallest data (full run: tests/oracle_check.py)."""

import pytest

from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = ["client_features", "cramers_v", "fisher_score", "stratified_split", "folds", "downsample_union",
        "roc_auc_clients", "value_counts", "history_length", "longest_overdue_run"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", KEYS)
def test_matches_oracle(spark, con, name):
    import __spark_entry__ as entry

    res = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert res["ok"], res

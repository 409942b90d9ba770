"""Status-vector features (C1-C4, F4, P9) as native Spark SQL expressions.

Each loan carries its monthly payment statuses as sibling integer columns
``enc_paym_0 .. enc_paym_N``.  The features below read them left to right.
Every feature is one Spark SQL expression (``F.expr``): no Python per row, and
building it costs one call into the JVM instead of one per month and operator.
The sums and ``greatest`` compile; the fold of ``longest_overdue_run`` is a
higher-order function, which Spark interprets.

A status vector is an ordered ``{column name: SQL text}`` map; plain column
lists are accepted too.  NULL handling follows the pandas reading of the data:
a NULL status is "active" (it is not the closed code 3), is not overdue, and
ends an overdue run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendfeat.functions.sqltext import quote
from lendfeat.roles import INACTIVE_CODE, OVERDUE_CODES, status_index

_OVERDUE = ", ".join(str(c) for c in OVERDUE_CODES)


def shifted_status(columns, shifted) -> dict[str, Column]:
    """Expressions that move the mis-coded status columns down by one."""
    return {c: F.expr(f"{quote(c)} - 1") for c in columns if c in set(shifted)}


def status_vector(columns, shifted=()) -> dict[str, str]:
    """Ordered name -> SQL text of the status vector, shifted where needed."""
    moved = set(shifted)
    return {c: (f"({quote(c)} - 1)" if c in moved else quote(c)) for c in columns}


def _vector(status) -> dict[str, str]:
    if isinstance(status, dict):
        return status
    return {c: quote(c) for c in status}


def overdue_sql(v: str) -> str:
    """code in {1, 2}; NULL counts as not overdue."""
    return f"coalesce({v} IN ({_OVERDUE}), false)"


def active_sql(v: str) -> str:
    """code is not 3; NULL counts as active."""
    return f"NOT ({v} <=> {INACTIVE_CODE})"


def equals_sql(v: str, code: int) -> str:
    return f"coalesce({v} = {int(code)}, false)"


def count_sql(predicates) -> str:
    """Row-wise sum of boolean SQL predicates."""
    return "(" + " + ".join(f"CAST({p} AS INT)" for p in predicates) + ")"


def count_overdue(status) -> Column:
    return F.expr(count_sql(overdue_sql(v) for v in _vector(status).values()))


def count_active(status) -> Column:
    return F.expr(count_sql(active_sql(v) for v in _vector(status).values()))


def count_equal(status, code: int) -> Column:
    return F.expr(count_sql(equals_sql(v, code) for v in _vector(status).values()))


def longest_overdue_run(status) -> Column:
    """Length of the longest run of consecutive overdue months.

    Folds the status array once, carrying (current run, best run).  Measured
    faster than the closed form max_k(k - last non-overdue index <= k), whose
    quadratic number of terms outweighs the fold's interpreted lambda."""
    arr = ", ".join(overdue_sql(v) for v in _vector(status).values())
    step = "IF(x, acc.cur + 1, 0)"
    return F.expr(
        f"aggregate(array({arr}), named_struct('cur', 0, 'best', 0), "
        f"(acc, x) -> named_struct('cur', {step}, 'best', greatest(acc.best, {step})), acc -> acc.best)")


def overdue_fraction(status) -> Column:
    """C2 + C4: overdue months over active months; no active month means 24."""
    vec = _vector(status).values()
    overdue = count_sql(overdue_sql(v) for v in vec)
    active = count_sql(active_sql(v) for v in vec)
    return F.expr(f"CAST({overdue} AS DOUBLE) / (CASE WHEN {active} = 0 THEN 24 ELSE {active} END)")


def credit_history_length(status) -> Column:
    """Highest month index whose code is not 3, else 0 (an index, not a count)."""
    parts = ", ".join(f"CASE WHEN {active_sql(v)} THEN {status_index(name)} ELSE 0 END"
                      for name, v in _vector(status).items())
    return F.expr(f"greatest({parts}, 0)" if parts else "0")


def status_features(status) -> dict[str, Column]:
    """The three per-loan features, keyed by output name."""
    return {
        "credit_history_length": credit_history_length(status),
        "num_loan_months": longest_overdue_run(status),
        "frac_loan_months": overdue_fraction(status),
    }

"""SQL text of the derived loan view and targets, for the DuckDB oracle.

Mirrors ``lendfeat.sources.loans`` in plain SQL over the ``orders`` view so the
oracle derives its input independently of Spark.
"""

from __future__ import annotations

from lendfeat.roles import FLAG_COLS
from lendfeat.sources.loans import N_STATUS, SHIFTED_MONTHS

STATUS_COLS = [f"enc_paym_{k}" for k in range(N_STATUS)]


def _status_sql(k: int) -> str:
    x = f"((o_orderkey*{k + 3} + o_custkey*7 + {k * k}) % 11)"
    shift = 1 if k in SHIFTED_MONTHS else 0
    return (f"CAST((CASE WHEN {k} > o_orderkey % 26 - 1 THEN 3 WHEN {x} < 7 THEN 0 "
            f"WHEN {x} < 9 THEN 1 WHEN {x} < 10 THEN 2 ELSE 3 END) + {shift} AS INTEGER) AS enc_paym_{k}")


def loans_sql() -> str:
    flags = ",\n    ".join(
        f"CASE WHEN (o_orderkey*{i + 5} + o_custkey) % {i + 2} = 0 THEN 0 ELSE 1 END AS {f}"
        for i, f in enumerate(FLAG_COLS))
    status = ",\n    ".join(_status_sql(k) for k in range(N_STATUS))
    return f"""SELECT o_custkey AS id,
    CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS rn,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS pre_cat_a,
    CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS enc_cat_b,
    CAST(o_orderkey % 5 AS INTEGER) AS pre_loans6090,
    CAST(o_orderkey % 7 AS INTEGER) AS pre_over2limit,
    CAST(o_orderkey % 3 AS INTEGER) AS enc_loans_account_cur,
    {flags},
    {status}
  FROM orders"""


TARGETS_SQL = """SELECT id,
    CASE WHEN SUM(1 - is_zero_loans90) * 100 >= COUNT(*) * (20 + (id*37 + 11) % 30) THEN 1 ELSE 0 END AS flag
  FROM loans GROUP BY id"""


def with_views(body: str, *, extra: str = "") -> str:
    """Prefix a query with the ``loans`` and ``targets`` common table expressions."""
    more = f",\n{extra}" if extra else ""
    return f"WITH loans AS (\n{loans_sql()}\n),\ntargets AS (\n{TARGETS_SQL}\n){more}\n{body}"

"""Column roles of a loan-history table, decided on the driver from the schema.

The raw table has one row per (client, loan).  A handful of names are fixed;
every other column is reached by rule: status columns by prefix, categorical
columns by exclusion.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# Names the loan data uses.
ID_COL = "id"
SEQ_COL = "rn"
FLAG_COLS = (
    "is_zero_loans5", "is_zero_loans530", "is_zero_loans3060", "is_zero_loans6090", "is_zero_loans90",
    "is_zero_util", "is_zero_over2limit", "is_zero_maxover2limit", "pclose_flag", "fclose_flag",
)
OVERDUE_FLAG_PREFIX = "is_zero_loans"
EXCLUDED_COLS = ("pre_loans6090", "pre_over2limit", "enc_loans_account_cur")
STATUS_PREFIX = "enc_paym"
# Status columns coded one higher than the others (1..4 instead of 0..3).
SHIFTED_STATUS_COLS = ("enc_paym_11", "enc_paym_20", "enc_paym_24")
# Status codes: 0 paid on time, 1 and 2 overdue, 3 closed or not yet open.
OVERDUE_CODES = (1, 2)
INACTIVE_CODE = 3
# Loan-level features derived from the status vector, then reduced by max.
DERIVED_NUMERIC = ("credit_history_length", "num_loan_months", "frac_loan_months")


def with_prefix(columns, prefix: str) -> list[str]:
    """Names starting with ``prefix``, in schema order."""
    return [c for c in columns if c.startswith(prefix)]


def minus(columns, drop) -> list[str]:
    """Order-preserving set difference of column names."""
    drop = set(drop)
    return [c for c in columns if c not in drop]


def status_index(name: str) -> int:
    """The month index at the end of a status column name."""
    m = re.search(r"(\d+)$", name)
    if m is None:
        raise ValueError(f"status column without an index: {name}")
    return int(m.group(1))


@dataclass(frozen=True)
class ColumnRoles:
    """P5: roles assigned by exclusion, as the feature builder needs them."""

    id_col: str = ID_COL
    seq_col: str = SEQ_COL
    flags: tuple[str, ...] = FLAG_COLS
    excluded: tuple[str, ...] = EXCLUDED_COLS
    status: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    shifted: tuple[str, ...] = field(default=SHIFTED_STATUS_COLS)

    @classmethod
    def from_columns(cls, columns, *, id_col=ID_COL, seq_col=SEQ_COL, flags=FLAG_COLS,
                     excluded=EXCLUDED_COLS, status_prefix=STATUS_PREFIX, shifted=SHIFTED_STATUS_COLS,
                     ignore=()) -> "ColumnRoles":
        columns = [c for c in columns if c not in set(ignore)]
        status = with_prefix(columns, status_prefix)
        categorical = minus(columns, [id_col, seq_col, *flags, *excluded])
        return cls(
            id_col=id_col,
            seq_col=seq_col,
            flags=tuple(c for c in flags if c in columns),
            excluded=tuple(excluded),
            status=tuple(status),
            categorical=tuple(categorical),
            shifted=tuple(c for c in shifted if c in status),
        )

    @classmethod
    def from_schema(cls, schema: StructType, **kw) -> "ColumnRoles":
        return cls.from_columns(schema.fieldNames(), **kw)

    @property
    def overdue_flags(self) -> list[str]:
        return with_prefix(self.flags, OVERDUE_FLAG_PREFIX)

    @property
    def numeric(self) -> list[str]:
        return [self.seq_col, *DERIVED_NUMERIC]

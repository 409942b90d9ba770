"""Extension points for user row functions (D1, D2), Arrow-batched.

The built-in features never use these (they are native expressions); they
exist for a user's own function over a block of columns, the place where the
reference calls ``DataFrame.apply(f, axis=1)`` or applies it chunk by chunk.
Both run vectorised on Arrow batches: the function sees a 2-D numpy array of a
whole batch, never one row at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendfeat.roles import INACTIVE_CODE, OVERDUE_CODES, status_index


def row_function(fn: Callable[[np.ndarray], np.ndarray], return_type: str, cols) -> Column:
    """``fn`` maps a (rows x len(cols)) array to one value per row."""

    @F.pandas_udf(return_type)
    def apply(*columns: pd.Series) -> pd.Series:
        if len(columns[0]) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(fn(np.column_stack([c.to_numpy() for c in columns])))

    return apply(*[F.col(c) for c in cols])


def chunked_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` runs on each Arrow batch of every partition (batch size is the
    session's ``spark.sql.execution.arrow.maxRecordsPerBatch``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def register_iterator(spark: SparkSession, name: str, make: Callable[[], Callable[[pa.Array], pa.Array]], return_type: str) -> None:
    """D1 as a SQL function that keeps state over a partition.

    ``make`` is called once for each task and returns the function of an Arrow batch (one array in, one of equal
    length out); what that function remembers lives as long as the task, and is gone when the task is
    recomputed elsewhere: a result must not depend on it."""

    @F.arrow_udf(return_type)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = make()
        for batch in batches:
            yield fn(batch)

    spark.udf.register(name, apply)


def partition_apply(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """D2 with state over a partition: ``make`` as in ``register_iterator``, its function maps a whole record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)


class StatusMemo:
    """C1 to C3 of status vectors (lists of codes, NULL as -1 or None), with a memory of vectors met before.

    ``names`` are the status columns in the vector's order.  Loans repeat few vectors, so most rows of a
    partition are one look-up; the memory starts anew beyond ``most`` vectors."""

    TYPE = "struct<credit_history_length:int,num_loan_months:int,frac_loan_months:double>"

    def __init__(self, names, most: int = 200_000):
        self.index = np.array([status_index(n) for n in names], np.int64)
        self.most, self.known = most, {}

    def features(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The three features of a (vectors x months) array."""
        overdue, active = np.isin(codes, OVERDUE_CODES), codes != INACTIVE_CODE
        run = longest = np.zeros(len(codes), np.int64)
        for month in overdue.T:
            run = np.where(month, run + 1, 0)
            longest = np.maximum(longest, run)
        history = np.where(active, self.index, 0).max(axis=1, initial=0)
        n_active = active.sum(1)
        return history, longest, overdue.sum(1) / np.where(n_active == 0, 24, n_active)

    def __call__(self, vectors: pa.Array) -> pa.Array:
        codes = vectors.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int8).reshape(len(vectors), -1)
        keys = [row.tobytes() for row in codes]
        if len(self.known) > self.most:
            self.known = {}
        new = {k: i for i, k in enumerate(keys) if k not in self.known}
        if new:
            self.known.update(zip(new, zip(*(x.tolist() for x in self.features(codes[list(new.values())])))))
        columns = list(zip(*(self.known[k] for k in keys))) or [[]] * 3
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.float64()))]
        return pa.StructArray.from_arrays(arrays, ["credit_history_length", "num_loan_months", "frac_loan_months"])

"""A stated query set against all vectors, in blocks (tiles)."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE_BYTES = 48 << 20
CANDIDATES, QUERIES = 16384, 4096


def finite(vector: str) -> Column:
    return F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))), F.lit(True))


def one_each(vectors: DataFrame) -> DataFrame:
    """(id, vec): of rows that share an id, the smallest vector."""
    return vectors.where("id is not null").groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))


def tiles(vectors: DataFrame, queries: DataFrame, run: Callable[[tuple, pa.Table], pa.Table], schema: str) -> DataFrame:
    """run() over every tile of one dimension: a block of candidates and a block of queries.

    vectors: (id, dim, vec); queries: the same and, if any, tau.  Blocks are dealt evenly whatever the ids are.
    """
    size = vectors.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    wide = max(1, TILE_BYTES // (8 * max(1, size["dim"] or 1)))
    asked = queries.count()
    c_blocks, q_blocks = max(1, -(-size["n"] // min(CANDIDATES, wide))), max(1, -(-asked // min(QUERIES, wide)))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        mine = df.withColumn(own, F.pmod(F.xxhash64("id", F.lit(own)), F.lit(n)).cast("int"))
        return mine.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    tau = "tau" if "tau" in queries.columns else F.lit(None).cast("bigint").alias("tau")
    both = dealt(vectors.select("id", "dim", "vec", F.lit(None).cast("bigint").alias("tau"), F.lit(False).alias("asks")), "c_block", c_blocks, "q_block", q_blocks).unionByName(
        dealt(queries.select("id", "dim", "vec", tau, F.lit(True).alias("asks")), "q_block", q_blocks, "c_block", c_blocks)
    )
    return both.groupBy("c_block", "q_block", "dim").applyInArrow(run, schema)


def sides(table: pa.Table, dtype: type) -> tuple[pa.Table, np.ndarray, pa.Table, np.ndarray]:
    """Queries and candidates by ascending id, with their vectors."""
    out = []
    for asks in (True, False):
        t = table.filter(pc.equal(table["asks"], asks)).sort_by("id")
        values = t["vec"].combine_chunks()
        values = values.flatten().to_numpy(zero_copy_only=False).astype(dtype)
        out += [t, values.reshape(len(t), -1) if len(t) else values.reshape(0, 0)]
    return tuple(out)


def best(score: np.ndarray, row: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k best (score falling, then id), rows ascending."""
    order = np.lexsort((ids, -score, row))
    start = np.searchsorted(row[order], row[order])
    return order[np.arange(len(order)) - start < k]


def merged(lists: DataFrame, k: int, score: str) -> DataFrame:
    """(query_id, rank, vec_id, score) from the tiles' sorted lists (query_id, vec_id, score), merged by heaps."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(query, held):
            top = heapq.nsmallest(k, heapq.merge(*held))
            return [(query, i + 1, v, -s) for i, (s, v) in enumerate(top)]

        query, held = None, []
        for batch in batches:
            rows = []
            for q, ids, scores in zip(*(batch[c].to_pylist() for c in ("query_id", "vec_id", "score"))):
                if q != query and held:
                    rows += close(query, held)
                    held = []
                query = q
                held.append([(-s, v) for s, v in zip(scores, ids)])
            yield out(rows)
        if held:
            yield out(close(query, held))

    def out(rows):
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64() if score == "double" else pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "rank", "vec_id", "score"])

    sorted_lists = lists.repartition("query_id").sortWithinPartitions("query_id")
    return sorted_lists.mapInArrow(merge, f"query_id long, rank int, vec_id long, score {score}")


def as_lists(queries: np.ndarray, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.Table:
    """A list row per query from (row, id, score) sorted by row; queries without any are left out."""
    at = np.flatnonzero(np.diff(row, prepend=-1))
    ends = pa.array(np.append(at, len(row)).astype(np.int32))
    return pa.table({"query_id": pa.array(queries[row[at]]), "vec_id": pa.ListArray.from_arrays(ends, pa.array(ids)), "score": pa.ListArray.from_arrays(ends, pa.array(scores))})

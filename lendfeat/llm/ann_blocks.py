"""Nearest neighbours by a block matrix join over int8 tiles.

A tile multiplies a block of queries with a block of candidates in int8; each vector is
x = s q + r with int8 q, so the tile's inner product s s' q.q' is off by at most
|r| |x'| + |s q| |r'|.  A candidate survives if its upper bound reaches the k-th best lower
bound; survivors are recomputed in double precision, and the tiles' lists are merged by heaps.

The result is exact: all candidates are looked at, every bound is proven.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do rows without id; of rows that share an id the smallest vector counts;
vectors of different length aren't compared; equal scores go to the smaller id.  Empty tables
and queries without candidates give no rows.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendfeat.llm import _tiles as B
from lendfeat.llm._store import settle

LEVELS = 127
EXACT = 1024  # int8 products of so many components stay exact in float32
ROWS = 256


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 parts, scale, error norm, norm, norm of the quantised vector."""
    scale = np.abs(x).max(1) / LEVELS
    with np.errstate(divide="ignore", invalid="ignore"):
        q = np.nan_to_num(np.rint(x / scale[:, None])).astype(np.int8)
    kept = q * scale[:, None]
    norm = lambda a: np.sqrt((a * a).sum(1))
    return q, scale, norm(x - kept), norm(x), norm(kept)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    total = np.zeros((len(q), len(c)))
    for d in range(0, q.shape[1], EXACT):
        total += q[:, d : d + EXACT].astype(np.float32) @ c[:, d : d + EXACT].astype(np.float32).T
    return total


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, components added in order (the same for equal vectors)."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def search(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each query's k largest inner products among the other vectors: query_id, rank, vec_id, score."""
    used = vectors.where(B.finite(vector)).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), queries.alias("asks"))
    asks = used.where("asks").select("id").distinct()
    used = settle(B.one_each(used.where(F.exists("vec", lambda x: x != 0))), "ann-vectors")
    asked = settle(used.join(asks, "id", "left_semi"), "ann-queries")

    def tile(key: tuple, table: pa.Table) -> pa.Table:
        qt, qx, ct, cx = B.sides(table, np.float64)
        rows, ids, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        q_ids, c_ids = qt["id"].to_numpy(), ct["id"].to_numpy()
        if len(q_ids) and len(c_ids):
            cq, c_scale, c_err, c_norm, _ = _quantised(cx)
            for at in range(0, len(q_ids), ROWS):
                x = qx[at : at + ROWS]
                q, scale, err, _, kept = _quantised(x)
                near = _products(q, cq) * scale[:, None] * c_scale
                own = np.searchsorted(c_ids, q_ids[at : at + ROWS]).clip(0, len(c_ids) - 1)
                hit = np.flatnonzero(c_ids[own] == q_ids[at : at + ROWS])
                near[hit, own[hit]] = -np.inf
                bound = np.column_stack([err, kept]) @ np.vstack([c_norm, c_err])
                bound += 1e-9 * np.outer(err + kept, c_norm)  # rounding of the figures themselves
                lower = near - bound
                cut = np.partition(lower, -k, axis=1)[:, -k] if len(c_ids) > k else np.full(len(x), -np.inf)
                r, c = np.nonzero((near + bound >= cut[:, None]) & (near > -np.inf))
                score = _exact(x[r], cx[c])
                top = B.best(score, r, c_ids[c], k)
                rows.append(r[top] + at), ids.append(c_ids[c[top]]), scores.append(score[top])
        return B.as_lists(q_ids, np.concatenate(rows), np.concatenate(ids), np.concatenate(scores))

    found = B.tiles(used, asked, tile, "query_id long, vec_id array<long>, score array<double>")
    return B.merged(found, k, "double")

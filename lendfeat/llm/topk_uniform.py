"""Exact top-k inner products by the three-phase uniform threshold.

A vector's components are dealt to ``lists`` lists; a candidate's score is the sum of its
partial scores.  A task holds one list of one block of candidates and one block of queries.

Phase 1 gathers the ``depth`` best entries of every list and resolves these candidates alone;
a query's (k+1)-th best total among them is its safe cutoff tau: so many candidates reach it.
Phase 2 sends each query's tau to the tasks of its lists, which hand out their entries of at
least tau / lists: a candidate below that in every list stays below tau.  Phase 3 asks the
lists for the partial scores that the collected candidates still lack, and no others, and
keeps the highest totals.  What is shuffled besides the vectors are gathered and collected
entries; ``phases`` returns them too, so that they can be counted.

Equal vectors are one candidate, with the k + 1 smallest of their ids (no other of them can be
among k, even if the query is one itself), so a group of copies is one entry.

Defined results: vectors that are null or hold null or non-finite components take no part,
nor do rows without id; zero vectors do; empty ones score nothing and are left out; of rows
that share an id the smallest vector counts; vectors of different length aren't compared;
equal scores go to the smaller id.  Scores are exact while they fit 63 bits.  Empty tables give
no rows.  Extra columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendfeat.llm import _tiles as B
from lendfeat.llm._store import settle

#: With more lists tau / lists falls and more entries pass it.
LISTS = 2
DEPTH = 64
ROWS = 128
_TILE = ["list", "c_block", "q_block", "dim"]
_ENTRY = "query_id long, id long, ids array<long>, dim int, list int, partial long"


class Phases(NamedTuple):
    gathered: DataFrame  # (query_id, id, ids, dim, list, partial)
    collected: DataFrame  # the same
    result: DataFrame  # (query_id, rank, vec_id, score)


def _partial(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer products of all rows of x and y; in doubles where these are exact."""
    largest = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    if largest < 2**53:
        return np.rint(x.astype(float) @ y.astype(float).T).astype(np.int64)
    return x @ y.T


def _sides(table: pa.Table) -> tuple[pa.Table, np.ndarray, pa.Table, np.ndarray]:
    return B.sides(table.rename_columns(["vec" if c == "part" else c for c in table.column_names]), np.int64)


def _entries(key: tuple, table: pa.Table, choose) -> pa.Table:
    """The entries of a tile that choose(partial scores, first query) marks."""
    qt, qx, ct, cx = _sides(table)
    rows, cols, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(qt) and len(ct):
        for at in range(0, len(qt), ROWS):
            partial = _partial(qx[at : at + ROWS], cx)
            r, c = np.nonzero(choose(partial, qt["tau"][at : at + ROWS]))
            rows, cols, scores = [*rows, r + at], [*cols, c], [*scores, partial[r, c]]
    r, c = pa.array(np.concatenate(rows)), pa.array(np.concatenate(cols))
    flat = {"dim": key[3].as_py(), "list": key[0].as_py()}
    same = {name: pa.array(np.full(len(r), value, np.int32)) for name, value in flat.items()}
    return pa.table({"query_id": qt["id"].take(r), "id": ct["id"].take(c), "ids": ct["ids"].take(c), **same, "partial": pa.array(np.concatenate(scores))})


def _resolve(key: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
    """The partial scores of the asked (query, candidate) pairs of a tile."""
    qt, qx, ct, cx = _sides(table)
    r, c = (np.searchsorted(t["id"].to_numpy(), asked[name].to_numpy()) for t, name in ((qt, "query_id"), (ct, "id")))
    scores = np.zeros(len(r), np.int64)
    for at in range(0, len(r), 1 << 16):
        part = slice(at, at + (1 << 16))
        scores[part] = np.einsum("ij,ij->i", qx[r[part]], cx[c[part]])
    return pa.table({"query_id": asked["query_id"], "id": asked["id"], "ids": asked["ids"], "partial": pa.array(scores)})


def phases(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 256.0, lists: int = LISTS, depth: int = DEPTH) -> Phases:
    """See ``search``; with the entries gathered in phase 1 and collected in phase 2."""
    depth = max(depth, k + 1)
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale))
    used = vectors.where(B.finite(vector)).select(F.col(vec_id).cast("long").alias("id"), whole.alias("vec"), queries.alias("asks"))
    asks = used.where("asks").select("id").distinct()
    used = settle(B.one_each(used.where(F.size("vec") > 0)), "topk-vectors")
    asked = settle(used.join(asks, "id", "left_semi"), "topk-queries")
    smallest = used.withColumn("n", F.row_number().over(Window.partitionBy("vec", "dim").orderBy("id"))).where(F.col("n") <= k + 1)
    distinct = smallest.groupBy("vec", "dim").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = settle(distinct, "topk-candidates")

    size = distinct.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    wide = max(1, B.TILE_BYTES // (8 * max(1, size["dim"] or 1)))
    blocks = {"c_block": max(1, -(-size["n"] // min(B.CANDIDATES, wide))), "q_block": max(1, -(-asked.count() // min(B.QUERIES, wide)))}

    def block(name: str, key: str) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(name)), F.lit(blocks[name])).cast("int").alias(name)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """One row per list and per block of the other side, with the list's components."""
        df = df.withColumn("lists", F.least(F.lit(lists), F.col("dim"))).withColumn("list", F.explode(F.expr("sequence(0, lists - 1)")))
        first = F.expr("cast(list * dim div lists as int)")
        part = F.slice("vec", first + 1, F.expr("cast((list + 1) * dim div lists as int)") - first).alias("part")
        return df.select("id", "dim", "list", "ids", "tau", "asks", part, block(own, "id"), F.explode(F.sequence(F.lit(0), F.lit(blocks[other] - 1))).alias(other))

    def tiles(queries: DataFrame):
        candidates = distinct.withColumns({"tau": F.lit(None).cast("long"), "asks": F.lit(False)})
        queries = queries.withColumns({"ids": F.lit(None).cast("array<long>"), "asks": F.lit(True)})
        return dealt(candidates, "c_block", "q_block").unionByName(dealt(queries, "q_block", "c_block")).groupBy(*_TILE)

    def totals(entries: DataFrame, name: str) -> DataFrame:
        """(query_id, id, ids, score, rank): each query's k + 1 best candidates among the entries, resolved."""
        pair = ["query_id", "id", "ids"]
        seen = entries.groupBy(*pair, "dim").agg(F.sum("partial").alias("partial"), F.bit_or(F.expr("shiftleft(1L, list)")).alias("have"))
        seen = settle(seen, name)
        lacking = F.expr(f"filter(sequence(0, least({lists}, dim) - 1), l -> shiftright(have, l) & 1L = 0)")
        wanted = seen.select(*pair, "dim", block("q_block", "query_id"), block("c_block", "id"), F.explode(lacking).alias("list"))
        resolved = plain.cogroup(wanted.groupBy(*_TILE)).applyInArrow(_resolve, "query_id long, id long, ids array<long>, partial long")
        total = seen.select(*pair, "partial").unionByName(resolved).groupBy(*pair).agg(F.sum("partial").alias("score"))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return total.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        def highest(partial: np.ndarray, _) -> np.ndarray:
            n = min(depth, partial.shape[1])
            marks = np.zeros(partial.shape, bool)
            np.put_along_axis(marks, np.argpartition(partial, -n, axis=1)[:, -n:], True, 1)
            return marks

        return _entries(key, table, highest)

    def collect(key: tuple, table: pa.Table) -> pa.Table:
        n = min(lists, key[3].as_py())

        def reaching(partial: np.ndarray, tau: pa.ChunkedArray) -> np.ndarray:
            cut = tau.fill_null(np.iinfo(np.int64).min).to_numpy()  # no cutoff: at most k candidates
            return partial >= -(-cut // n)[:, None]

        return _entries(key, table, reaching)

    plain = tiles(asked.withColumn("tau", F.lit(None).cast("long")))
    best = Window.partitionBy("query_id", "list").orderBy(F.desc("partial"), "id")
    gathered = plain.applyInArrow(gather, _ENTRY).withColumn("n", F.row_number().over(best)).where(F.col("n") <= depth).drop("n")
    gathered = settle(gathered, "topk-gathered")
    tau = totals(gathered, "topk-seen").where(F.col("rank") == k + 1).select(F.col("query_id").alias("id"), F.col("score").alias("tau"))
    collected = settle(tiles(settle(asked.join(tau, "id", "left"), "topk-cutoffs")).applyInArrow(collect, _ENTRY), "topk-collected")
    each = totals(collected, "topk-known").select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return Phases(gathered, collected, each.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k))


def search(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 256.0, lists: int = LISTS, depth: int = DEPTH) -> DataFrame:
    """Each query's k highest scores over floor(scale * x) among the other vectors: query_id, rank, vec_id, score."""
    return phases(vectors, queries, k, vec_id, vector, scale, lists, depth).result

"""Column profiling at scale.

All profiles run as distributed aggregates; nothing is collected except the
learned level lists, whose size is checked before they reach the driver.

Cramer's V for every column pair: instead of one crosstab per pair, a
``mapInPandas`` pass numbers the values of each batch and counts the value pairs
of each column pair, emitting only cells that occur.  A ``groupBy(...).sum``
merges tasks.  Work per row is one addition per column pair, memory per task is
bounded by a number of held counts, and no pairs of rows are ever exploded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendfeat.functions.sqltext import literal, quote

# Fixed values of the statistics (Bergsma-Wicher correction and the 2x2 rule).
V_EPSILON = 1e-6
YATES = 0.5
BAND_LOW, BAND_HIGH = 0.7, 0.999
MAX_CELLS = 1 << 21  # counts a co-occurrence task holds before it yields them (16 bytes each and their level names)


# ---------------------------------------------------------------------------
# predicates
# ---------------------------------------------------------------------------

def any_equals(cols, value) -> Column:
    """true when any of ``cols`` equals ``value`` (NULL compares false)."""
    lit = literal(value)
    return F.expr(" OR ".join(f"coalesce({quote(c)} = {lit}, false)" for c in cols))


# ---------------------------------------------------------------------------
# value counts and levels
# ---------------------------------------------------------------------------

def _long(df: DataFrame, cols) -> DataFrame:
    """Unpivot ``cols`` to (column, value); integer columns keep BIGINT values."""
    integral = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in cols)
    vt = "bigint" if integral else "string"
    narrow = df.selectExpr(*[f"CAST({quote(c)} AS {vt}) AS {quote(c)}" for c in cols])
    return narrow.unpivot([], list(cols), "column", "value")


def value_counts(df: DataFrame, cols, ordered: bool = False) -> DataFrame:
    """(column, value, n) for every column at once; NULLs dropped.

    ``ordered`` sorts like the reference's listing: by column, most frequent
    value first (ties by value)."""
    out = (_long(df, cols).where(F.col("value").isNotNull())
           .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return out.orderBy("column", F.col("n").desc(), "value") if ordered else out


def learn_levels(df: DataFrame, cols, max_levels: int = 1000) -> dict[str, list]:
    """Sorted distinct values per column, with a checked bound on what is collected."""
    cols = list(cols)
    if not cols:
        return {}
    cap = max_levels * len(cols)
    rows = (value_counts(df, cols).select("column", "value")
            .limit(cap + 1).collect())
    if len(rows) > cap:
        raise ValueError(f"more than {max_levels} levels in some column; raise maxLevels or drop it")
    found: dict[str, list] = {}
    for r in rows:
        found.setdefault(r["column"], []).append(r["value"])
    for c, vals in found.items():
        if len(vals) > max_levels:
            raise ValueError(f"column {c} has {len(vals)} levels, more than maxLevels={max_levels}")
    return {c: sorted(found[c]) for c in cols if c in found}


def value_count_matrix(df: DataFrame, cols, codes=range(5)) -> DataFrame:
    """One row per column, one count per code; a code never seen stays NULL."""
    codes = list(codes)
    pivoted = (_long(df, cols).groupBy("column")
               .pivot("value", codes).agg(F.count(F.lit(1))))
    return pivoted.select("column", *[
        F.when(F.col(str(v)) > 0, F.col(str(v))).cast("bigint").alias(f"code_{v}") for v in codes])


def contingency(df: DataFrame, x: str, y: str) -> DataFrame:
    """Long crosstab of two columns, rows with a NULL dropped."""
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(x, y).agg(F.count(F.lit(1)).alias("n")))


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def class_ratio(df: DataFrame, label: str, subset: Column | None = None) -> DataFrame:
    """n0/n1 overall and n1/n0 inside ``subset`` (the reference's two directions)."""
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    aggs = [n0.alias("n0"), n1.alias("n1"), F.try_divide(n0.cast("double"), n1).alias("ratio_0_to_1")]
    if subset is not None:
        s0 = F.count_if(subset & (F.col(label) == 0))
        s1 = F.count_if(subset & (F.col(label) == 1))
        aggs += [s0.alias("subset_n0"), s1.alias("subset_n1"),
                 F.try_divide(s1.cast("double"), s0).alias("subset_ratio_1_to_0")]
    return df.agg(*aggs)


# ---------------------------------------------------------------------------
# Cramer's V and chi-square for all column pairs
# ---------------------------------------------------------------------------

def _cooccurrence_fn(cols, max_cells: int):
    """Per task: the counts of every pair of values of every column pair, as (px, vx, py, vy, n), px <= py.

    Values are numbered in order of first sight.  A batch adds one count per value
    pair it holds; beyond ``max_cells`` counts the task yields what it has and
    starts afresh, numbers included, so memory stays bounded for any number of
    levels and the sums over all tasks stay the same."""
    pairs = [(x, y) for x in range(len(cols)) for y in range(x, len(cols))]

    def counts(a, b, la, lb):
        """Codes and count of each pair of values in two columns of a batch (code -1: NULL)."""
        both = (a >= 0) & (b >= 0)
        key = a[both] * lb + b[both]
        if la * lb <= 8 * len(a):
            n = np.bincount(key, minlength=la * lb)
            key = np.flatnonzero(n)
            return key // max(lb, 1), key % max(lb, 1), n[key]
        key, n = np.unique(key, return_counts=True)
        return key // lb, key % lb, n

    def merged(parts):
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate([n for _, n in parts]))
        return [(keys, total)]

    def frames(names, cells):
        for (px, py), parts in cells.items():
            (key, n), = merged(parts)
            yield pd.DataFrame({"px": np.int32(px), "vx": np.array(names[px], object)[key >> 32],
                                "py": np.int32(py), "vy": np.array(names[py], object)[key & 0xFFFFFFFF], "n": n})

    def run(batches):
        ids, names, cells, held = [{} for _ in cols], [[] for _ in cols], {}, 0
        for pdf in batches:
            local, numbers = [], []
            for pos, c in enumerate(cols):
                code, values = pd.factorize(pdf[c])
                for v in values:
                    if v not in ids[pos]:
                        ids[pos][v] = len(names[pos])
                        names[pos].append(v)
                local.append(code.astype(np.int64))
                numbers.append(np.array([ids[pos][v] for v in values], np.int64))
            for px, py in pairs:
                i, j, n = counts(local[px], local[py], len(numbers[px]), len(numbers[py]))
                if len(n):
                    cells.setdefault((px, py), []).append((numbers[px][i] << 32 | numbers[py][j], n))
                    held += len(n)
            if held > max_cells:
                cells = {pair: merged(parts) for pair, parts in cells.items()}
                held = sum(len(parts[0][0]) for parts in cells.values())
                if held > max_cells // 2:
                    yield from frames(names, cells)
                    ids, names, cells, held = [{} for _ in cols], [[] for _ in cols], {}, 0
        yield from frames(names, cells)

    return run


def cooccurrence_cells(df: DataFrame, cols, max_cells: int = MAX_CELLS) -> DataFrame:
    """Contingency cells of every column pair (cx <= cy in column order), one pass.

    Columns: px, cx, vx, py, cy, vy, n (values as strings).  Rows with a NULL in
    either column of a pair simply contribute nothing to that pair.  ``max_cells``
    bounds a task's memory, not the result."""
    cols = list(cols)
    narrow = df.selectExpr(*[f"CAST({quote(c)} AS STRING) AS {quote(c)}" for c in cols])
    cells = (narrow.mapInPandas(_cooccurrence_fn(cols, max_cells),
                                "px int, vx string, py int, vy string, n long")
             .groupBy("px", "vx", "py", "vy").agg(F.sum("n").alias("n")))
    names = "array(" + ", ".join(literal(c) for c in cols) + ")"
    return cells.selectExpr("px", f"element_at({names}, px + 1) AS cx", "vx",
                            "py", f"element_at({names}, py + 1) AS cy", "vy", "n")


def pair_statistics(cells: DataFrame) -> DataFrame:
    """chi2 (with the 2x2 continuity correction) and corrected Cramer's V per pair.

    Input: cells (px, cx, vx, py, cy, vy, n), one contingency table per (cx, cy).
    Output: (px, cx, py, cy, n, r, k, chi2, v).  Margins come from windows and
    one group-by, a linear chain, so the cells (and the pass that made them)
    are computed once."""
    pair = ["px", "cx", "py", "cy"]
    by_row = Window.partitionBy(*pair, "vx")
    by_col = Window.partitionBy(*pair, "vy")
    m = (cells.withColumn("R", F.sum("n").over(by_row)).withColumn("nr", F.count(F.lit(1)).over(by_row))
         .withColumn("C", F.sum("n").over(by_col)).withColumn("nc", F.count(F.lit(1)).over(by_col)))
    st = m.groupBy(*pair).agg(
        F.sum("n").alias("N"),
        F.sum(F.col("n") * F.col("n") / (F.col("R") * F.col("C"))).alias("q"),
        # each row / column margin counted once across its cells
        F.sum(1.0 / (F.col("R") * F.col("nr"))).alias("inv_r"),
        F.sum(1.0 / (F.col("C") * F.col("nc"))).alias("inv_c"),
        # and so its rows and columns, without a distinct count (which would double the cells twice)
        F.round(F.sum(1.0 / F.col("nr"))).cast("bigint").alias("r"),
        F.round(F.sum(1.0 / F.col("nc"))).cast("bigint").alias("k"))
    n, r, k = F.col("N").cast("double"), F.col("r"), F.col("k")
    plain = F.greatest(n * (F.col("q") - 1.0), F.lit(0.0))
    # In a 2x2 table |O - E| is the same in every cell, so the corrected sum
    # needs only the uncorrected value and s = sum(1/E).
    s = n * F.col("inv_r") * F.col("inv_c")
    d = F.sqrt(plain / s)
    yates = F.pow(F.greatest(d - YATES, F.lit(0.0)), 2) * s
    chi2 = (F.when((r == 1) | (k == 1), F.lit(0.0))
            .when((r == 2) & (k == 2), yates).otherwise(plain))
    nm1 = n - 1.0
    phi2c = F.greatest(F.try_divide(F.col("chi2"), n) - F.try_divide((k - 1) * (r - 1), nm1), F.lit(0.0))
    rc0 = r - F.try_divide(F.pow(r - 1, 2), nm1)
    kc0 = k - F.try_divide(F.pow(k - 1, 2), nm1)
    rc = F.when(rc0 == 1.0, rc0 + V_EPSILON).otherwise(rc0)
    kc = F.when(kc0 == 1.0, kc0 + V_EPSILON).otherwise(kc0)
    v = F.sqrt(F.try_divide(phi2c, F.least(kc - 1.0, rc - 1.0)))
    return (st.withColumn("chi2", chi2)
            .select(*pair, F.col("N").alias("n"), "r", "k", "chi2", v.alias("v")))


def mirrored(stats: DataFrame, value_cols) -> DataFrame:
    """Both orders of every pair from the cx <= cy half (the diagonal once), in one pass."""
    value_cols = list(value_cols)
    vals = [F.col(c) for c in value_cols]
    xy = F.struct(F.col("cx").alias("col_x"), F.col("cy").alias("col_y"), *vals)
    yx = F.struct(F.col("cy").alias("col_x"), F.col("cx").alias("col_y"), *vals)
    both = F.when(F.col("px") != F.col("py"), F.array(xy, yx)).otherwise(F.array(xy))
    return stats.select(F.explode(both).alias("e")).select("e.*")


def association_matrix(df: DataFrame, cols, max_cells: int = MAX_CELLS) -> DataFrame:
    """A9 + A10: (col_x, col_y, n, r, k, chi2, v) for all ordered column pairs."""
    stats = pair_statistics(cooccurrence_cells(df, cols, max_cells))
    return mirrored(stats, ["n", "r", "k", "chi2", "v"])


def association_band(matrix: DataFrame, low: float = BAND_LOW, high: float = BAND_HIGH) -> DataFrame:
    """among columns with some V in (low, high], the pairs with V > low.

    The matrix is symmetric, so a column's band membership is the same seen
    from its row or its column: two windows, no self-joins."""
    inb = ((F.col("v") > low) & (F.col("v") <= high)).cast("int")
    marked = (matrix.withColumn("bx", F.max(inb).over(Window.partitionBy("col_x")))
              .withColumn("by", F.max(inb).over(Window.partitionBy("col_y"))))
    return (marked.where((F.col("bx") == 1) & (F.col("by") == 1) & (F.col("v") > low))
            .select("col_x", "col_y", "v"))


# ---------------------------------------------------------------------------
# Fisher score
# ---------------------------------------------------------------------------

def fisher_scores(df: DataFrame, features, label: str) -> DataFrame:
    """sum_c n_c (mu_c - mu)^2 / sum_c n_c var_c per feature, in one pass.

    One aggregate grouped by class (K rows out, partial-aggregated), then the
    K x features table is unpivoted and combined.  ``rank`` 1 = highest score.
    Rows without a label are left out."""
    features = list(features)
    per_class = df.where(F.col(label).isNotNull()).groupBy(label).agg(*[
        F.expr(f"named_struct('n', count({quote(f)}), 'mu', avg({quote(f)}), 'var', var_pop({quote(f)})) AS s{i}")
        for i, f in enumerate(features)])
    structs = ", ".join(f"named_struct('feature', {literal(f)}, 'n', s{i}.n, 'mu', s{i}.mu, 'var', s{i}.var)"
                        for i, f in enumerate(features))
    long = per_class.selectExpr(f"explode(array({structs})) AS s").select("s.*").where(F.col("n") > 0)
    w = Window.partitionBy("feature")
    mu = F.sum(F.col("n") * F.col("mu")).over(w) / F.sum("n").over(w)
    parts = long.withColumn("between", F.col("n") * F.pow(F.col("mu") - mu, 2))
    agg = parts.groupBy("feature").agg(F.sum("between").alias("between"),
                                       F.sum(F.col("n") * F.col("var")).alias("within"))
    score = F.when(F.col("within") > 0, F.col("between") / F.col("within"))
    scored = agg.select("feature", score.alias("score"))
    # The ranked table has one row per feature (a column count), so one window task is fine.
    ranked = Window.orderBy(F.col("score").desc_nulls_last(), F.col("feature"))
    return scored.withColumn("rank", F.row_number().over(ranked).cast("bigint"))


def fisher_scores_by_key(df: DataFrame, features, key: str, labels: DataFrame, label: str) -> DataFrame:
    """A11 when the label lives on another table keyed by ``key`` (one label per client).

    Rows are first reduced per key to (count, mean, variance) of every feature --
    partial aggregation, so a key holding a third of all rows costs one row per
    map task -- and only these per-key rows are joined to the labels (one row per
    key on both sides).  A class's spread is the spread within its keys plus the
    spread of the keys' means, n var = sum n_k var_k + sum n_k (mu_k - mu_c)^2, so
    large values far from zero lose no digits.  Rows without a label are left out.
    The key itself may be a feature.  Same output as ``fisher_scores``."""
    features = list(features)
    aggs = []
    for i, f in enumerate(features):
        x = f"CAST({quote(f)} AS DOUBLE)"
        aggs += [F.expr(f"count({quote(f)}) AS n_{i}"), F.expr(f"avg({x}) AS mu_{i}"), F.expr(f"var_pop({x}) AS var_{i}")]
    flat = df.groupBy(key).agg(*aggs)
    joined = flat.join(labels.where(F.col(label).isNotNull()).select(F.col(key).alias("__key"), label), F.col(key) == F.col("__key"))
    structs = ", ".join(f"named_struct('feature', {literal(f)}, 'n', n_{i}, 'mu', mu_{i}, 'var', var_{i})" for i, f in enumerate(features))
    long = joined.selectExpr(quote(label), f"explode(array({structs})) AS s").select(label, "s.*").where("n > 0")
    # per class and feature: sum n, mean, and the spread around the mean of the keys' means (a shift near the data)
    shift = long.groupBy("feature").agg(F.avg("mu").alias("shift"))
    moved = long.join(F.broadcast(shift), "feature").withColumn("d", F.col("mu") - F.col("shift"))
    per_class = moved.groupBy("feature", label, "shift").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("d")).alias("s1"),
        F.sum(F.col("n") * (F.col("var") + F.col("d") * F.col("d"))).alias("s2"))
    w = Window.partitionBy("feature")
    mu_c, mu = F.col("s1") / F.col("n"), F.sum("s1").over(w) / F.sum("n").over(w)
    parts = per_class.select("feature", (F.col("n") * F.pow(mu_c - mu, 2)).alias("between"),
                             F.greatest(F.col("s2") - F.col("s1") * mu_c, F.lit(0.0)).alias("within"))
    agg = parts.groupBy("feature").agg(F.sum("between").alias("between"), F.sum("within").alias("within"))
    scored = agg.select("feature", F.when(F.col("within") > 0, F.col("between") / F.col("within")).alias("score"))
    ranked = Window.orderBy(F.col("score").desc_nulls_last(), F.col("feature"))
    return scored.withColumn("rank", F.row_number().over(ranked).cast("bigint"))


def class_ratio_by_key(df: DataFrame, key: str, labels: DataFrame, label: str, subset: Column) -> DataFrame:
    """A13 with the label on a per-key table: rows counted per key first, then per class."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"), F.count_if(subset).alias("__sub"))
    j = per_key.join(labels.select(key, label), key, "left")
    y = F.col(label)
    n0 = F.sum(F.when(y == 0, F.col("__rows")).otherwise(F.lit(0)))
    n1 = F.sum(F.when(y == 1, F.col("__rows")).otherwise(F.lit(0)))
    s0 = F.sum(F.when(y == 0, F.col("__sub")).otherwise(F.lit(0)))
    s1 = F.sum(F.when(y == 1, F.col("__sub")).otherwise(F.lit(0)))
    return j.agg(n0.alias("n0"), n1.alias("n1"), F.try_divide(n0.cast("double"), n1).alias("ratio_0_to_1"),
                 s0.alias("subset_n0"), s1.alias("subset_n1"),
                 F.try_divide(s1.cast("double"), s0).alias("subset_ratio_1_to_0"))


def lowest(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """The k smallest scores (NULL last), ties by name."""
    return df.orderBy(F.col(score).asc_nulls_last(), F.col(tie)).limit(k)


def highest(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """The k largest scores, ties by name."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(k)

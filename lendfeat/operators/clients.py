"""Client-level features from loan-level history.

Everything per client is one ``groupBy(id).agg(...)``: flag sums, level counts
and numeric maxima are computed in the same pass (the reference runs one
group-by per category and joins them back).  The status-vector features are
plain projections below that aggregate, so the plan is

    scan (pruned) -> project (status features) -> partial agg -> shuffle on id
    -> final agg -> project (has_loans, ratios, manifest order)

with a single shuffle.  Partial aggregation before the shuffle means a client
with a huge number of loans costs one row per map task, not one hot task.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendfeat.functions.history import status_features, status_vector
from lendfeat.functions.sqltext import literal, quote
from lendfeat.operators.profile import learn_levels
from lendfeat.roles import (DERIVED_NUMERIC, EXCLUDED_COLS, FLAG_COLS, ID_COL, SEQ_COL,
                            SHIFTED_STATUS_COLS, STATUS_PREFIX, ColumnRoles)

# Columns left absolute (not divided by rn_max).
HAS_LOANS = "has_loans"
HAS_LOANS_MODES = ("all_loans", "any_loan")

AGG_FUNCS = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "mean": F.avg,
    "avg": F.avg,
    "count": F.count,
}


def level_name(col: str, level) -> str:
    """Output name of one level's column."""
    return f"{col}_{level}"


def max_name(col: str) -> str:
    """P10: output name of a numeric maximum."""
    return f"{col}_max"


def with_status_features(loans: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Loan rows plus the three status-vector features (computed on shifted codes)."""
    return loans.withColumns(status_features(status_vector(roles.status, roles.shifted)))


def flag_sum_aggs(roles: ColumnRoles) -> list[Column]:
    """A1: per-client sums of the ten 0/1 flags."""
    return [F.expr(f"CAST(sum({quote(c)}) AS BIGINT) AS {quote(c)}") for c in roles.flags]


def level_count_aggs(levels: dict[str, list], shifted=(), shift_first: bool = False) -> list[Column]:
    """A2: per-client count of each learned level, one column per (column, level)."""
    out = []
    for col, lv in levels.items():
        value = f"({quote(col)} - 1)" if (shift_first and col in set(shifted)) else quote(col)
        out.extend(F.expr(f"count_if({value} = {literal(v)}) AS {quote(level_name(col, v))}") for v in lv)
    return out


def numeric_max_aggs(roles: ColumnRoles) -> list[Column]:
    """A3: per-client maxima of rn and the status features."""
    return [F.expr(f"max({quote(c)}) AS {quote(max_name(c))}") for c in roles.numeric]


def has_loans_sql(roles: ColumnRoles, mode: str = "all_loans") -> str:
    """A15, evaluated on the aggregated frame.

    ``all_loans`` (the reference's code): some overdue-flag *sum* is 0, i.e.
    every loan was overdue in that bucket.  ``any_loan``: some loan has some
    overdue flag at 0; needs the ``__any_overdue`` aggregate."""
    if mode == "any_loan":
        return "CAST(coalesce(`__any_overdue`, 0) AS INT)"
    sums = ", ".join(quote(c) for c in roles.overdue_flags)
    smallest = f"least({sums})" if len(roles.overdue_flags) > 1 else sums
    return f"CAST(CASE WHEN {smallest} = 0 THEN 1 ELSE 0 END AS INT)"


def has_loans_col(roles: ColumnRoles, mode: str = "all_loans") -> Column:
    return F.expr(has_loans_sql(roles, mode))


def any_overdue_agg(roles: ColumnRoles) -> Column:
    flags = [F.col(c) for c in roles.overdue_flags]
    return F.max(F.when((F.least(*flags) if len(flags) > 1 else flags[0]) == 0, F.lit(1))
                 .otherwise(F.lit(0))).alias("__any_overdue")


def relative_sql(col: str, seq_max: str = max_name(SEQ_COL)) -> str:
    """A count column over rn_max; rn_max = 0 gives NULL, not an error."""
    return f"try_divide(CAST({quote(col)} AS DOUBLE), {quote(seq_max)}) AS {quote(col)}"


def relative(col: str, seq_max: str = max_name(SEQ_COL)) -> Column:
    return F.expr(relative_sql(col, seq_max))


def aggregate_by_map(df: DataFrame, key: str, func_map: dict[str, str]) -> DataFrame:
    """A4: ``groupBy(key).agg({column: function})`` with named outputs."""
    return df.groupBy(key).agg(*[AGG_FUNCS[f](c).alias(c) for c, f in func_map.items()])


def distinct_clients(df: DataFrame, key: str = ID_COL) -> DataFrame:
    """A5: one row per client."""
    return df.select(key).distinct()


def align_to_manifest(df: DataFrame, manifest, key: str | None = ID_COL, fill: float = 0.0) -> DataFrame:
    """Exactly the manifest's columns in its order; missing ones are ``fill``."""
    have = set(df.columns)
    cols = [quote(c) if c in have else f"CAST({float(fill)!r} AS DOUBLE) AS {quote(c)}" for c in manifest]
    return df.selectExpr(*([quote(key)] if key else []), *cols)


def client_features(loans: DataFrame, roles: ColumnRoles, levels: dict[str, list], *,
                    has_loans_mode: str = "all_loans", shift_first: bool = False) -> DataFrame:
    """D3: the whole per-client feature row in one aggregate."""
    if has_loans_mode not in HAS_LOANS_MODES:
        raise ValueError(f"has_loans_mode must be one of {HAS_LOANS_MODES}")
    derived = with_status_features(loans, roles)
    aggs = flag_sum_aggs(roles) + level_count_aggs(levels, roles.shifted, shift_first) + numeric_max_aggs(roles)
    if has_loans_mode == "any_loan":
        aggs.append(any_overdue_agg(roles))
    grouped = derived.groupBy(roles.id_col).agg(*aggs)
    counted = list(roles.flags) + [level_name(c, v) for c, lv in levels.items() for v in lv]
    return grouped.selectExpr(
        quote(roles.id_col),
        *[relative_sql(c) for c in counted],
        *[quote(max_name(c)) for c in roles.numeric],
        f"{has_loans_sql(roles, has_loans_mode)} AS {HAS_LOANS}",
    )


def output_names(roles: ColumnRoles, levels: dict[str, list]) -> list[str]:
    """Feature names in output order (the manifest a fitted model keeps)."""
    return (list(roles.flags) + [level_name(c, v) for c, lv in levels.items() for v in lv]
            + [max_name(c) for c in roles.numeric] + [HAS_LOANS])


class _ClientParams(Params):
    idCol = Param(Params._dummy(), "idCol", "client key column", TypeConverters.toString)
    seqCol = Param(Params._dummy(), "seqCol", "loan number column", TypeConverters.toString)
    flagCols = Param(Params._dummy(), "flagCols", "0/1 flag columns summed per client", TypeConverters.toListString)
    excludedCols = Param(Params._dummy(), "excludedCols", "columns left out of the features", TypeConverters.toListString)
    statusPrefix = Param(Params._dummy(), "statusPrefix", "prefix of the status columns", TypeConverters.toString)
    shiftedCols = Param(Params._dummy(), "shiftedCols", "status columns coded one higher", TypeConverters.toListString)
    hasLoansMode = Param(Params._dummy(), "hasLoansMode", "all_loans or any_loan", TypeConverters.toString)
    shiftBeforeEncode = Param(Params._dummy(), "shiftBeforeEncode", "count levels of shifted codes", TypeConverters.toBoolean)
    maxLevels = Param(Params._dummy(), "maxLevels", "largest number of levels per categorical column", TypeConverters.toInt)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "largest number of output feature columns", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(idCol=ID_COL, seqCol=SEQ_COL, flagCols=list(FLAG_COLS), excludedCols=list(EXCLUDED_COLS),
                         statusPrefix=STATUS_PREFIX, shiftedCols=list(SHIFTED_STATUS_COLS),
                         hasLoansMode="all_loans", shiftBeforeEncode=False, maxLevels=1000,
                         maxFeatures=5000)

    def roles_for(self, columns) -> ColumnRoles:
        return ColumnRoles.from_columns(
            columns, id_col=self.getOrDefault("idCol"), seq_col=self.getOrDefault("seqCol"),
            flags=tuple(self.getOrDefault("flagCols")), excluded=tuple(self.getOrDefault("excludedCols")),
            status_prefix=self.getOrDefault("statusPrefix"), shifted=tuple(self.getOrDefault("shiftedCols")),
            ignore=DERIVED_NUMERIC)


class ClientFeatures(Estimator, _ClientParams, DefaultParamsReadable, DefaultParamsWritable):
    """D3/D4 Estimator: ``fit`` learns levels and the manifest, the model aggregates."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._set(**self._input_kwargs)

    @keyword_only
    def setParams(self, **kwargs):
        return self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ClientFeaturesModel":
        roles = self.roles_for(dataset.columns)
        shift = self.getOrDefault("shiftBeforeEncode")
        source = dataset
        if shift:
            source = dataset.withColumns({c: F.col(c) - 1 for c in roles.shifted})
        levels = learn_levels(source, list(roles.categorical), self.getOrDefault("maxLevels"))
        names = output_names(roles, levels)
        if len(names) > self.getOrDefault("maxFeatures"):
            raise ValueError(f"{len(names)} feature columns exceed maxFeatures={self.getOrDefault('maxFeatures')}; "
                             "lower maxLevels or exclude high-cardinality columns")
        model = ClientFeaturesModel()
        self._copyValues(model)
        model._set(levelsJson=json.dumps(levels), manifest=names)
        return model


class ClientFeaturesModel(Model, _ClientParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted feature builder: always emits ``id`` + the manifest's columns."""

    levelsJson = Param(Params._dummy(), "levelsJson", "learned levels per column (JSON)", TypeConverters.toString)
    manifest = Param(Params._dummy(), "manifest", "output feature names in order", TypeConverters.toListString)

    def __init__(self):
        super().__init__()

    @property
    def levels(self) -> dict[str, list]:
        return json.loads(self.getOrDefault("levelsJson"))

    def getManifest(self) -> list[str]:
        return list(self.getOrDefault("manifest"))

    def setManifest(self, manifest) -> "ClientFeaturesModel":
        return self._set(manifest=list(manifest))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        roles = self.roles_for(dataset.columns)
        feats = client_features(dataset, roles, self.levels, has_loans_mode=self.getOrDefault("hasLoansMode"),
                                shift_first=self.getOrDefault("shiftBeforeEncode"))
        return align_to_manifest(feats, self.getManifest(), key=roles.id_col)

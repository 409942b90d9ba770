"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the loan table Spark derives from ``orders`` (or the
``documents``/``labels``/``customer`` tables) in full.  Doubles that two
engines compute by different algorithms are rounded to 6 places in the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendfeat.functions import history as H
from lendfeat.functions import udf as U
from lendfeat.operators import clients as C
from lendfeat.operators import evaluate as E
from lendfeat.operators import joins as J
from lendfeat.operators import profile as P
from lendfeat.operators import sampling as S
from lendfeat.roles import ColumnRoles, STATUS_PREFIX, with_prefix
from lendfeat.session import scratch_path
from lendfeat.sources import readers as R
from lendfeat.sources.loans import loans, loans_path, targets

# Fixed values of the registered queries.
SEED = 44
TEST_FRACTION = 0.2
N_FOLDS = 5
SAMPLE_ROWS = 10000
LOWEST_K = 30
LOOKUP_ID, LOOKUP_RN = 7, 4
# A column that follows pre_cat_a in nine loans of ten, so that a pair falls into the association band.
NEAR_COLUMN = "pre_cat_near"
NEAR_SQL = "CASE WHEN (id*31 + rn*17) % 10 = 0 THEN pre_cat_a % 5 + 1 ELSE pre_cat_a END"
MANIFEST = ["rn_max", "has_loans", "is_zero_loans90", "pre_cat_a_1", "pre_cat_a_5", "pre_cat_a_9",
            "enc_cat_b_2", "enc_paym_11_0", "enc_paym_11_4", "frac_loan_months_max"]
AGG_MAP = {"is_zero_loans5": "sum", "is_zero_util": "sum", "rn": "max", "pre_cat_a": "min",
           "enc_cat_b": "mean", "enc_paym_0": "count"}


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _roles(df: DataFrame) -> ColumnRoles:
    return ColumnRoles.from_schema(df.schema)


def _labelled_loans(spark, sf) -> DataFrame:
    """Loan rows with their client's target (left join on id)."""
    return loans(spark, sf).join(targets(spark, sf).withColumnRenamed("flag", "target"), "id", "left")


def _features(spark, sf) -> DataFrame:
    lo = loans(spark, sf)
    return C.ClientFeatures().fit(lo).transform(lo)


def _client_scores(spark, sf) -> DataFrame:
    """(id, target, p): p = share of a client's loans 90+ days overdue, a learnable score."""
    lo = loans(spark, sf)
    p = 1.0 - F.try_divide(F.sum("is_zero_loans90").cast("double"), F.max("rn"))
    scores = lo.groupBy("id").agg(p.alias("p"))
    return scores.join(targets(spark, sf).withColumnRenamed("flag", "target"), "id", "left")


# --- sources --------------------------------------------------------------

def q_read_parts(spark, sf):
    """S2 + U1: the loan table's numbered part files read back as one table, one scan."""
    schema = loans(spark, sf).schema
    return R.read_parts(spark, [R.part_files(loans_path(spark, sf))], schema)


def q_read_parts_widened(spark, sf):
    """S2 + U1: three parts of the loan table, one without the last status, one with other types, as one table."""
    lo, path = loans(spark, sf), scratch_path(spark, "loan_parts")
    part = lambda k: lo.where(F.col("id") % 3 == k)
    part(0).write.parquet(f"{path}/0")
    part(1).drop("enc_paym_24").write.parquet(f"{path}/1")
    part(2).withColumns({"rn": F.col("rn").cast("int"), "pre_loans6090": F.col("pre_loans6090").cast("double")}).write.parquet(f"{path}/2")
    return R.read_parts(spark, [f"{path}/{k}" for k in range(3)])


def _damaged_targets(spark, sf) -> str:
    """The targets as CSV lines, some with a word for a number, a field too few or one too many."""
    path, i = scratch_path(spark, "damaged_csv"), F.col("id")
    line = (F.when(i % 97 == 0, F.concat(i, F.lit(",x"))).when(i % 101 == 0, i.cast("string"))
            .when(i % 103 == 0, F.concat(i, F.lit(","), "flag", F.lit(",9"))).otherwise(F.concat(i, F.lit(","), "flag")))
    targets(spark, sf).select(line.alias("value")).write.text(path)
    return path


def q_read_csv_checked(spark, sf):
    """S3: well-formed lines of a damaged CSV as typed rows, the others as they stand."""
    good, rejects = R.read_csv_checked(spark, _damaged_targets(spark, sf), R.TARGET_SCHEMA, header=False)
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(rejects.select("line"), allowMissingColumns=True)


def q_csv_reject_counts(spark, sf):
    return R.reject_counts(*R.read_csv_checked(spark, _damaged_targets(spark, sf), R.TARGET_SCHEMA, header=False))


def q_read_csv_targets(spark, sf):
    path = scratch_path(spark, "train_target_csv")
    R.write_csv(targets(spark, sf), path)
    return R.read_csv(spark, path, R.TARGET_SCHEMA)


# --- projections ------------------------------------------------------------

def q_prefix_columns(spark, sf):
    lo = loans(spark, sf)
    return lo.select("id", "rn", *with_prefix(lo.columns, STATUS_PREFIX))


def q_align_manifest(spark, sf):
    lo = loans(spark, sf)
    model = C.ClientFeatures().fit(lo).setManifest(MANIFEST)
    return model.transform(lo)


def q_shift_status(spark, sf):
    lo = loans(spark, sf)
    roles = _roles(lo)
    return lo.withColumns(H.shifted_status(roles.status, roles.shifted))


def q_row_vector(spark, sf):
    lo = loans(spark, sf)
    return (lo.where((F.col("id") == LOOKUP_ID) & (F.col("rn") == LOOKUP_RN))
            .select("id", "rn", *with_prefix(lo.columns, STATUS_PREFIX)))


# --- filters ----------------------------------------------------------------

def q_any_flag_zero(spark, sf):
    lo = loans(spark, sf)
    return lo.where(P.any_equals(_roles(lo).overdue_flags, 0))


def q_overdue_and_flag_counts(spark, sf):
    lo = loans(spark, sf)
    roles = _roles(lo)
    sh = lo.withColumns(H.shifted_status(roles.status, roles.shifted))
    flag0 = P.any_equals(roles.overdue_flags, 0)
    return sh.agg(*[F.count_if(P.any_equals(roles.status, code) & flag0).alias(f"n_code{code}_flag0")
                    for code in (1, 2)])


def q_status_counts(spark, sf):
    lo = loans(spark, sf)
    vec = H.status_vector(_roles(lo).status, _roles(lo).shifted)
    return lo.select("id", "rn",
                     H.count_active(vec).alias("n_active"),
                     H.count_equal(vec, 1).alias("n_code1"),
                     H.count_equal(vec, 2).alias("n_code2"))


def q_threshold_label(spark, sf):
    sc = _client_scores(spark, sf)
    return sc.select("id", E.threshold("p").alias("prediction"))


# --- joins ------------------------------------------------------------------

def q_client_target(spark, sf):
    tg = targets(spark, sf).withColumnRenamed("flag", "target")
    return _features(spark, sf).join(tg, "id", "left")


def q_loan_target(spark, sf):
    return _labelled_loans(spark, sf)


def q_loan_target_salted(spark, sf):
    """J2 with counted heavy clients dealt over salts."""
    return J.salted_join(loans(spark, sf), targets(spark, sf).withColumnRenamed("flag", "target"), "id", "left")


def q_attach_predictions(spark, sf):
    ids = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("id"))
    pred = q_threshold_label(spark, sf).withColumnRenamed("prediction", "target")
    return ids.join(pred, "id", "left")


# --- aggregations -----------------------------------------------------------

def q_flag_sums(spark, sf):
    lo = loans(spark, sf)
    return lo.groupBy("id").agg(*C.flag_sum_aggs(_roles(lo)))


def q_level_counts(spark, sf):
    lo = loans(spark, sf)
    roles = _roles(lo)
    levels = P.learn_levels(lo, roles.categorical)
    return lo.groupBy("id").agg(*C.level_count_aggs(levels))


def q_numeric_max(spark, sf):
    lo = loans(spark, sf)
    roles = _roles(lo)
    return C.with_status_features(lo, roles).groupBy("id").agg(*C.numeric_max_aggs(roles))


def q_agg_by_map(spark, sf):
    return C.aggregate_by_map(loans(spark, sf), "id", AGG_MAP)


def q_distinct_clients(spark, sf):
    return C.distinct_clients(loans(spark, sf))


def q_value_counts(spark, sf):
    lo = loans(spark, sf)
    return P.value_counts(lo, lo.columns, ordered=True)


def q_value_count_matrix(spark, sf):
    lo = loans(spark, sf)
    roles = _roles(lo)
    sh = lo.withColumns(H.shifted_status(roles.status, roles.shifted))
    return P.value_count_matrix(sh, roles.status)


def q_contingency(spark, sf):
    return P.contingency(loans(spark, sf), "pre_cat_a", "enc_cat_b")


def _association(lo: DataFrame) -> DataFrame:
    return P.association_matrix(lo, [c for c in lo.columns if c not in ("id", "rn")])


def q_cramers_v(spark, sf):
    return _association(loans(spark, sf)).select("col_x", "col_y", r6("v").alias("v"))


def q_chi_square(spark, sf):
    return _association(loans(spark, sf)).select("col_x", "col_y", r6("chi2").alias("chi2"))


def q_association_band(spark, sf):
    lo = loans(spark, sf).withColumn(NEAR_COLUMN, F.expr(NEAR_SQL))
    return P.association_band(_association(lo)).select("col_x", "col_y", r6("v").alias("v"))


def _fisher(spark, sf) -> DataFrame:
    """Fisher scores of every loan column against the client's target.

    Loans are reduced per client before meeting the targets, so no loan-grain join."""
    lo = loans(spark, sf)
    feats = list(lo.columns)
    tg = targets(spark, sf).withColumnRenamed("flag", "target")
    return P.fisher_scores_by_key(lo, feats, "id", tg, "target")


def q_fisher_score(spark, sf):
    return _fisher(spark, sf).select("feature", r6("score").alias("score"), "rank")


def q_lowest_fisher(spark, sf):
    return P.lowest(_fisher(spark, sf), "score", LOWEST_K, "feature").select(
        "feature", r6("score").alias("score"), "rank")


def q_shape(spark, sf):
    return P.shape(loans(spark, sf))


def q_class_ratio(spark, sf):
    lo = loans(spark, sf)
    tg = targets(spark, sf).withColumnRenamed("flag", "target")
    out = P.class_ratio_by_key(lo, "id", tg, "target", P.any_equals(_roles(lo).overdue_flags, 0))
    return out.select("n0", "n1", r6("ratio_0_to_1").alias("ratio_0_to_1"), "subset_n0", "subset_n1",
                      r6("subset_ratio_1_to_0").alias("subset_ratio_1_to_0"))


def q_has_loans(spark, sf):
    lo = loans(spark, sf)
    roles = _roles(lo)
    sums = lo.groupBy("id").agg(*C.flag_sum_aggs(roles))
    return sums.select("id", C.has_loans_col(roles).alias(C.HAS_LOANS))


def q_relative_features(spark, sf):
    lo = loans(spark, sf)
    roles = _roles(lo)
    levels = P.learn_levels(lo, roles.categorical)
    counted = list(roles.flags) + [C.level_name(c, v) for c, lv in levels.items() for v in lv]
    grouped = lo.groupBy("id").agg(*C.flag_sum_aggs(roles), *C.level_count_aggs(levels),
                                   F.max("rn").alias("rn_max"))
    return grouped.select("id", *[C.relative(c) for c in counted])


# --- sampling ---------------------------------------------------------------

def _clients_with_target(spark, sf) -> DataFrame:
    return targets(spark, sf).withColumnRenamed("flag", "target")


def q_sample_n(spark, sf):
    return S.sample_n(loans(spark, sf), ["id", "rn"], SAMPLE_ROWS, SEED)


def q_stratified_split(spark, sf):
    return S.stratified_split(_clients_with_target(spark, sf), "id", "target", TEST_FRACTION, SEED)


def q_folds(spark, sf):
    return S.folds(_clients_with_target(spark, sf), "id", "target", N_FOLDS, SEED)


def q_downsample_union(spark, sf):
    marked = S.stratified_split(_clients_with_target(spark, sf), "id", "target", TEST_FRACTION, SEED)
    # downsampling reads the training part three times: cut the split's lineage first
    train = marked.checkpoint().where(F.col("is_test") == 0).drop("is_test")
    return S.downsample(train, "id", "target", SEED)


# --- status-vector features -------------------------------------------------

def _per_loan(spark, sf, name, fn):
    lo = loans(spark, sf)
    roles = _roles(lo)
    return lo.select("id", "rn", fn(H.status_vector(roles.status, roles.shifted)).alias(name))


def q_longest_overdue_run(spark, sf):
    return _per_loan(spark, sf, "num_loan_months", H.longest_overdue_run)


def q_overdue_fraction(spark, sf):
    return _per_loan(spark, sf, "frac_loan_months", H.overdue_fraction)


def q_history_length(spark, sf):
    return _per_loan(spark, sf, "credit_history_length", H.credit_history_length)


def q_status_features_arrow(spark, sf):
    """C1 to C3 through a registered Arrow function that remembers the vectors of its partition."""
    lo = loans(spark, sf)
    roles = _roles(lo)
    names = list(roles.status)
    U.register_iterator(spark, "status_features", lambda: U.StatusMemo(names), U.StatusMemo.TYPE)
    vector = ", ".join(f"CAST({v} AS INT)" for v in H.status_vector(roles.status, roles.shifted).values())
    return lo.selectExpr("id", "rn", f"status_features(array({vector})) AS s").select("id", "rn", "s.*")


def q_client_features(spark, sf):
    return _features(spark, sf)


# --- evaluation -------------------------------------------------------------

def q_roc_auc(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return E.roc_auc(lab.join(docs, "doc_id"), "quality", "n_chars").select(r6("auc").alias("auc"))


def q_roc_auc_clients(spark, sf):
    return E.roc_auc(_client_scores(spark, sf), "target", "p").select(r6("auc").alias("auc"))


def q_confusion_matrix(spark, sf):
    sc = _client_scores(spark, sf).withColumn("prediction", E.threshold("p"))
    return E.confusion_matrix(sc, "target", "prediction")


def q_log_loss(spark, sf):
    return E.log_loss(_client_scores(spark, sf), "target", "p").select(r6("log_loss").alias("log_loss"))


QUERIES = {
    "read_parts": q_read_parts,
    "read_parts_widened": q_read_parts_widened,
    "read_csv_targets": q_read_csv_targets,
    "read_csv_checked": q_read_csv_checked,
    "csv_reject_counts": q_csv_reject_counts,
    "prefix_columns": q_prefix_columns,
    "align_manifest": q_align_manifest,
    "shift_status": q_shift_status,
    "row_vector": q_row_vector,
    "any_flag_zero": q_any_flag_zero,
    "overdue_and_flag_counts": q_overdue_and_flag_counts,
    "status_counts": q_status_counts,
    "association_band": q_association_band,
    "threshold_label": q_threshold_label,
    "client_target": q_client_target,
    "loan_target": q_loan_target,
    "loan_target_salted": q_loan_target_salted,
    "attach_predictions": q_attach_predictions,
    "flag_sums": q_flag_sums,
    "level_counts": q_level_counts,
    "numeric_max": q_numeric_max,
    "agg_by_map": q_agg_by_map,
    "distinct_clients": q_distinct_clients,
    "value_counts": q_value_counts,
    "value_count_matrix": q_value_count_matrix,
    "contingency": q_contingency,
    "cramers_v": q_cramers_v,
    "chi_square": q_chi_square,
    "fisher_score": q_fisher_score,
    "shape": q_shape,
    "class_ratio": q_class_ratio,
    "has_loans": q_has_loans,
    "relative_features": q_relative_features,
    "lowest_fisher": q_lowest_fisher,
    "downsample_union": q_downsample_union,
    "sample_n": q_sample_n,
    "stratified_split": q_stratified_split,
    "folds": q_folds,
    "longest_overdue_run": q_longest_overdue_run,
    "overdue_fraction": q_overdue_fraction,
    "history_length": q_history_length,
    "status_features_arrow": q_status_features_arrow,
    "client_features": q_client_features,
    "roc_auc": q_roc_auc,
    "roc_auc_clients": q_roc_auc_clients,
    "confusion_matrix": q_confusion_matrix,
    "log_loss": q_log_loss,
}

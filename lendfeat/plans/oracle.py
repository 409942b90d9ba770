"""DuckDB oracle SQL for the registered queries (``__spark_entry__.oracle_sql``).

Each string runs on the pre-registered test-data views and re-derives the loan
view in SQL.  The formulations are deliberately independent of the Spark
code: chi-square sums (O - E)^2 / E over the full expected grid, AUC uses
average ranks, longest runs split a status string, sampling uses global
``ROW_NUMBER``.
"""

from __future__ import annotations

from lendfeat.plans import queries as Q
from lendfeat.plans.oracle_views import STATUS_COLS, with_views
from lendfeat.roles import EXCLUDED_COLS, FLAG_COLS

OVERDUE = [f for f in FLAG_COLS if f.startswith("is_zero_loans")]
SHIFTED = ("enc_paym_11", "enc_paym_20", "enc_paym_24")
LOAN_COLS = (["id", "rn", "pre_cat_a", "enc_cat_b", *EXCLUDED_COLS, *FLAG_COLS, *STATUS_COLS])
CATEGORICAL = ["pre_cat_a", "enc_cat_b", *STATUS_COLS]
# Levels present in the derived view (the Spark side learns them from data).
LEVELS = {"pre_cat_a": [1, 2, 3, 4, 5], "enc_cat_b": [0, 1, 2]}
LEVELS.update({c: ([1, 2, 3, 4] if c in SHIFTED else [0, 1, 2, 3]) for c in STATUS_COLS})


def _j(parts, sep=",\n  "):
    return sep.join(parts)


def shifted_select() -> str:
    cols = [f"{c} - 1 AS {c}" if c in SHIFTED else c for c in LOAN_COLS]
    return f"SELECT {_j(cols)} FROM loans"


def _any_eq(cols, v):
    return "(" + " OR ".join(f"{c} = {v}" for c in cols) + ")"


def _per_loan_features() -> str:
    """Raw loans plus the three status features, computed from shifted codes."""
    s = [f"(s.{c} - 1)" if c in SHIFTED else f"s.{c}" for c in STATUS_COLS]
    code_str = " || ".join(f"CAST({c} AS VARCHAR)" for c in s)
    n12 = " + ".join(f"CASE WHEN {c} IN (1, 2) THEN 1 ELSE 0 END" for c in s)
    nact = " + ".join(f"CASE WHEN {c} IS DISTINCT FROM 3 THEN 1 ELSE 0 END" for c in s)
    chl = ", ".join(f"CASE WHEN {c} IS DISTINCT FROM 3 THEN {k} ELSE 0 END" for k, c in enumerate(s))
    return f"""SELECT s.*,
    CAST(GREATEST(0, {chl}) AS INTEGER) AS credit_history_length,
    CAST(list_max(list_transform(string_split_regex({code_str}, '[^12]'), lambda x: length(x))) AS INTEGER)
      AS num_loan_months,
    CAST(({n12}) AS DOUBLE) / (CASE WHEN ({nact}) = 0 THEN 24 ELSE ({nact}) END) AS frac_loan_months
  FROM loans s"""


def _level_exprs(relative: bool) -> list[str]:
    out = []
    for c in CATEGORICAL:
        for v in LEVELS[c]:
            cnt = f"COUNT(*) FILTER (WHERE l.{c} = {v})"
            out.append(f"CAST({cnt} AS DOUBLE) / NULLIF(MAX(l.rn), 0) AS {c}_{v}" if relative
                       else f"{cnt} AS {c}_{v}")
    return out


def _flag_exprs(relative: bool) -> list[str]:
    if relative:
        return [f"CAST(SUM(l.{f}) AS DOUBLE) / NULLIF(MAX(l.rn), 0) AS {f}" for f in FLAG_COLS]
    return [f"CAST(SUM(l.{f}) AS BIGINT) AS {f}" for f in FLAG_COLS]


def _has_loans() -> str:
    least = ", ".join(f"SUM(l.{f})" for f in OVERDUE)
    return f"CASE WHEN LEAST({least}) = 0 THEN 1 ELSE 0 END AS has_loans"


def features_cte() -> str:
    return f"""SELECT l.id,
  {_j(_flag_exprs(True))},
  {_j(_level_exprs(True))},
  MAX(l.rn) AS rn_max,
  MAX(l.credit_history_length) AS credit_history_length_max,
  MAX(l.num_loan_months) AS num_loan_months_max,
  MAX(l.frac_loan_months) AS frac_loan_months_max,
  {_has_loans()}
  FROM ({_per_loan_features()}) l GROUP BY l.id"""


SCORES = """SELECT s.id, s.p, t.flag AS target FROM (
    SELECT id, 1.0 - CAST(SUM(is_zero_loans90) AS DOUBLE) / NULLIF(MAX(rn), 0) AS p FROM loans GROUP BY id
  ) s LEFT JOIN targets t ON s.id = t.id"""


def _union_long(source: str, cols, value_type="BIGINT") -> str:
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS {value_type}) AS value FROM {source}" for c in cols)


def _hash(expr: str, seed: int, purpose: str) -> str:
    return f"CAST('0x' || substr(md5('{purpose}:{seed}:' || CAST({expr} AS VARCHAR)), 1, 8) AS BIGINT)"


def _association_ctes(derived: dict[str, str] | None = None) -> str:
    cols = {**{c: c for c in LOAN_COLS if c not in ("id", "rn")}, **(derived or {})}
    long = "\n    UNION ALL ".join(
        f"SELECT id, rn, {i} AS pos, '{c}' AS col, CAST({x} AS VARCHAR) AS val FROM loans WHERE ({x}) IS NOT NULL"
        for i, (c, x) in enumerate(cols.items()))
    return f"""lg AS (
    {long}
),
cells AS (
  SELECT a.pos AS px, a.col AS cx, a.val AS vx, b.pos AS py, b.col AS cy, b.val AS vy, COUNT(*) AS n
  FROM lg a JOIN lg b ON a.id = b.id AND a.rn = b.rn AND a.pos <= b.pos
  GROUP BY ALL
),
rowm AS (SELECT px, cx, py, cy, vx, SUM(n) AS rr FROM cells GROUP BY ALL),
colm AS (SELECT px, cx, py, cy, vy, SUM(n) AS cc FROM cells GROUP BY ALL),
shape AS (
  SELECT r.px, r.cx, r.py, r.cy, r.nn, r.r, c.k FROM
    (SELECT px, cx, py, cy, SUM(rr) AS nn, COUNT(*) AS r FROM rowm GROUP BY ALL) r
    JOIN (SELECT px, cx, py, cy, COUNT(*) AS k FROM colm GROUP BY ALL) c USING (px, cx, py, cy)
),
grid AS (
  SELECT m.px, m.cx, m.py, m.cy, m.vx, q.vy, CAST(m.rr AS DOUBLE) * q.cc / sh.nn AS e,
         COALESCE(ce.n, 0) AS o, sh.r, sh.k, sh.nn
  FROM rowm m JOIN colm q USING (px, cx, py, cy)
  JOIN shape sh USING (px, cx, py, cy)
  LEFT JOIN cells ce ON ce.px = m.px AND ce.py = m.py AND ce.vx = m.vx AND ce.vy = q.vy
),
chi AS (
  SELECT px, cx, py, cy, ANY_VALUE(nn) AS nn, ANY_VALUE(r) AS r, ANY_VALUE(k) AS k,
    CASE WHEN ANY_VALUE(r) = 1 OR ANY_VALUE(k) = 1 THEN 0.0
         WHEN ANY_VALUE(r) = 2 AND ANY_VALUE(k) = 2 THEN SUM(POWER(GREATEST(ABS(o - e) - 0.5, 0.0), 2) / e)
         ELSE SUM(POWER(o - e, 2) / e) END AS chi2
  FROM grid GROUP BY px, cx, py, cy
),
vv AS (
  SELECT *, CASE WHEN nn > 1 THEN SQRT(
      GREATEST(0.0, chi2 / nn - (k - 1) * (r - 1) / (nn - 1.0))
      / LEAST(CASE WHEN kc = 1.0 THEN kc + 0.000001 ELSE kc END - 1.0,
              CASE WHEN rc = 1.0 THEN rc + 0.000001 ELSE rc END - 1.0)) END AS v
  FROM (SELECT *, r - POWER(r - 1, 2) / (nn - 1.0) AS rc, k - POWER(k - 1, 2) / (nn - 1.0) AS kc FROM chi)
),
am AS (
  SELECT cx AS col_x, cy AS col_y, chi2, v FROM vv
  UNION ALL SELECT cy AS col_x, cx AS col_y, chi2, v FROM vv WHERE px <> py
)"""


def _fisher_ctes() -> str:
    feats = list(LOAN_COLS)
    long = "\n    UNION ALL ".join(
        f"SELECT '{c}' AS feature, target, CAST({c} AS DOUBLE) AS x FROM lt WHERE target IS NOT NULL" for c in feats)
    return f"""lt AS (SELECT l.*, t.flag AS target FROM loans l LEFT JOIN targets t ON l.id = t.id),
fl AS (
    {long}
),
pc AS (SELECT feature, target, COUNT(x) AS n, AVG(x) AS mu, VAR_POP(x) AS var FROM fl GROUP BY feature, target),
pm AS (SELECT *, SUM(n * mu) OVER (PARTITION BY feature) / SUM(n) OVER (PARTITION BY feature) AS mu_all
       FROM pc WHERE n > 0),
fs AS (
  SELECT feature, CASE WHEN SUM(n * var) > 0 THEN SUM(n * POWER(mu - mu_all, 2)) / SUM(n * var) END AS score
  FROM pm GROUP BY feature
),
fr AS (SELECT feature, score,
       CAST(ROW_NUMBER() OVER (ORDER BY score DESC NULLS LAST, feature) AS BIGINT) AS rank FROM fs)"""


def _split_ctes(seed: int, purpose: str = "split") -> str:
    return f"""cl AS (SELECT id, flag AS target, {_hash('id', seed, purpose)} AS h FROM targets),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY h, id) AS rnk,
              COUNT(*) OVER (PARTITION BY target) AS n_c FROM cl),
sp AS (SELECT id, target, h, CASE WHEN rnk <= (n_c * 2 + 5) // 10 THEN 1 ELSE 0 END AS is_test FROM rk)"""


def _auc(source: str) -> str:
    return f"""WITH d AS ({source}),
rk AS (SELECT y, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM d)
SELECT ROUND((SUM(ar) FILTER (WHERE y = 1) - COUNT(*) FILTER (WHERE y = 1) * (COUNT(*) FILTER (WHERE y = 1) + 1) / 2.0)
       / (CAST(COUNT(*) FILTER (WHERE y = 1) AS DOUBLE) * COUNT(*) FILTER (WHERE y = 0)), 6) AS auc FROM rk"""


def feature_names() -> list[str]:
    return [*FLAG_COLS, *[f"{c}_{v}" for c in CATEGORICAL for v in LEVELS[c]],
            "rn_max", "credit_history_length_max", "num_loan_months_max", "frac_loan_months_max", "has_loans"]


def oracle_sql() -> dict[str, str]:
    status = ", ".join(STATUS_COLS)
    lo_sh = shifted_select()
    h1 = _hash("id", Q.SEED, "sample")
    sample_h = _hash(f"({h1} + rn)", Q.SEED, "sample")
    manifest_exprs = []
    feat_names = set(FLAG_COLS) | {f"{c}_{v}" for c in CATEGORICAL for v in LEVELS[c]} | {
        "rn_max", "credit_history_length_max", "num_loan_months_max", "frac_loan_months_max", "has_loans"}
    for m in Q.MANIFEST:
        manifest_exprs.append(m if m in feat_names else f"CAST(0.0 AS DOUBLE) AS {m}")
    agg_map = {"sum": "CAST(SUM({c}) AS BIGINT)", "max": "MAX({c})", "min": "MIN({c})",
               "mean": "AVG(CAST({c} AS DOUBLE))", "count": "COUNT({c})"}
    sql = {
        "read_parts": with_views("SELECT * FROM loans"),
        "read_csv_targets": with_views("SELECT * FROM targets"),
        "prefix_columns": with_views(f"SELECT id, rn, {status} FROM loans"),
        "align_manifest": with_views(f"SELECT id, {', '.join(manifest_exprs)} FROM feats",
                                     extra=f"feats AS ({features_cte()})"),
        "shift_status": with_views(lo_sh),
        "row_vector": with_views(f"SELECT id, rn, {status} FROM loans WHERE id = {Q.LOOKUP_ID} AND rn = {Q.LOOKUP_RN}"),
        "any_flag_zero": with_views(f"SELECT * FROM loans WHERE {_any_eq(OVERDUE, 0)}"),
        "overdue_and_flag_counts": with_views(
            "SELECT " + ", ".join(
                f"COUNT(*) FILTER (WHERE {_any_eq(STATUS_COLS, code)} AND {_any_eq(OVERDUE, 0)}) AS n_code{code}_flag0"
                for code in (1, 2)) + f" FROM ({lo_sh})"),
        "status_counts": with_views(
            "SELECT id, rn, "
            + " + ".join(f"CASE WHEN {c} IS DISTINCT FROM 3 THEN 1 ELSE 0 END" for c in STATUS_COLS) + " AS n_active, "
            + " + ".join(f"CASE WHEN {c} = 1 THEN 1 ELSE 0 END" for c in STATUS_COLS) + " AS n_code1, "
            + " + ".join(f"CASE WHEN {c} = 2 THEN 1 ELSE 0 END" for c in STATUS_COLS) + " AS n_code2"
            + f" FROM ({lo_sh})"),
        "association_band": with_views(
            """SELECT col_x, col_y, ROUND(v, 6) AS v FROM am
  WHERE v > 0.7
    AND col_x IN (SELECT col_x FROM am WHERE v > 0.7 AND v <= 0.999)
    AND col_y IN (SELECT col_x FROM am WHERE v > 0.7 AND v <= 0.999)""",
            extra=_association_ctes({Q.NEAR_COLUMN: Q.NEAR_SQL})),
        "threshold_label": with_views("SELECT id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction FROM sc",
                                      extra=f"sc AS ({SCORES})"),
        "client_target": with_views(
            "SELECT f.*, t.flag AS target FROM feats f LEFT JOIN targets t ON f.id = t.id",
            extra=f"feats AS ({features_cte()})"),
        "loan_target": with_views("SELECT l.*, t.flag AS target FROM loans l LEFT JOIN targets t ON l.id = t.id"),
        "attach_predictions": with_views(
            "SELECT c.c_custkey AS id, CASE WHEN sc.p IS NULL THEN NULL WHEN sc.p > 0.5 THEN 1 ELSE 0 END AS target "
            "FROM customer c LEFT JOIN sc ON c.c_custkey = sc.id", extra=f"sc AS ({SCORES})"),
        "flag_sums": with_views(f"SELECT l.id, {_j(_flag_exprs(False))} FROM loans l GROUP BY l.id"),
        "level_counts": with_views(f"SELECT l.id, {_j(_level_exprs(False))} FROM loans l GROUP BY l.id"),
        "numeric_max": with_views(
            "SELECT id, MAX(rn) AS rn_max, MAX(credit_history_length) AS credit_history_length_max, "
            "MAX(num_loan_months) AS num_loan_months_max, MAX(frac_loan_months) AS frac_loan_months_max "
            f"FROM ({_per_loan_features()}) GROUP BY id"),
        "agg_by_map": with_views(
            "SELECT id, " + ", ".join(f"{agg_map[f].format(c=c)} AS {c}" for c, f in Q.AGG_MAP.items())
            + " FROM loans GROUP BY id"),
        "distinct_clients": with_views("SELECT DISTINCT id FROM loans"),
        "value_counts": with_views(
            f"SELECT \"column\", value, COUNT(*) AS n FROM ({_union_long('loans', LOAN_COLS)}) "
            "WHERE value IS NOT NULL GROUP BY ALL"),
        "value_count_matrix": with_views(
            "SELECT \"column\", " + ", ".join(
                f"NULLIF(COUNT(*) FILTER (WHERE value = {v}), 0) AS code_{v}" for v in range(5))
            + f" FROM ({_union_long('sh', STATUS_COLS)}) GROUP BY \"column\"", extra=f"sh AS ({lo_sh})"),
        "contingency": with_views(
            "SELECT pre_cat_a, enc_cat_b, COUNT(*) AS n FROM loans "
            "WHERE pre_cat_a IS NOT NULL AND enc_cat_b IS NOT NULL GROUP BY ALL"),
        "cramers_v": with_views("SELECT col_x, col_y, ROUND(v, 6) AS v FROM am", extra=_association_ctes()),
        "chi_square": with_views("SELECT col_x, col_y, ROUND(chi2, 6) AS chi2 FROM am", extra=_association_ctes()),
        "fisher_score": with_views("SELECT feature, ROUND(score, 6) AS score, rank FROM fr", extra=_fisher_ctes()),
        "shape": with_views(f"SELECT COUNT(*) AS n_rows, CAST({len(LOAN_COLS)} AS BIGINT) AS n_cols FROM loans"),
        "class_ratio": with_views(
            f"""SELECT COUNT(*) FILTER (WHERE target = 0) AS n0, COUNT(*) FILTER (WHERE target = 1) AS n1,
  ROUND(CAST(COUNT(*) FILTER (WHERE target = 0) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE target = 1), 0), 6) AS ratio_0_to_1,
  COUNT(*) FILTER (WHERE target = 0 AND {_any_eq(OVERDUE, 0)}) AS subset_n0,
  COUNT(*) FILTER (WHERE target = 1 AND {_any_eq(OVERDUE, 0)}) AS subset_n1,
  ROUND(CAST(COUNT(*) FILTER (WHERE target = 1 AND {_any_eq(OVERDUE, 0)}) AS DOUBLE)
        / NULLIF(COUNT(*) FILTER (WHERE target = 0 AND {_any_eq(OVERDUE, 0)}), 0), 6) AS subset_ratio_1_to_0
  FROM lt""", extra="lt AS (SELECT l.*, t.flag AS target FROM loans l LEFT JOIN targets t ON l.id = t.id)"),
        "has_loans": with_views(f"SELECT l.id, {_has_loans()} FROM loans l GROUP BY l.id"),
        "relative_features": with_views(
            f"SELECT l.id, {_j(_flag_exprs(True))}, {_j(_level_exprs(True))} FROM loans l GROUP BY l.id"),
        "lowest_fisher": with_views(
            f"SELECT feature, ROUND(score, 6) AS score, rank FROM fr ORDER BY score ASC NULLS LAST, feature "
            f"LIMIT {Q.LOWEST_K}", extra=_fisher_ctes()),
        "downsample_union": with_views(
            f"""SELECT id, target FROM (
  SELECT id, target, ROW_NUMBER() OVER (PARTITION BY target ORDER BY {_hash('id', Q.SEED, 'downsample')}, id) AS r2,
         MIN(n_t) OVER () AS n_min FROM (SELECT *, COUNT(*) OVER (PARTITION BY target) AS n_t FROM sp WHERE is_test = 0)
) WHERE r2 <= n_min""", extra=_split_ctes(Q.SEED)),
        "sample_n": with_views(
            f"SELECT * EXCLUDE (h, r) FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY h, id, rn) AS r FROM "
            f"(SELECT *, {sample_h} AS h FROM loans)) WHERE r <= {Q.SAMPLE_ROWS}"),
        "stratified_split": with_views("SELECT id, target, is_test FROM sp", extra=_split_ctes(Q.SEED)),
        "folds": with_views(
            "SELECT id, target, CAST(" + " + ".join(
                f"CASE WHEN rnk > (n_c * {j}) // {Q.N_FOLDS} THEN 1 ELSE 0 END" for j in range(1, Q.N_FOLDS))
            + " AS INTEGER) AS fold FROM rk",
            extra=_split_ctes(Q.SEED, "fold")),
        "longest_overdue_run": with_views(f"SELECT id, rn, num_loan_months FROM ({_per_loan_features()})"),
        "overdue_fraction": with_views(f"SELECT id, rn, frac_loan_months FROM ({_per_loan_features()})"),
        "history_length": with_views(f"SELECT id, rn, credit_history_length FROM ({_per_loan_features()})"),
        "client_features": with_views(features_cte()),
        "balanced_weights": with_views(
            """SELECT id, target, ROUND(SUM(1) OVER () / (CAST(n_t AS DOUBLE) * (SELECT COUNT(DISTINCT target) FROM sp WHERE is_test = 0)), 6) AS weight
FROM (SELECT *, COUNT(*) OVER (PARTITION BY target) AS n_t FROM sp WHERE is_test = 0)""", extra=_split_ctes(Q.SEED)),
        "saved_features": with_views("SELECT f.* FROM feats f JOIN sp ON f.id = sp.id WHERE sp.is_test = 1",
                                     extra=f"feats AS ({features_cte()}),\n{_split_ctes(Q.SEED)}"),
        "manifest_file": "SELECT * FROM (VALUES " + ", ".join(
            f"(CAST({i} AS INTEGER), '{n}')" for i, n in enumerate(feature_names())) + ") AS t(pos, name)",
        "model_nodes": with_views(
            """SELECT m.model, n_clients, CAST(0 AS BIGINT) AS n_differing, CAST(0 AS BIGINT) AS n_importances_differing, CAST(1 AS DOUBLE) AS importance_sum,
  CAST(0 AS BIGINT) AS n_splits_differing, CAST(20 AS BIGINT) AS n_top, CAST(m.n_rounds AS BIGINT) AS n_rounds
FROM (VALUES ('lgbm_default', 100), ('lgbm_final', 300)) m(model, n_rounds), (SELECT COUNT(*) AS n_clients FROM sp WHERE is_test = 1)""", extra=_split_ctes(Q.SEED)),
        "shuffled_batches": with_views(
            f"""SELECT id, target, pos, pos // 256 AS batch FROM (
  SELECT id, target, ROW_NUMBER() OVER (ORDER BY {_hash('id', Q.SEED, 'shuffle')}, id) - 1 AS pos FROM sp WHERE is_test = 0)""", extra=_split_ctes(Q.SEED)),
        "read_parts_widened": with_views(
            "SELECT * REPLACE (CAST(pre_loans6090 AS DOUBLE) AS pre_loans6090, CASE WHEN id % 3 <> 1 THEN enc_paym_24 END AS enc_paym_24) FROM loans"),
        "read_csv_checked": with_views(f"SELECT CASE WHEN good THEN id END AS id, CASE WHEN good THEN flag END AS flag, CASE WHEN NOT good THEN line END AS line FROM ({_damaged})"),
        "csv_reject_counts": with_views(f"SELECT COUNT(*) FILTER (WHERE good) AS n_good, COUNT(*) FILTER (WHERE NOT good) AS n_rejected FROM ({_damaged})"),
        "loan_target_salted": with_views("SELECT l.*, t.flag AS target FROM loans l LEFT JOIN targets t ON l.id = t.id"),
        "status_features_arrow": with_views(f"SELECT id, rn, credit_history_length, num_loan_months, frac_loan_months FROM ({_per_loan_features()})"),
        "saved_model_agreement": with_views(
            "SELECT COUNT(*) AS n_clients, CAST(0 AS BIGINT) AS n_differing FROM sp WHERE is_test = 1", extra=_split_ctes(Q.SEED)),
        "roc_auc": _auc("SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l JOIN documents d "
                        "ON l.doc_id = d.doc_id WHERE l.quality IS NOT NULL AND d.n_chars IS NOT NULL"),
        "roc_auc_clients": _auc_clients(),
        "confusion_matrix": with_views(
            """SELECT g.target, g.prediction, COALESCE(c.n, 0) AS n
  FROM (SELECT CAST(a AS INTEGER) AS target, CAST(b AS INTEGER) AS prediction
        FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b)) g
  LEFT JOIN (SELECT target, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, COUNT(*) AS n FROM sc GROUP BY ALL) c
  ON g.target = c.target AND g.prediction = c.prediction""", extra=f"sc AS ({SCORES})"),
        "log_loss": with_views(
            """SELECT ROUND(AVG(-(CAST(target AS DOUBLE) * GREATEST(LN(p), -100.0)
                    + (1.0 - target) * GREATEST(LN(1.0 - p), -100.0))), 6) AS log_loss
  FROM sc""",
            extra=f"sc AS ({SCORES})"),
    }
    return sql


_damaged = """SELECT id, flag, id % 97 <> 0 AND id % 101 <> 0 AND id % 103 <> 0 AS good,
  CASE WHEN id % 97 = 0 THEN id || ',x' WHEN id % 101 = 0 THEN id::VARCHAR WHEN id % 103 = 0 THEN id || ',' || flag || ',9' END AS line FROM targets"""


def _auc_clients() -> str:
    return with_views(
        """SELECT ROUND((SUM(ar) FILTER (WHERE y = 1) - COUNT(*) FILTER (WHERE y = 1) * (COUNT(*) FILTER (WHERE y = 1) + 1) / 2.0)
       / (CAST(COUNT(*) FILTER (WHERE y = 1) AS DOUBLE) * COUNT(*) FILTER (WHERE y = 0)), 6) AS auc FROM rk""",
        extra=f"""sc AS ({SCORES}),
d AS (SELECT target AS y, p AS s FROM sc WHERE target IS NOT NULL AND p IS NOT NULL),
rk AS (SELECT y, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM d)""")

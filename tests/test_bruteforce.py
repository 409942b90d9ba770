"""ClientFeatures against a plain pandas brute force, on data where one client holds a third of the loans."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lendfeat.operators.clients import ClientFeatures
from lendfeat.roles import EXCLUDED_COLS, FLAG_COLS

SHIFTED = ("enc_paym_11", "enc_paym_20", "enc_paym_24")


def brute_force(pdf: pd.DataFrame) -> pd.DataFrame:
    status = [c for c in pdf.columns if c.startswith("enc_paym")]
    cat = [c for c in pdf.columns if c not in ["id", "rn", *FLAG_COLS, *EXCLUDED_COLS]]
    sh = pdf.copy()
    for c in SHIFTED:
        sh[c] = sh[c] - 1
    runs, fracs, lengths = [], [], []
    for row in sh[status].itertuples(index=False):
        best = cur = 0
        for v in row:
            cur = cur + 1 if v in (1, 2) else 0
            best = max(best, cur)
        runs.append(best)
        active = sum(v != 3 for v in row)
        fracs.append(sum(v in (1, 2) for v in row) / (active if active else 24))
        idx = [int(c.rsplit("_", 1)[1]) for c, v in zip(status, row) if v != 3]
        lengths.append(max(idx) if idx else 0)
    sh["num_loan_months"], sh["frac_loan_months"], sh["credit_history_length"] = runs, fracs, lengths
    out = {}
    for cid, g in pdf.groupby("id"):
        s = sh.loc[g.index]
        rn_max = g["rn"].max()
        rec = {f: g[f].sum() / rn_max for f in FLAG_COLS}
        for c in cat:
            for v in sorted(pdf[c].unique()):
                rec[f"{c}_{v}"] = (g[c] == v).sum() / rn_max
        rec["rn_max"] = rn_max
        for n in ("credit_history_length", "num_loan_months", "frac_loan_months"):
            rec[f"{n}_max"] = s[n].max()
        rec["has_loans"] = int(min(g[f].sum() for f in FLAG_COLS if f.startswith("is_zero_loans")) == 0)
        out[cid] = rec
    return pd.DataFrame.from_dict(out, orient="index")


def test_client_features_equal_brute_force_with_hot_client(spark):
    from lendfeat.sources.loans import loans

    lo = loans(spark, "/root/testdata/sf0.001")
    # fixture: every third client's loans are moved to client 7, which then holds ~1/3 of all rows
    hot = lo.withColumn("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")))
    pdf = hot.toPandas()
    assert (pdf["id"] == 7).mean() > 0.25
    got = ClientFeatures().fit(hot).transform(hot.repartition(8)).toPandas().set_index("id").sort_index()
    want = brute_force(pdf).sort_index()
    assert list(got.columns) == list(want.columns)
    assert list(got.index) == list(want.index)
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(dtype=float), rtol=1e-12, atol=0)

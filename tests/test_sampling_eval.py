"""Exact sampling sizes, skew-safe ranks, AUC / confusion / log loss known answers."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendfeat.operators import evaluate as E
from lendfeat.operators import sampling as S
from lendfeat.operators.ranking import rank_within


def _clients(spark, n=100, pos=10):
    return spark.createDataFrame([(i, 1 if i < pos else 0) for i in range(n)], "id bigint, target int")


def test_split_sizes(spark):
    out = S.stratified_split(_clients(spark), "id", "target", 0.2, 44)
    got = {(r["target"], r["is_test"]): r["n"] for r in out.groupBy("target", "is_test").count()
           .withColumnRenamed("count", "n").collect()}
    assert got[(0, 1)] == 18 and got[(1, 1)] == 2
    assert got[(0, 0)] == 72 and got[(1, 0)] == 8


def test_folds_and_downsample(spark):
    df = _clients(spark)
    f = S.folds(df, "id", "target", 5, 44)
    sizes = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4] and all(v == 20 for v in sizes.values())
    d = S.downsample(df, "id", "target", 44)
    got = {r["target"]: r["count"] for r in d.groupBy("target").count().collect()}
    assert got == {0: 10, 1: 10}


def test_sample_n_exact_and_deterministic(spark):
    df = _clients(spark, 500, 50)
    a = S.sample_n(df, "id", 37, 7)
    b = S.sample_n(df.repartition(5), "id", 37, 7)
    assert a.count() == 37
    assert sorted(r["id"] for r in a.collect()) == sorted(r["id"] for r in b.collect())


def test_rank_within_matches_window_on_hot_group(spark):
    # one group holds most rows: the bucketed rank must equal the plain window rank
    rows = [(0 if i % 10 else i % 7, i, (i * 7919) % 1000) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, k bigint, o int")
    ranked = rank_within(df, ["g"], ["o", "k"], name="r")
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("o", "k")))
    assert sorted(map(tuple, ranked.select("g", "k", "r").collect())) == \
        sorted(map(tuple, plain.select("g", "k", "r").collect()))


def test_auc_known(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    assert E.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(0.75)
    tied = spark.createDataFrame([(0.5, 0), (0.5, 1), (0.5, 0), (0.5, 1)], "s double, y int")
    assert E.roc_auc(tied, "y", "s").first()["auc"] == pytest.approx(0.5)


def test_auc_symmetry_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = [((i * 37) % 101 / 101.0, 1 if (i * 13) % 7 < 3 else 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "s double, y int")
    auc = E.roc_auc(df, "y", "s").first()["auc"]
    neg = E.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first()["auc"]
    assert auc + neg == pytest.approx(1.0)
    ev = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    assert auc == pytest.approx(ev.evaluate(df.withColumn("y", F.col("y").cast("double"))), abs=1e-12)


def test_confusion_and_log_loss(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7), (1, 0.9), (1, 0.9)], "y int, p double")
    cm = {(r["target"], r["prediction"]): r["n"] for r in
          E.confusion_matrix(df.withColumn("pred", E.threshold("p")), "y", "pred").collect()}
    assert cm == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    import math
    want = -(math.log(0.8) + math.log(0.3) + 2 * math.log(0.9)) / 4
    assert E.log_loss(df, "y", "p").first()["log_loss"] == pytest.approx(want)


def test_segment_by_rank_matches_window_with_coarse_buckets(spark):
    from lendfeat.operators.ranking import segment_by_rank

    # group 0 is hot; buckets of 50 order values hold many rows, so cuts fall inside buckets
    rows = [(0 if i % 10 else i % 7, i, (i * 7919) % 1000) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, k bigint, o int")
    cuts = lambda gn, gmin: [F.floor(gn * 0.3).cast("bigint"), F.floor(gn * 0.7).cast("bigint"), gmin]
    got = segment_by_rank(df, ["g"], [F.col("o"), F.col("k")], F.floor(F.col("o") / 50), cuts, name="s")
    w = Window.partitionBy("g").orderBy("o", "k")
    n = F.count(F.lit(1)).over(Window.partitionBy("g"))
    plain = df.withColumn("r", F.row_number().over(w)).withColumn("n", n)
    gmin = plain.groupBy("g").agg(F.max("n").alias("n")).agg(F.min("n")).first()[0]
    want = plain.withColumn("s", (F.col("r") > F.floor(F.col("n") * 0.3)).cast("int")
                            + (F.col("r") > F.floor(F.col("n") * 0.7)).cast("int")
                            + (F.col("r") > F.lit(gmin)).cast("int"))
    assert sorted(map(tuple, got.select("g", "k", "s").collect())) == \
        sorted(map(tuple, want.select("g", "k", "s").collect()))


def test_split_same_without_broadcast(spark):
    df = _clients(spark, 400, 40)
    a = sorted(map(tuple, S.stratified_split(df, "id", "target", 0.2, 44).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert a == sorted(map(tuple, S.stratified_split(df, "id", "target", 0.2, 44).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_seeds_and_purposes_give_unrelated_orders(spark):
    df = spark.range(20_000)
    draw = lambda seed: {r["id"] for r in S.sample_n(df, "id", 2000, seed).collect()}
    assert 120 < len(draw(44) & draw(45)) < 280  # 200 by chance
    labelled = df.withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    marked = S.stratified_split(labelled, "id", "y", 0.2, 44)
    parts = S.folds(marked.where("is_test = 0").drop("is_test"), "id", "y", 4, 44)
    shares = {r["fold"]: r["n"] for r in S.folds(marked, "id", "y", 4, 44).where("is_test = 1").groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert len(shares) == 4 and min(shares.values()) > 800  # the test part is spread over the folds
    assert parts.groupBy("fold").count().count() == 4
    inner = S.stratified_split(marked.where("is_test = 0").drop("is_test"), "id", "y", 0.2, 45, flag="is_val")
    from lendfeat.operators.ranking import seeded_hash

    h = inner.where("is_val = 1").withColumn("h", seeded_hash("id", 44, "split")).agg(F.min("h"), F.max("h"), F.avg("h")).first()
    assert h[1] - h[0] > 0.75 * 2**32


def test_rows_without_label_are_no_class(spark):
    from lendfeat.operators import models as M
    from lendfeat.operators import profile as P

    rows = [(i, 1 if i < 10 else 0 if i < 28 else None, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, y int, x double")
    assert S.downsample(df, "id", "y", 1).groupBy("y").count().where("count = 10").count() == 2
    w = {r["y"]: r["w"] for r in M.balanced_weights(df, "y", "w").where("y is not null").select("y", "w").distinct().collect()}
    assert w[1] == pytest.approx(1.4) and w[0] == pytest.approx(28 / 36)
    known = P.fisher_scores(df.where("y is not null"), ["x"], "y").first()["score"]
    assert P.fisher_scores(df, ["x"], "y").first()["score"] == pytest.approx(known)
    assert P.fisher_scores_by_key(df.drop("y"), ["x"], "id", df.select("id", "y"), "y").first()["score"] == pytest.approx(known)


def test_fisher_of_large_values_keeps_its_digits(spark):
    from lendfeat.operators import profile as P

    rows = [(i % 50, 1e9 + i % 10) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, x double")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(50)], "id long, y int")
    direct = P.fisher_scores(df.join(labels, "id"), ["x", "id"], "y").collect()
    by_key = {r["feature"]: r["score"] for r in P.fisher_scores_by_key(df, ["x", "id"], "id", labels, "y").collect()}
    assert {r["feature"]: pytest.approx(r["score"], rel=1e-6) for r in direct} == by_key


def test_loans_are_numbered_by_time_of_day(spark):
    from datetime import datetime

    from lendfeat.sources.loans import loans_from_orders

    rows = [(9000, 1, datetime(2020, 1, 1, 10), "F", "1-URGENT"), (1, 1, datetime(2020, 1, 1, 12), "O", "2-HIGH")]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderstatus string, o_orderpriority string")
    got = {r["pre_cat_a"]: r["rn"] for r in loans_from_orders(orders).collect()}
    assert got == {1: 1, 2: 2}


def test_shuffle_does_not_depend_on_partitions(spark):
    df = spark.range(500)
    a = [r["id"] for r in S.shuffled(df, "id", 3).collect()]
    assert a == [r["id"] for r in S.shuffled(df.repartition(7), "id", 3).collect()] != sorted(a)


def test_log_loss_floors_certain_mistakes(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0), (0, 1.0), (1, 1.0)], "y int, p double")
    # two certain mistakes cost 100 each, two certain hits cost 0
    assert E.log_loss(df, "y", "p").first()["log_loss"] == pytest.approx(50.0)

"""Sharding, mixing, block search, exact top-k, the pipeline and the registration."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_sharding_law_slots_and_ring(spark, odd, none):
    from lendfeat.llm import sharding

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.assign(docs.select("doc_id", "text"), 24).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == 1000 and sorted(len(v) for v in by.values()) == [41] * 8 + [42] * 16
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    # the ring in plain Python: same homes, and nobody leaves a home with room to spare
    ring = sharding.ring(docs, 24, 64).first()
    cells = {r["doc_id"]: r["c"] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(sharding.CELLS)).alias("c")).collect()}
    for r in rows:
        at = int(np.searchsorted(ring["nodes"], cells[r["doc_id"]]))
        assert r["home"] == ring["owners"][at % len(ring["nodes"])]
    away = [r for r in rows if r["home"] != r["shard"]]
    assert len(away) < 200 and all(len(by[r["home"]]) == 41 + (r["home"] < 1000 % 24) for r in away)
    got = sharding.assign(odd, 3).collect()
    assert sorted(r["size"] for r in got if r["doc_id"] in (3, 4)) == [8, 8] and len(got) == 11
    assert sorted(sum(r["shard"] == s for r in got) for s in range(3)) == [3, 4, 4]
    assert sharding.assign(none, 24).count() == 0


def _targets(sizes, names):
    order = sorted(names, key=lambda n: (n is None, (n or "").encode()))
    w = {n: (3, 1, 2)[i % 3] for i, n in enumerate(order)}
    total, full, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(2 * sizes[n] for n in full)
        weight = sum(w[n] for n in names if n not in full)
        target = {n: 2 * sizes[n] if n in full else rest * w[n] / weight for n in names}
        over = {n for n in names if n not in full and target[n] > 2 * sizes[n] + 1e-9}
        if not over:
            return target
        full |= over


def test_mixing_meets_targets(spark, odd, none):
    from lendfeat.llm import mixing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got, pieces = mixing.mix(docs)
    got = got.join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    target = _targets(sizes, list(sizes))
    assert len(got) == 1000 and all(abs(r["target"] - target[r["source"]]) < 1e-6 * r["target"] + 1e-6 for r in got)
    assert all(abs(taken[s] - target[s]) < 1.01 for s in sizes)
    # low discrepancy: every eighth of the schedule holds about its share of each source
    last = pieces.agg(F.max("slot")).first()[0]
    shares = pieces.groupBy("source_no", (F.col("slot") * 8 / (last + 1)).cast("int").alias("part")).agg(F.sum("length").alias("n")).where("part < 8").collect()
    whole = {}
    for r in shares:
        whole[r["source_no"]] = whole.get(r["source_no"], 0) + r["n"]
    assert all(abs(r["n"] - whole[r["source_no"]] / 8) <= 4 * mixing.BLOCK for r in shares)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(5))[0].collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}
    out = mixing.mix(odd)[0].collect()
    assert len(out) == 11 and {r["taken"] for r in out if r["doc_id"] in (3, 4, 5)} == {0}
    assert mixing.mix(none)[0].count() == 0


def test_places_and_mix_depend_on_rows_alone(spark):
    """The same rows in other partitions and another order, with a hot key, equal rows and null keys."""
    from lendfeat.llm import mixing, sharding

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source")
    hot = docs.where("doc_id < 3000").select(F.lit(7).cast("long").alias("doc_id"), "text", "source")
    equal = spark.range(9000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same words").alias("text"), F.lit("src1").alias("source"))
    docs = docs.unionByName(hot).unionByName(equal).unionByName(docs.where("doc_id < 50").withColumn("doc_id", F.lit(None).cast("long"))).checkpoint()
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    mixed, placed = [], []
    for n in (1, 7, 40):
        other = docs.repartition(n) if n > 1 else docs.coalesce(1).orderBy(F.desc("doc_id"))
        mixed.append(order(mixing.mix(other)[0].select("doc_id", "size", "taken")))
        placed.append(order(sharding.assign(other, 24)))
    assert mixed[0] == mixed[1] == mixed[2] and placed[0] == placed[1] == placed[2]
    slots = {}
    for r in placed[0]:
        slots.setdefault(r[3], []).append(r[4])
    assert len(placed[0]) == docs.count() and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 24)), 2)
    x[7] = x[9]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(400, None), (420, [0.0] * 24), (440, [float("nan")] * 24), (460, [None] * 24), (480, []), (None, [1.0] * 24), (500, [1.0] * 3), (520, [2.0] * 3), (0, rows[0][1])]
    return x, spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, score int")


def _best(x, q, k):
    s = np.zeros(len(x))
    for d in range(x.shape[1]):
        s += x[:, d] * x[q, d]
    s[q] = -np.inf
    return [(int(j), float(s[j])) for j in np.lexsort((np.arange(len(x)), -s))[:k]]


@pytest.mark.parametrize("small", [False, True])
def test_searches_equal_brute_force(spark, vectors, monkeypatch, small):
    from lendfeat.llm import _tiles, ann_blocks, topk_uniform

    if small:  # many tiles
        monkeypatch.setattr(_tiles, "CANDIDATES", 60)
        monkeypatch.setattr(_tiles, "QUERIES", 7)
    x, df = vectors
    got = ann_blocks.search(df, F.col("vec_id") % 20 == 0, k=20).collect()
    for q in range(0, 400, 20):
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == _best(x, q, 20)
    assert {(r["query_id"], r["vec_id"]) for r in got if r["query_id"] >= 400} == {(500, 520), (520, 500)}
    got = topk_uniform.search(df, F.col("vec_id") % 50 == 0, k=5).collect()
    for q in range(0, 400, 50):
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == _best(np.floor(256 * x), q, 5)
    empty = df.where("vec_id < 0")
    assert ann_blocks.search(empty, F.col("vec_id") % 20 == 0).count() == topk_uniform.search(empty, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("lists", [1, 2, 5, 99])
def test_uniform_threshold_collects_few_and_loses_none(spark, monkeypatch, lists):
    from lendfeat.llm import _tiles, topk_uniform

    monkeypatch.setattr(_tiles, "CANDIDATES", 500)
    monkeypatch.setattr(_tiles, "QUERIES", 16)
    rng = np.random.default_rng(8)
    x = rng.integers(-200, 200, (1500, 16)).astype(float)
    x[500:1000] = x[500]  # a third of the rows are copies, queries among them
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x / 256)], "vec_id long, embedding array<double>")
    found = topk_uniform.phases(df, F.col("vec_id") % 50 == 0, k=5, lists=lists)
    got = found.result.collect()
    for q in range(0, 1500, 50):
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == _best(x, q, 5), q
    cells = 30 * 1001 * min(lists, 16)
    n = found.collected.count()
    assert 0 < n < (0.15 if lists < 3 else 0.5) * cells
    if lists > 1:  # every total that reaches the cutoff is collected, and only resolved as far as it lacks partial scores
        assert found.collected.groupBy("query_id", "id").count().where(f"count < {min(lists, 16)}").count() > 0


def test_uniform_threshold_beyond_doubles(spark):
    from lendfeat.llm import topk_uniform

    x = [[2**20 + 0.0, 1.0], [2**20 + 1 / 256, 1.0], [2**20 + 2 / 256, 1.0], [-(2.0**20), 1.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    whole = [[int(256 * c) for c in v] for v in x]
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in topk_uniform.search(df, F.col("vec_id") == 2, k=3).collect()}
    assert got == {(2, i): sum(a * b for a, b in zip(whole[2], whole[i])) for i in (0, 1, 3)}


def test_pipeline_stages(spark, odd, none):
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    from lendfeat.llm.queries import tokenizer_path

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, kept[-1], SF).cache()
        assert out.columns == docs.columns, name
        kept.append(out)
    _, language, single, clean, mixed = kept
    assert 0.9 * docs.count() < language.count() <= docs.count()
    assert single.count() == single.select("doc_id").distinct().count() < language.count()
    assert clean.count() == single.count() and clean.where(r"text rlike '[A-Za-z0-9]@[A-Za-z0-9-]+\\.'").count() == 0
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    packed = P.STAGES[-1][1](spark, mixed, SF)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    assert packed.agg(F.sum("length")).first()[0] == sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed.collect())
    for table in (odd, none):
        for name, stage in P.STAGES:
            table = stage(spark, table, SF)
        assert "sequence_id" in table.columns and table.count() >= 0


def test_pipeline_decides_by_row(spark):
    """Repeated and missing ids, equal rows, and columns that carry the stages' own names."""
    import corpus_pipeline as P

    from lendfeat.llm import mixing

    base = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) between 400 and 900").orderBy("doc_id").limit(40).collect()]
    texts = list(dict.fromkeys(base))[:24]
    near = texts[0] + " and one more"
    rows = [(5, t, "en", "a") for t in texts[:8]] + [(None, t, "en", "b") for t in texts[8:16]] + [(i, t, "en", "b") for i, t in enumerate(texts[16:], 100)]
    rows += [(5, near, "en", "a"), (None, texts[8], "en", "b"), (7, texts[1], "en", "a"), (100, texts[16], "en", "b")]
    names = ["rows", "_id", "_size", "_copies", "_stays", "__row_key", "__rows", "class", "taken"]
    docs = spark.createDataFrame([(*r, *[1] * len(names)) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names)).checkpoint()
    single = P.drop_near_copies(spark, docs, SF).checkpoint()
    # one of each text: the smallest id stays, a missing one last
    got = sorted((r["text"], r["doc_id"]) for r in single.collect())
    first = {}
    for d, t, *_ in rows:
        t = texts[0] if t == near else t
        first.setdefault(t, []).append(d)
    want = {t: min(x for x in d if x is not None) if any(x is not None for x in d) else None for t, d in first.items()}
    assert single.columns == docs.columns and len(got) == len(want)
    assert {(texts[0] if t == near else t): d for t, d in got} == want
    mixed = P.mix_sources(spark, single, SF)
    taken, _ = mixing.mix(single)
    size = {r["text"]: r["n"] for r in single.select("text", F.regexp_count("text", F.lit(mixing.WORD)).alias("n")).collect()}
    times = {}
    for r in mixed.collect():
        times[r["text"]] = times.get(r["text"], 0) + 1
    assert mixed.columns == docs.columns
    assert abs(sum(n * size[t] for t, n in times.items()) - taken.agg(F.sum("taken")).first()[0]) <= sum(size.values()) / 2
    assert all(n <= 2 for n in times.values())
    equal = single.limit(1).join(spark.range(6).drop("id"))
    assert P.drop_near_copies(spark, equal, SF).count() == 1
    sized = equal.select("text").first()["text"]
    emitted, took = P.mix_sources(spark, equal, SF).count(), mixing.mix(equal)[0].agg(F.sum("taken")).first()[0]
    assert abs(emitted * size[sized] - took) <= 3 * size[sized]


def test_registration_without_the_subpackage():
    code = "import sys; sys.modules['lendfeat.llm'] = None; import __spark_entry__ as e; print(any(k.startswith('op') or k == 'pipeline' for k in [*e.queries(), *e.oracle_sql()]), 'client_features' in e.queries(), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0])
    assert out.stdout.split() == ["False", "True", "53"], out.stderr

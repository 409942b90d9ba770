"""Language ID, Jaccard join, toxicity, license scan, packing, PII: edge cases and brute force."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_accuracy_and_odd_rows(spark, docs, odd, none):
    from lendfeat.llm import language_id as L

    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = L.fit(docs.where(~held))
    out = L.identify(docs.where(held), model)
    assert out.where("lang = lang_pred").count() > 0.95 * out.count()
    got = L.identify(odd, model).select("doc_id", "lang_pred", "score", "slot").collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 and r["slot"] == 1 for r in got)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {3, 4, 5, 7}
    assert L.identify(none, model).count() == 0
    untrained = L.identify(odd, L.fit(none))
    assert untrained.where("lang_pred = 'und' and score = 0").count() == 11


def test_filter_names_all_languages_of_a_gram():
    from lendfeat.llm import language_id as L

    masks = np.zeros((1, 1 << L.SLOT_BITS), np.uint8)
    for n, word in enumerate(["haus", "house"]):
        for _, h in L._ngrams(np.frombuffer(f" {word} \n".encode(), np.uint8)):
            for s in L._slots(h):
                masks[0][s] |= 1 << n
    hits, total = L._counts(pa.array(["haus", "house", "xyzxyz"]), L.LanguageFilter(["de", "en"], masks, np.zeros(2)))
    assert hits[0, 0] == total[0] > hits[0, 1] and hits[1, 1] == total[1] > hits[1, 0] and not hits[2].any()


def _brute(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[0-9a-z_\x80-\U0010ffff]+", (t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    near = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    label = list(range(len(sets)))
    while any(label[i] != label[j] for i, j in near):
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    return near, label


def test_jaccard_join_equals_all_pairs(spark, docs, odd, none):
    from lendfeat.llm import jaccard_join as J

    rows = docs.orderBy("doc_id").select("doc_id", "text").limit(220).collect()
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    texts = [r["text"] for r in rows] + [" ".join(base), " ".join([*base, "more"]), " ".join(["less", *base, "more"]), "few words", "Few, words!"]
    got = J.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    near, label = _brute(texts)
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in got} == {i: (label[i], sum(a == i for a, _ in near)) for i in range(len(texts))}
    out = {r["doc_id"]: r for r in J.join(odd).collect()}
    assert (out[1]["class_id"], out[1]["links"], out[2]["links"]) == (1, 2, 2) and out[3]["links"] == 0 and J.join(odd).count() == 11
    assert J.join(none).count() == 0


def test_jaccard_splits_a_large_bucket(spark, monkeypatch):
    from lendfeat.llm import jaccard_join as J

    monkeypatch.setattr(J, "BLOCK", 7)
    word = [f"w{i}" for i in range(80)]
    texts = [" ".join(word[:40] + [f"x{i}"] + word[40:]) for i in range(40)]
    got = J.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["class_id"], r["links"]) for r in got} == {(0, 39)}


def test_forest_shortens_prefixes_until_the_recall():
    from lendfeat.llm import jaccard_join as J

    levels = J.LONGEST - J.shortest_length(0.8) + 1
    miss = lambda depths: np.prod(1 - 0.8 ** depths.astype(float))
    alone = J.shorten(np.ones((1, J.TREES, levels)), 0.8)
    assert (alone == J.shortest_length(0.8)).all()  # no neighbours: all steps are free
    sizes = np.ones((2, J.TREES, levels))
    sizes[0, :8] = [900, 90, 9, 3][-levels:]  # crowded branches in half the trees
    sizes[1] = np.array([4000, 300, 20, 2][-levels:]) * np.arange(1, J.TREES + 1)[:, None]
    deep = J.shorten(sizes, 0.8)
    assert (deep[0, :8] > deep[0, 8:]).all() and len(set(deep[1].tolist())) > 1 and deep[1].max() > deep[1].min()
    assert all(1 - miss(d) >= J.RECALL for d in deep)
    # one step back down anywhere that wasn't free falls below the recall or was the cheapest
    full = np.full(J.TREES, J.LONGEST)
    assert 1 - miss(full) < J.RECALL and (J.shorten(sizes, 0.8, 0.5)[1] == full).all()


def test_forest_on_a_skewed_corpus(spark):
    """Copies with few edits beside texts that share a passage: every planted pair is found, no other one."""
    from lendfeat.llm import jaccard_join as J

    rng = np.random.default_rng(9)
    word = [f"w{i}" for i in range(4000)]
    texts, passage = [], list(rng.choice(word, 60))
    for _ in range(60):
        base = list(rng.choice(word, 150))
        texts += [" ".join(base), " ".join([*base[:-3], "x", "y"]), " ".join(["z", *base[1:]])]
    hot = list(rng.choice(word, 150))
    texts += [" ".join([*hot[: i % 100 + 20], f"h{i}", *hot[i % 100 + 20 :]]) for i in range(150)]
    texts += [" ".join([*rng.choice(word, 60), *passage, *rng.choice(word, 60)]) for _ in range(150)]
    near, label = _brute(texts)
    got = {r["doc_id"]: r for r in J.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(r["links"] for r in got.values()) >= 0.9997 * len(near) and all(got[i]["links"] <= sum(a == i for a, _ in near) for i in (0, 200, 400))
    assert {i: r["class_id"] for i, r in got.items()} == dict(enumerate(label))


def test_components_of_a_path(spark):
    from lendfeat.llm import jaccard_join as J

    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "a long, b long")
    assert {r["cls"]: r["label"] for r in J.components(edges).collect()} == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}


def test_toxicity_finds_planted_words(spark, odd, none):
    from lendfeat.llm import toxicity as X

    rng = np.random.default_rng(3)
    word = [f"w{i}" for i in range(300)]
    def text(toxic):
        w = list(rng.choice(word, 60))
        for i in rng.choice(60, 3, replace=False) if toxic else ():
            w[i] = ["vile", "moron"][i % 2]
        return " ".join(w)
    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = X.fit(df.where("doc_id < 1000"))
    out = X.score(df.where("doc_id >= 1000"), model)
    assert out.where("predicted = toxic").count() > 490
    got = X.score(odd.drop("score"), model).collect()
    assert len(got) == 11 and len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    assert X.score(none.drop("score"), model).count() == 0
    assert X.score(odd.drop("score"), X.fit(none.withColumn("toxic", F.lit(1)))).where("score = 0 and predicted = 0").count() == 11


def test_toxicity_scores_alike_with_and_without_held_words(spark, odd, none, monkeypatch):
    from lendfeat.llm import toxicity as X

    rng = np.random.default_rng(6)
    words = [f"{'bad' if j < 40 else 'w'}{j}" for j in range(400)]
    rows = []
    for i in range(600):
        toxic = int(i % 3 == 0)
        # half of the ordinary texts are equal, one word is in every text
        picked = np.arange(100, 130) if not toxic and i % 2 else rng.choice(np.arange(0 if toxic else 40, 400), 30)
        rows.append((i, " ".join(["the", *(words[j] for j in picked)]), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    clash = odd.withColumn("_text", F.lit("x")).withColumn("_found", F.lit(1))
    held = X.fit(df)
    monkeypatch.setattr(X, "HELD_WORDS", 10)
    joined = X.fit(df)
    assert held.table is None and len(held.words) and joined.table is not None and not len(joined.words)
    assert np.allclose(held.curve, joined.curve) and held.unknown == joined.unknown
    for docs in (df, clash, none):
        want, got = (sorted((repr(r["doc_id"]), r["predicted"], round(r["score"], 9)) for r in X.score(docs, m).collect()) for m in (held, joined))
        assert want == got and len(got) == docs.count()
    assert set(X.score(clash, joined).columns) == set(clash.columns) - {"_text", "_found"} | {"whole", "expression", "score", "predicted"}


def test_toxicity_counts_predecessors_of_hot_words_exactly(spark):
    from lendfeat.llm import toxicity as X

    # each hot word is seen some 100,000 times, always after one of 50 words
    hot, after = [f"vile{j}" for j in range(5)], [f"w{i}" for i in range(50)]
    rows = [(f"t{n} " + " ".join([f"{w} {h}" for w in after for h in hot] * 40), 1) for n in range(56)]
    rows += [(f"o{n} " + " ".join(f"{w} mild{j}" for w in after for j in range(5)), 0) for n in range(56)]
    model = X.fit(spark.createDataFrame(rows, "text string, toxic int"))
    d = model.differences(pa.array([*hot, *[f"mild{j}" for j in range(5)]]))[:, 0]
    assert (d[:5] > 1).all() and (d[5:] < -1).all() and np.ptp(d[:5]) < 1e-6 and np.ptp(d[5:]) < 1e-6


def test_toxicity_keeps_words_apart(spark):
    from lendfeat.llm import _text as T
    from lendfeat.llm import toxicity as X

    # ordinary words that share the upper 21 bits of their hash with the toxic one
    def upper(words):
        data = "".join(f"{w}\n" for w in words).encode()
        return T.words(np.frombuffer(data, np.uint8), np.array([len(data)]))[0] >> np.uint64(43)
    many = [f"c{i}" for i in range(1 << 22)]
    mild = [many[i] for i in np.flatnonzero(upper(many) == upper(["vile"]))]
    assert mild
    rows = [(f"w{n} vile", 1) for n in range(200)] + [(f"w{n} {mild[0]} x{n} so", 0) for n in range(400)]
    model = X.fit(spark.createDataFrame(rows, "text string, toxic int"))
    d = model.differences(pa.array(["vile", mild[0]]))[:, 0]
    assert d[0] > 1 and d[1] < -1


def test_toxicity_keeps_rare_expressions(spark):
    from lendfeat.llm import toxicity as X

    rng = np.random.default_rng(9)
    word = [f"w{i}" for i in range(500)]
    rows = [(" ".join(rng.choice(word, 20)), int(i % 2)) for i in range(1000)]
    rows += [(f"{word[i]} vile{i // 5} {word[i + 1]} n{i}", 1) for i in range(30)]
    model = X.fit(spark.createDataFrame(rows, "text string, toxic int"))
    d = model.differences(pa.array([f"vile{j}" for j in range(6)]))[:, 0]
    assert (d > 1).all()
    assert X.discounts([0, 1, 1, 1]) == X.FALLBACK and np.allclose(X.discounts([100, 40, 20, 10]), [1 - 80 / 180, 2 - 3 * 20 * 100 / 180 / 40, 3 - 4 * 10 * 100 / 180 / 20])


def test_license_spans_and_repeats(spark, odd, none):
    from lendfeat.llm import license_scan as S

    notice = "This work is licensed under the GNU General Public License, version 3"
    changed = "This nice work is licensed under a GNU General Public License, version 3"
    rows = [(1, f"é x {notice}. y {notice}."), (2, changed), (3, "this work is under version 3"), (4, None)]
    got = S.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("license = 'GPL-3.0'").collect()
    assert [rows[0][1][r["start"] : r["end"]] for r in got if r["doc_id"] == 1] == [notice, notice]
    assert [(r["doc_id"], round(r["coverage"], 3)) for r in got if r["doc_id"] != 1] == [(2, round(11 / 12, 3))]
    assert S.scan(odd).count() == 0 and S.scan(none).count() == 0
    assert S.align(list("abcxdef"), list("zabcdyef")) == [(0, 1), (1, 2), (2, 3), (4, 4), (5, 6), (6, 7)]


def test_license_near_misses(spark):
    from lendfeat.llm import license_scan as S

    want = {
        "GNU General Public License, version 2": None,
        "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
        "This work is licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0",
        "This work is licensed under the GNU General Public License, version 4": None,
        "Released under the BSD License": "BSD",
        "Released under the MIT License": "MIT",
        "Licensed under CC BY 4.0": "CC-BY-4.0",
        "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0",
        "Licensed under CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
        "Licensed under CC BY-NC 3.0": None,
        "Licensed under the Apache License, Version 2.1": None,
        "Licensed under the Apache License, Version 2.0": "Apache-2.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "CC-BY-4.0 long",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License": "CC-BY-ND-4.0 long",
        S.TEXTS["MIT whole"].text: "MIT whole",
        S.TEXTS["GPL-2.0 header"].text: "GPL-2.0 header",
        S.TEXTS["BSD-3-Clause text"].text: "BSD-3-Clause text",
    }
    rows = [(i, f"Words before. {t}. Words behind.") for i, t in enumerate(want)]
    rows += [(None, "x " * 50_000 + "Released under the MIT License"), (None, "Released under the MIT License")]
    got = S.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["license"] for r in got if r["doc_id"] is not None} == {i: n for i, n in enumerate(want.values()) if n}
    assert sorted(r["license"] for r in got if r["doc_id"] is None) == ["MIT", "MIT"] and len(got) == 2 + sum(n is not None for n in want.values())


def test_license_scan_equals_every_window(spark):
    """Alignment against the longest common subsequence, hits against all windows of a text tried one by one."""
    from lendfeat.llm import license_scan as S

    rng = np.random.default_rng(4)
    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old, row = row, [0]
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
        return row[-1]
    for letters in (8, 40):
        for _ in range(60):
            a, b = (rng.integers(0, letters, 20).tolist() for _ in range(2))
            pairs = S.align(a, b)
            assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:])) and len(pairs) <= longest(a, b)
    for _ in range(60):  # without repeated words the alignment is the longest
        a, b = (rng.permutation(30)[:20].tolist() for _ in range(2))
        assert len(S.align(a, b)) >= longest(a, b) - (a[0] == b[0]) - (a[-1] == b[-1])

    words = "licensed under the mit license version 2 apache 0 work this is a cc by nc 4 gnu general public 3 other".split()
    texts = [" ".join(rng.choice(words, 40)) for _ in range(150)]
    texts += [f"{' '.join(rng.choice(words, 5))} {t.text} {' '.join(rng.choice(words, 5))} {t.text}" for t in S.TEMPLATES.values()]
    want = set()
    for d, text in enumerate(texts):
        spans = [m.span() for m in re.finditer(r"[0-9a-z_\x80-\U0010ffff]+", text.lower())]
        own, hits = [text.lower()[a:b] for a, b in spans], []
        for name, t in S.TEMPLATES.items():
            m = re.findall(r"[0-9a-z_\x80-\U0010ffff]+", t.text.lower())
            telling = [re.findall(r"[0-9a-z_\x80-\U0010ffff]+", p.lower()) for p in t.telling]
            need, p = int(np.ceil(S.COVERAGE * len(m))), 0
            while p < len(own):
                pairs = S.align(m, own[p : p + int(S.STRETCH * len(m)) + 1])
                at = dict(pairs)
                tells = all(any(m[i : i + len(f)] == f and all(i + k in at and at[i + k] == at[i] + k for k in range(len(f))) for i in at) for f in telling)
                if len(pairs) >= need and pairs[0][1] == 0 and tells:
                    hits.append((len(pairs), len(pairs) / len(m), name, p, p + pairs[-1][1]))
                    p += pairs[-1][1]
                p += 1
        kept = []
        for h in sorted(hits, key=lambda h: (-h[0], -h[1], h[2], h[3])):
            if all(h[4] < k[3] or h[3] > k[4] for k in kept):
                kept.append(h)
        want |= {(d, h[2], spans[h[3]][0], spans[h[4]][1]) for h in kept}
    got = S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"], r["start"], r["end"]) for r in got} == want and len(got) == len(want) and len(want) > 2 * len(S.TEMPLATES) - 5


def test_packing_round_trip(spark, docs, odd, none):
    from tokenizers import Tokenizer

    from lendfeat.llm import packing as K
    from lendfeat.llm.queries import tokenizer_path

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = docs.limit(150).select("doc_id", "text").unionByName(odd.where("doc_id > 2").select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text"))
    out = K.pack(rows, tokenizer_path(), with_ids=True).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    of = {}
    for r in out:
        of.setdefault(r["doc_id"], []).append(r)
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    assert of.keys() == texts.keys()
    for d, pieces in of.items():
        pieces.sort(key=lambda r: r["start"])
        ids = [i for r in pieces for i in r["ids"]]
        assert ids == tokenizer.encode(texts[d], add_special_tokens=False).ids + [1] and all(r["doc_tokens"] == len(ids) for r in pieces)
        assert [r["start"] for r in pieces] == list(np.cumsum([0, *[r["length"] for r in pieces]])[:-1])
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == list(np.cumsum([0, *[r["length"] for r in pieces]])[:-1]) and sum(r["length"] for r in pieces) <= 2048
    assert sum(r["length"] for r in out) > 0.9 * 2048 * len(sequences)
    assert K.pack(odd, tokenizer_path()).select("doc_id").where("doc_id is null").count() == 1 and K.pack(none, tokenizer_path()).count() == 0


_REFERENCE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _valid(kind, value):
    d = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def test_base_spans_equal_python(spark, docs, odd, none):
    from lendfeat.llm import pii

    extra = ["a@b.c_d@e.f x@y..z", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004", "+1 (456) 555-2186 4111 1111 1111 1111 x", "é\U0001F600 q@w.de\x01", "4111-1111-1111-1111 4111111111111112"]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10**7 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    found, _ = pii.find(rows)
    n = 0
    for r in found.select("text", pii.listed(list(pii.KINDS)).alias("spans")).collect():
        want = ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in _REFERENCE.items() for m in re.finditer(p, r["text"] or "") if _valid(k, m.group()))
        assert r["spans"] == want
        n += want != ""
    assert n > 40
    assert pii.find(odd)[0].count() == 11 and pii.find(none)[0].count() == 0
    long = spark.createDataFrame([(1, "1 " * 30_000 + "+1" + "(" * 30_000)], "doc_id long, text string")
    assert pii.find(long)[0].count() == 1


def test_disclosing_terms(spark):
    from lendfeat.llm import pii

    rows = [(i, f"note {i} from zorblatt at jane@corp.example today w{i}") for i in range(12)] + [(100 + i, f"note {i} from nobody today v{i}") for i in range(60)] + [(200, "zorblatt again")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _terms string").drop("_terms")
    found, terms = pii.find(df)
    assert {r["term"] for r in terms.select("term").distinct().collect()} == {"zorblatt", "at"}
    assert {r["doc_id"]: [s["value"] for s in r["term"]] for r in found.where("doc_id in (0, 200)").collect()} == {0: ["zorblatt", "at"], 200: ["zorblatt"]}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df, terms).collect()}
    assert clean[0] == "note 0 from <WORD> <WORD> <EMAIL> today w0" and clean[200] == "<WORD> again" and clean[100] == rows[12][1]


def test_disclosing_terms_of_rare_entities_and_far_words(spark):
    from lendfeat.llm import pii

    fill = " ".join(f"and word {i % 9}" for i in range(100))
    rows = [(i, f"Kwibble notes{i} {fill} write to kw@corp.example") for i in range(3)]
    rows += [(10 + i, f"hello {fill} no{i}") for i in range(40)] + [(100, f"once {fill} call +1 456 555 2186")]
    found, _ = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: {s["value"] for s in r["term"]} for r in found.collect()}
    assert all(got[i] == {"Kwibble", "write", "to"} for i in range(3)) and not any(got[i] for i in (10, 100))


def test_disclosure_counts_equal_brute_force(spark):
    """Protected values and their parts, distinct texts, n(e), n(t), n(t, e), and the smoothed score of every pair."""
    import math
    import random

    from lendfeat.llm import pii

    rng = random.Random(4)
    words = [f"w{i}x" for i in range(60)]  # a digit before a number would belong to it
    values = ["ann.lee@a.example", "bob@a.example", "ann@b.example", "10.1.2.3", "10.1.2.9", "+1 456 555 2186", "4111 1111 1111 1111"]
    texts = []
    for i in range(120):
        own = rng.sample(words, rng.randint(3, 12))
        for v in rng.sample(values, rng.choice([0, 0, 0, 1, 2])):
            own += [f"{v} k{values.index(v)}k"]
        rng.shuffle(own)
        texts.append(" ".join(own))
    texts += texts[:30] + [None, ""]  # exact copies count once
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    parts = {"ann.lee@a.example": ["domain a.example", "name ann", "name lee"], "bob@a.example": ["domain a.example", "name bob"], "ann@b.example": ["domain b.example", "name ann"],
             "10.1.2.3": ["net 10.1.2"], "10.1.2.9": ["net 10.1.2"], "+1 456 555 2186": ["phone 145655"], "4111 1111 1111 1111": ["card 411111"]}
    distinct = {t for t in texts if t is not None}
    entities, terms, both = {}, {}, {}
    for t in distinct:
        held = [v for v in values if v in t]
        held = {*held, *(p for v in held for p in parts[v])}
        bare = t
        for v in values:
            bare = bare.replace(v, " ")
        for w in set(t.split()) if not held else set(bare.split()):
            if held:
                for e in held:
                    both[w, e] = both.get((w, e), 0) + 1
        for e in held:
            entities[e] = entities.get(e, 0) + 1
        for w in set(re.findall(r"\w+", t)):
            terms[w] = terms.get(w, 0) + 1
    want = {}
    for (w, e), n in both.items():
        pe = entities[e] / len(distinct)
        p = (n + 2 * pe) / (terms[w] + 2)
        if p >= 0.5:
            want[w] = max(want.get(w, -9), math.log2(p / pe))
    _, got = pii.find(df)
    found = {(r["term"], round(r["bits"], 9)) for r in got.collect()}
    assert found == {(w, round(b, 9)) for w, b in want.items()} and len(found) > 5


def test_spans_of_very_many_matches(spark):
    import time

    from lendfeat.llm import pii

    text = " ".join(f"é u{i}@x{i}.example" for i in range(5000))
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    r = pii.base_spans(rows).select(pii.listed(["email"]).alias("s")).first()
    assert r["s"] == ",".join(f"email:{m.start()}:{m.end()}" for m in re.finditer(_REFERENCE["email"], text)) and time.time() - began < 30


def test_labels_beside_clashing_columns(spark, odd):
    from lendfeat.llm import toxicity as X

    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    clash = odd.withColumn("toxic", F.lit(7)).withColumn("label", F.lit("x"))
    assert {(r["doc_id"], r["toxic"]) for r in X.labelled(clash, labels).collect()} == {(1, 0), (2, 1)}

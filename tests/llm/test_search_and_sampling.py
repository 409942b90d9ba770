"""SentencePiece agenda, ranked lexical search, importance resampling: brute force and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="module")
def coder():
    from lendfeat.llm import queries
    from lendfeat.llm.piece_agenda import PieceAgenda

    return PieceAgenda(queries.piece_model_path())


def _lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# --- SentencePiece ---------------------------------------------------------------------------


def test_agenda_equals_library_on_whole_texts(spark, docs, coder):
    from lendfeat.llm import piece_agenda as S
    from lendfeat.llm.queries import piece_model_path

    got = {r["doc_id"]: r for r in S.encode(docs, piece_model_path()).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = coder.library.encode(r["text"] or "", add_eos=True)
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(coder.library.decode(ids).encode()).hexdigest()


def test_agenda_on_marks_bytes_and_long_segments(coder, monkeypatch):
    from lendfeat.llm import piece_agenda as S

    rng = random.Random(3)
    alphabet = "ab ▁  éﬁ漢字\x00\n\tHe<0xA>\U0001f600 é"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    texts += ["", " ", "  ", "▁", "a" * 3000, " " * 3000, "漢" * 1000, "the" * 2000, "</s> <0x0A> <unk>"]
    want = coder.library.encode(texts, add_eos=True)
    assert coder.encode(texts) == want and coder.encode(texts[::-1]) == want[::-1]
    assert coder.encode([]) == [] and coder.encode([""]) == [[coder.end]]
    # both agendas agree, and an overfull table starts anew without another result
    monkeypatch.setattr(S, "LONG", 0)
    monkeypatch.setattr(S, "KNOWN", 50)
    coder.clear()
    assert coder.encode(texts) == want and coder.encode(texts[100:200]) == want[100:200]
    coder.clear()


def test_a_wrong_agenda_is_found_by_the_check(coder):
    ids, counts = coder.segment_ids(np.array([ord(c) for c in "▁hello"]), np.array([6]))
    coder.check(["▁hello"], ids, counts)
    with pytest.raises(ValueError, match="disagree"):
        coder.check(["▁hello"], ids + 1, counts)


def test_encoding_of_odd_rows(odd, none, coder):
    from lendfeat.llm import piece_agenda as S
    from lendfeat.llm.queries import piece_model_path

    got = S.encode(odd, piece_model_path(), with_ids=True).collect()
    assert len(got) == 11
    for r, text in zip(got, [x["text"] for x in odd.collect()]):
        assert r["decoded"] == (text or "") and r["ids"] == coder.library.encode(text or "", add_eos=True)
    assert [r["n_tokens"] for r in got if r["doc_id"] in (3, 4)] == [1, 1]
    assert S.encode(none, piece_model_path()).count() == 0


# --- ranked lexical search ---------------------------------------------------------------------


def _ranked(docs, items, k=10):
    """docs and items: (id, text) rows."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(t))
    rows = [(d, Counter(cut(t))) for d, t in docs]
    rows = [(d, c, sum(c.values())) for d, c in rows if c]
    n_docs, n_all = len(rows), sum(n for _, _, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(cut(t))
    out = set()
    for i, terms in asked.items():
        scores = []
        for no, (d, c, n) in enumerate(rows):
            m = 10 + 90 * n * n_docs // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, no, d))
        out |= {(i, r + 1, s[4], -s[0]) for r, s in enumerate(sorted(scores)[:k])}
    return out


def _rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_search_equals_brute_force(spark, docs, items):
    from lendfeat.llm import lexical_search as S

    want = _ranked(_rows(docs, "doc_id", "text"), _rows(items, "item_id", "text"))
    assert set(_rows(S.search(docs, items), "item_id", "rank", "doc_id", "score")) == want
    # several blocks of items, another partitioning
    assert set(_rows(S.search(docs.repartition(5), items, block_terms=300), "item_id", "rank", "doc_id", "score")) == want


def test_search_of_odd_rows(spark, odd, none):
    from lendfeat.llm import lexical_search as S

    asked = [(1, "The quick fox, der Fuchs; WORD a!"), (2, None), (3, "!!"), (None, "fox"), (None, "word"), (4, "zzzz"), (5, "word")]
    items = spark.createDataFrame([(*r, 7, "x", 0.5) for r in asked], "item_id long, text string, rank int, term string, score double")
    got = _rows(S.search(odd, items, k=3), "item_id", "rank", "doc_id", "score")
    assert len(got) == len(set(got)) and set(got) == _ranked(_rows(odd, "doc_id", "text"), asked, 3)
    assert S.search(none, items).count() == 0 and S.search(odd, items.where("false")).count() == 0


def test_blocks_of_small_postings_and_few_visits_change_nothing(docs, items):
    """Work of one task by hand: small blocks, and strata that are never visited."""
    from lendfeat.llm import lexical_search as S

    rng = np.random.default_rng(5)
    m = np.sort(rng.integers(10, 400, 3000))
    term = [np.sort(rng.choice(50, rng.integers(1, 12), replace=False)) for _ in m]
    sizes, flat = np.array([len(t) for t in term]), np.concatenate(term)
    tf = rng.integers(1, 6, len(flat))
    block = S._Block(m, sizes, flat, tf, 50)
    terms, weights = np.array([3, 17, 40]), np.array([900, 5000, 40])
    doc = np.repeat(np.arange(len(m)), sizes)
    want = np.zeros(len(m), np.int64)
    for t, w in zip(terms, weights):
        hit = flat == t
        np.add.at(want, doc[hit], w * ((10**9 * tf[hit]) // (1000 * tf[hit] + 8 * m[doc[hit]])))
    visits, best, seen = block.best(terms, weights, 1), np.zeros(0, np.int64), 0
    step = next(visits)
    while True:
        found, scores = step
        assert (scores == want[found]).all()
        seen += len(found)
        best = np.sort(np.append(best, scores))[::-1][:10]
        try:
            step = visits.send(int(best[-1]))
        except StopIteration:
            break
    assert best.tolist() == np.sort(want)[::-1][:10].tolist() and seen < (want > 0).sum() / 2


# --- importance resampling ---------------------------------------------------------------------


def _resampled(docs, target, percent=25):
    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]

    rows = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for *_, f in rows for b in f), Counter(b for x in target for b in features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    out = []
    for d, n, f in rows:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3], r[2]))
    drawn = percent * len(able) // 100
    ranked = [(d, n, w, s, i + 1 if i < drawn else None) for i, (d, _, n, w, s) in enumerate(able)]
    return Counter(ranked + [(d, n, w, s, None) for d, k, n, w, s in out if k < 20])


COLUMNS = "doc_id", "n_features", "weight", "score", "rank"


def test_resampling_equals_brute_force_with_any_head(spark, docs, items, monkeypatch):
    from lendfeat.llm import importance_resampling as R

    want = _resampled(_rows(docs, "doc_id", "text"), [r["text"] for r in items.collect()])
    assert Counter(_rows(R.resample(docs, items), *COLUMNS)) == want
    # the head only saves work
    monkeypatch.setattr(R, "frequent", lambda *_: R.no_head())
    assert Counter(_rows(R.resample(docs.repartition(5), items), *COLUMNS)) == want


def test_head_holds_what_is_frequent(docs):
    from lendfeat.llm import importance_resampling as R

    count = Counter()
    for r in docs.collect():
        count.update(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(r["text"])))
    found = {r["crc"] for r in R.candidates(docs).where("kind = 0").collect()}
    total = sum(count.values())
    assert {zlib.crc32(w.encode()) for w, n in count.items() if n * R.SHARE >= total} <= found
    top = R.frequent(docs, size=100)
    assert (top.words.keys != 0).sum() <= 100 and (top.pairs.keys != 0).sum() <= 100


def test_direct_crc():
    from lendfeat.llm import importance_resampling as R

    words = [b"a", b"", b"hello", b"x" * 47, b"y" * 48, b"z" * 500, "é漢".encode()]
    data = np.frombuffer(b"".join(words) + b"\n", np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    state = np.array([zlib.crc32(b"left")] * len(words), np.uint32)
    assert R.crc32(data, start, end, R._spaced(state)).tolist() == [zlib.crc32(b"left " + w) for w in words]


def test_resampling_of_odd_rows(spark, odd, none):
    from lendfeat.llm import importance_resampling as R

    target = spark.createDataFrame([("the lazy dog and the river bank",), (None,), ("",)], "text string")
    many = odd.unionByName(odd).unionByName(odd.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")))
    for t in (target, target.where("false")):
        got = R.resample(many, t, percent=60, least=5)
        want = _resampled(_rows(many, "doc_id", "text"), [r["text"] for r in t.collect()], 0)
        assert Counter(r[:4] for r in _rows(got, *COLUMNS)) == Counter(k[:4] for k in want.elements())
        ranks = sorted(r["rank"] for r in got.collect() if r["rank"] is not None)
        assert ranks == list(range(1, len(ranks) + 1)) and ranks
    assert R.resample(none, target).count() == 0
    assert all(r["n_features"] == r["weight"] == 0 for r in R.resample(odd.where("doc_id in (3, 4, 5)"), target).collect())

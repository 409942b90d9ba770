r"""Ranked lexical search over a length-stratified index.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
A document of n terms has the normaliser m = 10 + (90 n N) div L; a term weighs
w = floor(1000 ln((2 N + 2) / (2 df + 1))), and a document scores the sum of
w * ((1000000000 tf) div (1000 tf + 8 m)) over the item's distinct terms.

Index: documents are range-partitioned and sorted by m, so that those of equal m (a stratum) lie
together; a stratum may fill many partitions.  A task holds a block of them at a time.  Its postings
lie by term, stratum and falling tf, and the impact of a tf in a stratum is computed once.  A term's
highest tf in a stratum bounds what it can add there, so each item's strata are visited by falling
bound, in growing groups, until the bound stays below the item's k-th best score; that score is kept
for the task's later blocks.  Each task gives its k best of each item, and a window merges them.

Scale: the items are worked off in blocks of about ``TERMS`` distinct terms, whose table (8 bytes a
term) is broadcast and whose postings alone are indexed; every block reads the texts once.  A block of the
index holds at most ``POSTINGS`` postings or the one document that exceeds them.  Nothing is left out:
a pruned stratum can't reach the list.

Defined results: null text has no terms and is never found; items without terms get no rows, items that
share an id (also a null one) are one item; repeated documents are ranked each by itself; equal scores go to
the smaller doc_id, null last; empty tables give no rows.  Terms are told apart by 64-bit hashes.  Extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendfeat.llm import _text as T
from lendfeat.llm._store import settle

TERMS = 1 << 20
POSTINGS = 1 << 21
#: Documents in the first group of strata that is visited; each further group has twice as many.
VISIT = 64

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
MEMBER = T.IS_WORD & (_byte != 95)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, terms): the distinct term hashes of each item that has any."""

    def run(batches):
        for batch in batches:
            rows = []
            for at, data, ends in T.chunks(batch["text"], lower=False):
                h, _, _, stop = T.words(LOWER[data], ends, MEMBER)
                rows += [np.unique(h[a:b]).view(np.int64) for a, b in zip(T.begins(stop).tolist(), stop.tolist())]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(rows, pa.list_(pa.int64()))], ["item_id", "terms"])

    own = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).mapInArrow(run, "item_id long, terms array<long>")
    return own.where(F.size("terms") > 0).groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))


def index(docs: DataFrame, vocabulary: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document with terms: doc_id, n (its terms), and its postings in the vocabulary
    (sorted hashes): arrays term (place in it) and tf."""
    wanted = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = wanted.value
        for batch in batches:
            for at, data, ends in T.chunks(batch["text"], lower=False):
                h, _, _, stop = T.words(LOWER[data], ends, MEMBER)
                place = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
                held = np.flatnonzero(known[place] == h) if len(known) else np.zeros(0, np.int64)
                row = np.searchsorted(stop, held, "right")
                pair, tf = np.unique(row * max(1, len(known)) + place[held], return_counts=True)
                row, term = np.divmod(pair, max(1, len(known)))
                cut = np.append(0, np.cumsum(np.bincount(row, minlength=len(ends)))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, len(ends)), pa.array(np.diff(stop, prepend=0).astype(np.int64)), *lists], ["doc_id", "n", "term", "tf"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>").where("n > 0")


class _Block:
    """Postings of some documents, sorted by m, as (term, stratum) groups of falling tf."""

    def __init__(self, m: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int):
        opens = np.append(True, m[1:] != m[:-1])
        self.stratum = np.cumsum(opens) - 1
        self.strata = np.bincount(self.stratum)
        doc = np.repeat(np.arange(len(m)), sizes)
        of = self.stratum[doc]
        each, back = np.unique(np.stack([of, tf]), axis=1, return_inverse=True)
        each_m = m[opens][each[0]]
        impact = ((1_000_000_000 * each[1]) // (1000 * each[1] + 8 * each_m))[back.reshape(-1)]
        sort = np.lexsort((-tf, of, term))
        self.doc, self.impact = doc[sort], impact[sort]
        term, of = term[sort], of[sort]
        first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (of[1:] != of[:-1]))) if len(term) else np.zeros(0, np.int64)
        self.first, self.size = first, np.diff(np.append(first, len(term)))
        self.group_stratum, self.most = of[first], self.impact[first]
        self.groups = np.searchsorted(term[first], np.arange(n_terms + 1))
        self.total = np.zeros(len(m), np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, floor: int):
        """Yields (documents, scores) of groups of strata by falling bound; takes the next floor by send()."""
        n = self.groups[terms + 1] - self.groups[terms]
        groups, weight = T.spread(self.groups[terms], n), np.repeat(weights, n)
        bound = np.zeros(len(self.strata), np.int64)
        np.add.at(bound, self.group_stratum[groups], weight * self.most[groups])
        order = np.argsort(-bound, kind="stable")
        docs_to, at, visit = np.cumsum(self.strata[order]), 0, VISIT
        order_of = np.empty(len(order), np.int64)
        order_of[order] = np.arange(len(order))
        place = order_of[self.group_stratum[groups]]
        while at < len(order) and bound[order[at]] >= floor:
            to = max(at + 1, int(np.searchsorted(docs_to, (docs_to[at - 1] if at else 0) + visit, "right")))
            to = min(to, int(np.searchsorted(-bound[order], -floor, "right")))
            here = (place >= at) & (place < to)
            g = groups[here]
            posts = T.spread(self.first[g], self.size[g])
            found = self.doc[posts]
            np.add.at(self.total, found, np.repeat(weight[here], self.size[g]) * self.impact[posts])
            found = np.unique(found)
            scores = self.total[found]
            self.total[found] = 0
            floor = yield found, scores
            at, visit = to, visit * 2


def _search(k: int, items, n_terms: int, n_documents: int, n_all: int):
    """Task: blocks of sorted documents in, the k best (item, doc_id, score) of each item out."""

    def run(batches):
        ids, cut, terms, weights = items.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(ids)

        def work(parts):
            m, doc, absent = (np.concatenate([p[i] for p in parts]) for i in range(3))
            block = _Block(m, *(np.concatenate([p[i] for p in parts]) for i in (3, 4, 5)), n_terms)
            for i in range(len(ids)):
                score, own, null = best[i]
                visits = block.best(terms[cut[i] : cut[i + 1]], weights[cut[i] : cut[i + 1]], max(1, score[-1]) if len(score) == k else 1)
                step = next(visits, None)
                while step is not None:
                    found, total = step
                    floor = max(1, score[-1]) if len(score) == k else 1
                    keep = total >= floor
                    found, total = found[keep], total[keep]
                    score, own, null = np.append(score, total), np.append(own, doc[found]), np.append(null, absent[found])
                    top = np.lexsort((own, null, -score))[:k]
                    score, own, null = score[top], own[top], null[top]
                    try:
                        step = visits.send(max(1, score[-1]) if len(score) == k else 1)
                    except StopIteration:
                        step = None
                best[i] = score, own, null

        parts, held = [], 0
        for batch in batches:
            n = batch["n"].to_numpy()
            term, tf = batch["term"], batch["tf"]
            absent = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            part = 10 + (90 * n * n_documents) // n_all, batch["doc_id"].fill_null(0).to_numpy(), absent, np.diff(term.offsets.to_numpy()).astype(np.int64), term.flatten().to_numpy().astype(np.int64), tf.flatten().to_numpy().astype(np.int64)
            if parts and held + len(part[4]) > POSTINGS:
                work(parts)
                parts, held = [], 0
            parts.append(part)
            held += len(part[4])
        if parts:
            work(parts)
        rows = [np.concatenate([b[i] for b in best]) if best else np.zeros(0, np.int64) for i in range(3)]
        item = pa.array(ids).take(pa.array(np.repeat(np.arange(len(ids)), [len(b[0]) for b in best])))
        yield pa.RecordBatch.from_arrays([item, pa.array(rows[1], pa.int64(), mask=rows[2].astype(bool)), pa.array(rows[0])], ["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_terms: int = TERMS) -> DataFrame:
    """Each item's k highest-scoring documents with a score above 0: item_id, rank, doc_id, score."""
    context = docs.sparkSession.sparkContext
    asked = settle(item_terms(items, item_id, item_text), "search-items")
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = None
    for b in range(blocks):
        table = asked.where(F.col("block") == b).select("item_id", "terms").toArrow()  # about block_terms terms
        cut = np.append(0, np.cumsum(table["terms"].combine_chunks().value_lengths().to_numpy())).astype(np.int64) if len(table) else np.zeros(1, np.int64)
        hashes = table["terms"].combine_chunks().flatten().to_numpy().view(np.uint64)
        vocabulary = np.unique(hashes)
        postings = settle(index(docs, vocabulary, doc_id, text), "search-postings")
        n_documents, n_all = postings.agg(F.count("*"), F.sum("n")).first()
        if not n_documents:
            break
        ratio = F.lit(float(2 * n_documents + 2)) / (2 * F.col("df") + 1)
        weighed = postings.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w")).toArrow()
        weight = np.zeros(len(vocabulary), np.int64)
        weight[weighed["term"].to_numpy()] = weighed["w"].to_numpy()
        terms = np.searchsorted(vocabulary, hashes)
        sent = context.broadcast((table["item_id"].combine_chunks(), cut, terms, weight[terms]))
        # equal m lies together; a stratum of many documents is split by their ids
        strata = postings.repartitionByRange("n", F.xxhash64("doc_id")).sortWithinPartitions("n")
        part = strata.mapInArrow(_search(k, sent, len(vocabulary), n_documents, n_all), "item_id long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")

"""N-gram Jaccard join: a MinHash LSH forest and exact verification.

A text is the set of its shingles (``SHINGLE`` successive words; a shorter text is one shingle).
Texts of equal sets form a class; one row per class enters the join.  Every class has a path of
``LONGEST`` hashes in each of ``TREES`` prefix tries; a trie's nodes are the prefixes that several classes
share, with their counts.

A class begins at its full path in every tree and shortens one prefix after the other, each time where
the recall gained costs the fewest further candidates, until a pair at the threshold meets it in some tree
with probability ``RECALL``.  So a class without neighbours ascends freely and one in a crowded branch
stays deep there.  It asks for the classes below the nodes where it stopped; a pair is found if either side
asks for the other.  What meets is verified on the exact sets.  By its own paths alone a class misses a partner
at a similarity of exactly 0.8 with probability 3 in 10,000 at most, one at 0.85 far less.

A group of near copies is never written out as pairs: a node's rows are cut into blocks,
each pair of blocks is one unit of work, and a unit returns one row per class with its
links (counted in the first tree where a pair meets, at its upper node, so once) and its component.
Components are joined by label propagation.

Defined results: a text without words (null too) is linked to nothing; exact copies are linked;
class_id is the smallest id of the component, null only if all its ids are null.  Repeated
rows count as copies.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendfeat.llm import _text as T
from lendfeat.llm._store import settle

SHINGLE = 5
THRESHOLD = 0.8
TREES, LONGEST = 16, 6
HASHES = TREES * LONGEST
RECALL = 0.9997
BLOCK = 512
PAIRS = 1 << 15

_rng = np.random.Generator(np.random.PCG64(77))
_MULTIPLY = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_ORDER = [np.uint64(x) for x in _rng.integers(1, 2**63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)]


def prefix_length(threshold: float, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """Longest prefix at which, if all trees had it, a pair at the threshold meets in some tree with the given probability."""
    for d in range(longest, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def shortest_length(threshold: float) -> int:
    """The shortest prefix of the tries: one above what equal prefixes would need."""
    return max(1, prefix_length(threshold) - 1)


def shorten(sizes: np.ndarray, threshold: float, recall: float = RECALL) -> np.ndarray:
    """Prefix length of every class and tree, from the sizes of its nodes [class, tree, level] (the last level is LONGEST).

    From the full paths up, always the step with the fewest further candidates for its gain (the deeper of
    equals); free steps are taken beyond the recall as well."""
    rows, trees, levels = sizes.shape
    depths = np.arange(LONGEST - levels + 1, LONGEST + 1)
    miss = -np.log1p(-(threshold ** depths.astype(float)))  # one tree's part of -log(miss)
    gain = np.append(np.inf, miss[:-1] - miss[1:])  # of the step up from a level
    level = np.full((rows, trees), levels - 1)
    r, t = np.arange(rows), np.arange(trees)
    for _ in range(trees * (levels - 1)):
        above = sizes[r[:, None], t, np.maximum(level - 1, 0)] - sizes[r[:, None], t, level]
        cost = np.where(level > 0, above / gain[level], np.inf) - level * 1e-9
        best = cost.argmin(1)
        free = above[r, best] == 0
        go = (level[r, best] > 0) & (free | (miss[level].sum(1) < -np.log(1 - recall)))
        if not go.any():
            break
        level[r[go], best[go]] -= 1
    return depths[level]


def shingles(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The set of each text, sorted."""
    h, _, _, end = T.words(data, ends)
    n = max(0, len(h) - SHINGLE + 1)
    g = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        g += h[k : k + n] * _ORDER[k]
    g = T.mix(g)
    out = []
    for a, b in zip(T.begins(end).tolist(), end.tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(g[a : b - SHINGLE + 1]))
        elif b > a:
            whole = (h[a:b] * np.array(_ORDER[: b - a], np.uint64)).sum(keepdims=True)
            out.append(T.mix(whole + np.uint64(b - a)))
        else:
            out.append(g[:0])
    return out


def _class(s: np.ndarray) -> int:
    """Key of a set."""
    folded = T.mix(s + np.uint64(0x632BE59BD9B4E019)).sum(keepdims=True) + np.bitwise_xor.reduce(s, keepdims=True) * np.uint64(3) + np.uint64(len(s))
    return int(T.mix(folded).view(np.int64)[0])


def _signature(s: np.ndarray) -> np.ndarray:
    step = HASHES if len(s) < 1 << 14 else 4
    low = [(s[None, :] * _MULTIPLY[j : j + step, None] + _ADD[j : j + step, None]).min(1) for j in range(0, HASHES, step)]
    return (T.mix(np.concatenate(low)) >> np.uint64(32)).astype(np.uint32)


def _signed(batches):
    for batch in batches:
        for at, data, ends in T.chunks(batch["text"]):
            sets = shingles(data, ends)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].slice(at, len(ends)), pa.array([_class(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([_signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "cls", "n", "sig"],
            )


def _paths(shortest: int):
    """Keys of a class's nodes, tree by tree from the shortest prefix to the full path."""
    numbers = np.arange(TREES, dtype=np.uint64) + np.uint64(1)

    def run(batches):
        for batch in batches:
            sigs = _signatures(batch["sig"])
            keys = np.zeros((len(sigs), TREES), np.uint64) + numbers
            nodes = []
            for k in range(LONGEST):
                keys = T.mix(keys * _ORDER[0] + sigs[:, :, k].astype(np.uint64))
                nodes += [keys] if k >= shortest - 1 else []
            nodes = np.stack(nodes, 2).reshape(len(sigs), -1).view(np.int64)
            ends = np.arange(len(sigs) + 1, dtype=np.int32) * nodes.shape[1]
            yield pa.RecordBatch.from_arrays([batch["cls"], pa.ListArray.from_arrays(pa.array(ends), pa.array(nodes.ravel()))], ["cls", "keys"])

    return run


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TREES, LONGEST)


def _ascended(shortest: int, threshold: float):
    """The nodes that a class is below, down to where it stopped: (cls, depths, node, key, asks)."""
    levels = LONGEST - shortest + 1

    def run(batches):
        for batch in batches:
            places, flat = batch["nodes"].flatten(), {}
            for field in ("node", "key", "m"):
                flat[field] = places.field(field).to_numpy()
            row = np.repeat(np.arange(len(batch)), np.diff(batch["nodes"].offsets.to_numpy()))
            sizes = np.ones((len(batch), TREES, levels))
            tree, level = np.divmod(flat["node"], levels)
            sizes[row, tree, level] = flat["m"]
            depths = shorten(sizes, threshold)
            stop = depths[row, tree] - shortest
            below = level <= stop
            texts = [d.tobytes() for d in depths.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch["cls"].take(pa.array(row[below])), pa.array([texts[i] for i in row[below].tolist()], pa.binary()), pa.array(flat["node"][below], pa.int32()), pa.array(flat["key"][below], pa.int64()), pa.array((level == stop)[below])],
                ["cls", "depths", "node", "key", "asks"],
            )

    return run


def _sets(batches):
    for batch in batches:
        for _, data, ends in T.chunks(batch["text"]):
            sets = [s for s in shingles(data, ends) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_class(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "shingles"])


def _units(batches, columns):
    """Whole units (rows of equal unit, sorted) of a sorted partition, as many at once as a batch holds."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]).select(columns)
        table = pa.concat_tables([held, table]) if held is not None else table
        unit = table["unit"].to_numpy()
        last = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
        held = table.slice(last)
        if last:
            yield table.slice(0, last).combine_chunks()
    if held is not None and len(held):
        yield held.combine_chunks()


def _candidates(table: pa.Table, threshold: float):
    """(left, right) rows of every pair of a unit that first meets in the unit's tree, at its node, and may reach the threshold."""
    unit, side, tree, depth, n = (table[c].to_numpy() for c in ("unit", "side", "tree", "depth", "n"))
    sig = _signatures(table["sig"])
    stops = np.frombuffer(b"".join(table["depths"].to_pylist()), np.uint8).reshape(-1, TREES)
    stop = stops[np.arange(len(tree)), tree]
    begin = np.flatnonzero(np.append(True, np.diff(unit) != 0))
    size = np.diff(np.append(begin, len(unit)))
    later = np.repeat(begin + size, size) - np.arange(len(unit)) - 1
    # a pair at the threshold agrees on fewer components than this once in a million
    least = max(1, math.floor(HASHES * (threshold - 5 * math.sqrt(threshold * (1 - threshold) / HASHES))))
    row, total = 0, np.concatenate([[0], np.cumsum(later)])
    while row < len(unit):
        to = max(row + 1, int(np.searchsorted(total, total[row] + PAIRS, "right")) - 1)
        count = later[row:to]
        left = np.repeat(np.arange(row, to), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        row = to
        # within one block all pairs, between two blocks only those across
        keep = (side[left] == 2) | (side[left] != side[right])
        keep &= np.minimum(n[left], n[right]) >= threshold * np.maximum(n[left], n[right])
        # at the upper one of the nodes where the two stopped
        keep &= np.minimum(stop[left], stop[right]) == depth[left]
        left, right = left[keep], right[keep]
        same = sig[left] == sig[right]
        met = np.logical_and.accumulate(same, 2).sum(2) >= np.minimum(stops[left], stops[right])
        keep = (met.argmax(1) == tree[left]) & met.any(1) & (same.sum((1, 2)) >= least)
        yield left[keep], right[keep]


_UNIT = ["unit", "side", "tree", "depth", "depths", "cls", "n", "sig"]
_KEPT = ["unit", "side", "tree", "depth", "depths", "cls"]


def _survivors(threshold: float):
    def run(batches):
        for table in _units(batches, _UNIT):
            kept = np.zeros(len(table), bool)
            for left, right in _candidates(table, threshold):
                kept[left] = kept[right] = True
            yield from table.filter(pa.array(kept)).select(_KEPT).to_batches()

    return run


def _links(threshold: float):
    def run(batches):
        for table in _units(batches, [*_UNIT, "copies", "shingles"]):
            cls, unit, copies, n = (table[c].to_numpy() for c in ("cls", "unit", "copies", "n"))
            sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
            links, label, near = np.zeros(len(cls), np.int64), cls.copy(), [np.zeros((2, 0), np.int32)]
            for left, right in _candidates(table, threshold):
                begin = np.flatnonzero(np.diff(unit[left], prepend=~unit[left[:1]]) != 0)
                for a, b in zip(begin, np.append(begin[1:], len(left))):
                    l, r = left[a:b], right[a:b]
                    both = _overlap(sets, l, r)
                    found = both >= threshold * (n[l] + n[r] - both) - 1e-9
                    near.append(np.stack([l[found], r[found]]).astype(np.int32))
            l, r = np.concatenate(near, axis=1)
            np.add.at(links, l, copies[r])
            np.add.at(links, r, copies[l])
            while True:  # the smallest class of each component of each unit
                low = np.minimum(label[l], label[r])
                if (label[l] == low).all() and (label[r] == low).all():
                    break
                np.minimum.at(label, l, low)
                np.minimum.at(label, r, low)
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(label), pa.array(links)], ["cls", "label", "links"])

    return run


def _overlap(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common shingles of each pair."""
    if len(left) < 48:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right)], np.int64)
    (lefts, l), (rights, r) = (np.unique(x, return_inverse=True) for x in (left, right))
    known = np.unique(np.concatenate([sets[i] for i in lefts]))

    def cells(rows):
        own = np.concatenate([sets[i] for i in rows])
        of = np.repeat(np.arange(len(rows)), [len(sets[i]) for i in rows])
        at = np.searchsorted(known, own).clip(0, len(known) - 1)
        hit = np.flatnonzero(known[at] == own)
        hit = hit[np.argsort(at[hit], kind="stable")]
        return of[hit], at[hit]

    (of_l, at_l), (of_r, at_r) = cells(lefts), cells(rights)
    both = np.zeros((len(lefts), len(rights)), np.float32)
    for c in range(0, len(known), 4096):
        parts = []
        for of, at, n in ((of_l, at_l, len(lefts)), (of_r, at_r, len(rights))):
            a, b = np.searchsorted(at, [c, c + 4096])
            m = np.zeros((n, min(4096, len(known) - c)), np.float32)
            m[of[a:b], at[a:b] - c] = 1
            parts.append(m)
        both += parts[0] @ parts[1].T
    return both[l, r].astype(np.int64)


def components(edges: DataFrame) -> DataFrame:
    """(cls, label): the smallest class of each component; edges (a, b), in the shared folder."""
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = settle(both.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("cls").alias("b"), "label"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("label").alias("near"))
        step = labels.join(near, "cls").withColumn("to", F.least("label", "near"))
        jump = labels.select(F.col("cls").alias("to"), F.col("label").alias("on"))
        new = settle(step.join(jump, "to").select("cls", F.least("to", "on").alias("label"), F.col("label").alias("was")), "labels")
        if not new.where("label != was").limit(1).count():
            return new.select("cls", "label")
        labels = new.select("cls", "label")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, class_id (smallest id of its group), copy_id (of its exact copies), links (documents within the threshold)."""
    shortest = shortest_length(threshold)
    levels = LONGEST - shortest + 1
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = settle(rows.mapInArrow(_signed, "doc_id long, cls long, n int, sig binary"), "signed")
    classes = settle(signed.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")

    entries = classes.select("cls", "sig").mapInArrow(_paths(shortest), "cls long, keys array<long>").select("cls", F.posexplode("keys").alias("node", "key"))
    # written, so that their size is known before the join: a small one is broadcast and entries and texts aren't shuffled
    shared = settle(entries.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "nodes")
    # at most TREES x levels nodes a class
    paths = entries.join(shared, "key").groupBy("cls").agg(F.collect_list(F.struct("node", "key", "m")).alias("nodes"))
    below = settle(paths.mapInArrow(_ascended(shortest, threshold), "cls long, depths binary, node int, key long, asks boolean"), "forest")
    full = settle(below.groupBy("key").agg(F.count("*").alias("m"), F.max("asks").alias("asked")).where("asked and m > 1").select("key", "m"), "buckets")
    met = below.drop("asks").join(full, "key").join(classes.select("cls", "n", "sig"), "cls")
    met = met.withColumn("tree", F.expr(f"node div {levels}").cast("int")).withColumn("depth", F.expr(f"{shortest} + node % {levels}").cast("int"))
    blocks = met.withColumn("blocks", F.ceil(F.col("m") / BLOCK)).withColumn("own", F.expr("pmod(hash(cls), blocks)"))
    units = blocks.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    units = units.withColumn("side", F.when(F.col("other") == F.col("own"), 2).when(F.col("other") > F.col("own"), 0).otherwise(1)).withColumn("unit", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))

    def by_unit(df: DataFrame) -> DataFrame:
        return df.repartition("unit").sortWithinPartitions("unit", "side", "cls")

    kept = by_unit(units.select(*_UNIT)).mapInArrow(_survivors(threshold), "unit long, side int, tree int, depth int, depths binary, cls long")
    kept = settle(kept, "survivors")
    wanted = settle(kept.select("cls").distinct().join(classes.select("cls", "copy_id"), "cls").select("copy_id").distinct(), "wanted")
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["copy_id"]), "left_semi")
    sets = texts.select("text").mapInArrow(_sets, "cls long, shingles binary").groupBy("cls").agg(F.first("shingles").alias("shingles"))
    work = kept.join(classes.select("cls", "n", "sig", "copies"), "cls").join(sets, "cls")
    linked = settle(by_unit(work.select(*_UNIT, "copies", "shingles")).mapInArrow(_links(threshold), "cls long, label long, links long"), "linked")

    links = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = components(linked.where("cls != label").select(F.col("cls").alias("a"), F.col("label").alias("b")))
    of = classes.select("cls", "copy_id", "copies").join(links, "cls", "left").join(groups, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    smallest = of.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    of = of.join(smallest, "label").select("cls", "copy_id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return signed.select("doc_id", "cls").join(of, "cls", "left").select(
        "doc_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"), F.coalesce("links", F.lit(0)).alias("links")
    )

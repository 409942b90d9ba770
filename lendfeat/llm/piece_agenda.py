"""SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda.

A text is normalised as the model says; its characters are symbols in a chain.  Every adjacent
pair whose concatenation is a piece stands on an agenda ordered by score (falling), then position.
The first pair is merged, its neighbours' new pairs join the agenda, and this goes on until the agenda
is empty.  What is left are pieces; a character without a piece becomes its bytes.

No piece holds a word mark behind another character (looked up in the vocabulary; else texts stay
whole), so no merge crosses from a word into the next mark: texts are cut there into segments.  The
segments of an Arrow batch that the task hasn't met yet are worked off together, their agendas side by
side in arrays, one merge of each in a round (``_agendas``); a segment over ``LONG`` characters has a heap
of its own (``_agenda``, n log n).  Every new segment is then checked against the sentencepiece library;
a difference raises an error.  Ids of whole texts follow by concatenation, decoding is the library's.

Segments are told apart by 64-bit hashes.  Memory: one Arrow batch, and a table of at most
``KNOWN`` segments and those of one batch, at some 40 bytes each.

Defined results: null text is empty, an empty text has the end id alone and decodes to an empty text;
null ids, repeated rows and an empty table need no care, as every row is worked off by itself; extra
columns, whatever their names, are not read.  A model that isn't of the merge type with byte fallback,
or has unused pieces, is refused.
"""

from __future__ import annotations

import heapq
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendfeat.llm import _text as T

MARK = "▁"
#: Segments kept by a task; beyond, it starts anew (a cache, no effect on results).
KNOWN = 1_000_000
#: Characters from which a segment gets a heap of its own.
LONG = 256
#: Bytes of text that are cut into segments at once (a longer text by itself).
CHUNK_BYTES = 1 << 21
_NEVER = np.int64(1 << 62)


class PieceAgenda:
    """Encoder over the pieces of a sentencepiece model of the merge type, with its end id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        self.size = lib.get_piece_size()
        plain = [i for i in range(self.size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.pieces = {lib.id_to_piece(i): i for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(map(lib.is_unused, plain)) or not all(map(lib.is_byte, self.bytes)):
            raise ValueError("the model must have byte fallback and no unused pieces")
        self.apart = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        self.end = lib.eos_id()
        self.listed = [str(i) for i in range(self.size)]
        # pairs of pieces that make a piece; order: rank of its score, equal scores share one
        order = {s: n for n, s in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        rows = [(self.pieces[p[:k]] * self.size + self.pieces[p[k:]], i, order[lib.get_score(i)]) for p, i in self.pieces.items() for k in range(1, len(p)) if p[:k] in self.pieces and p[k:] in self.pieces]
        self.pairs, self.makes, self.order = np.array(sorted(rows), np.int64).reshape(-1, 3).T.copy()
        self.pair = {key: (rank, to) for key, to, rank in rows}
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.n_ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    def _characters(self, points: np.ndarray) -> np.ndarray:
        """Each character's piece, or -1 - its code point."""
        seen, back = np.unique(points, return_inverse=True)
        own = [self.pieces.get(chr(c), -1 - c) for c in seen.tolist()]
        return np.array(own, np.int64)[back] if len(own) else np.zeros(0, np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, piece) of adjacent symbols, order -1 where they make none."""
        key = np.where((left >= 0) & (right >= 0), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.order[at], -1), self.makes[at]

    def _agenda(self, symbols: list[int]) -> list[int]:
        """What is left of one segment's symbols; the agenda is a heap, entries out of date are skipped."""
        n, size, pair = len(symbols), self.size, self.pair
        before, after, heap = list(range(-1, n - 1)), list(range(1, n + 1)), []

        def propose(left: int, right: int) -> None:
            a, b = symbols[left], symbols[right]
            if a >= 0 and b >= 0 and (found := pair.get(a * size + b)):
                heapq.heappush(heap, (found[0], left, right, a, b, found[1]))

        for i in range(n - 1):
            propose(i, i + 1)
        gone = [False] * n
        while heap:
            _, left, right, a, b, to = heapq.heappop(heap)
            if gone[left] or gone[right] or after[left] != right or symbols[left] != a or symbols[right] != b:
                continue
            symbols[left], gone[right] = to, True
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                propose(left, follow)
            if before[left] >= 0:
                propose(before[left], left)
        return [s for s, g in zip(symbols, gone) if not g]

    def _agendas(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is left of each segment's symbols (segments of the given sizes), and how many."""
        done, left = [], np.zeros(len(sizes), np.int64)
        number, n = np.arange(len(sizes)), sizes.copy()
        start = np.cumsum(n) - n
        last = np.zeros(len(symbols), bool)
        last[start + n - 1] = True
        order, makes = self._pair(symbols, np.append(symbols[1:], -1))
        order[last] = -1
        while len(n):
            value = np.where(order >= 0, order << 32 | np.arange(len(symbols)), _NEVER)
            first = np.minimum.reduceat(value, start)
            finished = first == _NEVER
            if finished.any():
                of = np.repeat(finished, n)
                done.append((number[finished], n[finished], symbols[of]))
                shift = np.cumsum(of)
                symbols, order, makes, last = symbols[~of], order[~of], makes[~of], last[~of]
                at = (first & 0xFFFFFFFF)[~finished]
                at = at - shift[at]
                number, n = number[~finished], n[~finished]
            else:
                at = first & 0xFFFFFFFF
            if not len(n):
                break
            symbols[at] = makes[at]
            last[at] |= last[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one symbol less for each segment before
            symbols, order, makes, last = symbols[keep], order[keep], makes[keep], last[keep]
            n = n - 1
            start = np.cumsum(n) - n
            following = np.append(symbols[1:], -1)
            for x in (at, np.maximum(at - 1, 0)):
                rank, to = self._pair(symbols[x], following[x])
                order[x], makes[x] = np.where(last[x], -1, rank), to
        for i, k, _ in done:
            left[i] = k
        out, begin = np.zeros(int(left.sum()), np.int64), np.cumsum(left) - left
        for i, k, s in done:
            out[T.spread(begin[i], k)] = s
        return out, left

    def segment_ids(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments (their code points end to end), and how many each has."""
        symbols, long = self._characters(points), sizes > LONG
        of = np.repeat(long, sizes)
        short, n = self._agendas(symbols[~of], sizes[~long])
        counts = np.zeros(len(sizes), np.int64)
        counts[~long] = n
        if long.any():
            begin = np.cumsum(sizes) - sizes
            own = [self._agenda(symbols[a : a + k].tolist()) for a, k in zip(begin[long].tolist(), sizes[long].tolist())]
            counts[long] = [len(x) for x in own]
            left = np.zeros(int(counts.sum()), np.int64)
            of = np.repeat(long, counts)
            left[~of], left[of] = short, np.fromiter(chain.from_iterable(own), np.int64, int(counts[long].sum()))
        else:
            left = short
        if (left < 0).any():  # characters without a piece
            odd = np.flatnonzero(left < 0)
            coded = [[self.bytes[b] for b in chr(-1 - c).encode()] for c in left[odd].tolist()]
            wide = np.ones(len(left), np.int64)
            wide[odd] = [len(c) for c in coded]
            whose = np.repeat(np.arange(len(sizes)), counts)
            counts = np.bincount(whose, wide, len(sizes)).astype(np.int64)
            begin = np.cumsum(wide) - wide
            left = np.repeat(left, wide)
            left[T.spread(begin[odd], wide[odd])] = np.fromiter(chain.from_iterable(coded), np.int64)
        return left, counts

    def check(self, segments: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Raises an error unless the library gives the same ids; it puts a mark before what it is given."""
        given = [s[1:] for s in segments]
        said = self.library.encode(given, num_threads=1)
        flat = np.fromiter(chain.from_iterable(said), np.int64)
        if [len(x) for x in said] != counts.tolist() or not np.array_equal(flat, ids):
            begin = np.cumsum(counts) - counts
            wrong = [(s, x, ids[a : a + k].tolist()) for s, x, a, k in zip(segments, said, begin.tolist(), counts.tolist()) if x != ids[a : a + k].tolist()]
            wrong = [w for w in wrong if self.library.normalize(w[0][1:]) == w[0]]  # else the library was asked for another text
            if wrong:
                raise ValueError(f"agenda and library disagree: {wrong[0]}")

    def _learn(self, keys: np.ndarray, segments: list[str]) -> None:
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        ids, counts = self.segment_ids(_points("".join(segments)), sizes)
        self.check(segments, ids, counts)
        every = np.concatenate([self.keys, keys])
        sort = np.argsort(every)
        at = np.concatenate([self.at, len(self.ids) + np.cumsum(counts) - counts])
        self.keys, self.at, self.n_ids = every[sort], at[sort], np.concatenate([self.n_ids, counts])[sort]
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts with the end id."""
        normal = [self.library.normalize(t) for t in texts]
        whole = "".join(normal)
        points = _points(whole)
        sizes = np.fromiter(map(len, normal), np.int64, len(normal))
        ends = np.cumsum(sizes)
        opens = np.zeros(len(points) + 1, bool)
        if self.apart:
            mark = points == ord(MARK)
            opens[1:-1] = mark[1:] & ~mark[:-1]
        opens[ends - sizes] = True
        start = np.flatnonzero(opens[:-1])
        end = np.append(start[1:], len(points))[: len(start)]
        prefix = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(T.mix(points.astype(np.uint64) + np.uint64(1)) * T._power(T._BASE, len(points)), out=prefix[1:])
        keys, first, back = np.unique(T.range_hash(prefix, start, end), return_index=True, return_inverse=True)
        if len(self.keys) > KNOWN:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = first[~known]
            self._learn(keys[~known], [whole[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())])
            at = np.searchsorted(self.keys, keys)
        n = self.n_ids[at][back]
        ids = self.ids[T.spread(self.at[at][back], n)].tolist()
        total = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        stops = total[np.searchsorted(start, ends)].tolist()
        return [[*ids[a:b], self.end] for a, b in zip([0, *stops], stops)]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per document: doc_id, n_tokens, ids_sha256 and decoded_sha256; with_ids adds the ids and the decoded text."""

    def run(batches):
        coder = PieceAgenda(model)
        for batch in batches:
            texts, docs_ = batch["text"].fill_null(""), batch["doc_id"]
            size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.unique(np.searchsorted(size, np.arange(0, size[-1] + 1, CHUNK_BYTES))).tolist() if len(size) else []
            for a, b in zip(cuts, [*cuts[1:], len(texts)]):
                rows = []
                for doc, ids in zip(docs_.slice(a, b - a).to_pylist(), coder.encode(texts.slice(a, b - a).to_pylist())):
                    decoded = coder.decode(ids)
                    listed = " ".join([coder.listed[i] for i in ids])
                    row = doc, len(ids), sha256(listed.encode()).hexdigest(), sha256(decoded.encode()).hexdigest()
                    rows.append((*row, ids, decoded) if with_ids else row)
                columns = list(zip(*rows)) or [[]] * len(fields)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields, schema = [*fields, ("ids", pa.list_(pa.int32())), ("decoded", pa.string())], schema + ", ids array<int>, decoded string"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)

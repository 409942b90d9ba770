"""Bounded-space online packing of tokenised documents into fixed windows.

Each partition keeps at most ``OPEN`` windows.  A document's tokens (whole windows first cut
off a long one) go to the open window that they fit best; when none fits, the fullest window is
emitted.  If that would waste more than ``MAX_GAP`` tokens, the document is cut to fill it
first.  What is open at the partitions' ends is merged: leftovers of ``MERGED`` partitions at
a time, themselves packed best-fit by falling size, so a merge's size is bounded too.

Tokens: the words of a text are looked up in a table of the words that this task has met and
only new ones go to the tokenizer; the ids are those of the whole text.

Defined results: null text is empty, an empty text is one piece with the end id; documents without
id, repeated rows and extra columns are packed like any other.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendfeat.llm import _text as T
from lendfeat.llm._store import settle

WINDOW = 2048
END_ID = 1
OPEN = 64
MAX_GAP = 16
MERGED = 64
#: Words kept in a task's table; beyond, it starts anew (a cache, no effect on results).
KNOWN = 500_000
_SLOTS = 20

_b = np.arange(256)
_SPACE, _WORD, _DIGIT, _MARK, _WHOLE = 0, 1, 2, 3, 4
_KIND = np.full(256, _MARK, np.uint8)
_KIND[((_b | 32) >= 97) & ((_b | 32) <= 122)] = _WORD
_KIND[(_b >= 48) & (_b <= 57)] = _DIGIT
_KIND[~T.NOT_SPACE] = _SPACE
_KIND[((_b < 32) & T.NOT_SPACE) | (_b == 39) | (_b == 127) | (_b >= 128)] = _WHOLE
_LOWER = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)


class WordTokens:
    """Token ids of texts under a lower-casing word-wise byte-level BPE."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for 256, 257, ...
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {x: 256 + i for i, x in enumerate(sorted(set(range(256)) - set(own)))}
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size, self.n = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 1
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.slots = np.zeros((2, 1 << _SLOTS), np.int32)  # 0: empty

    def _find(self, key: np.ndarray) -> np.ndarray:
        """A word's number, 0 if it isn't known (or has lost its place to another)."""
        high = (key >> np.uint64(64 - _SLOTS)).astype(np.int64)
        found = self.slots[0][high]
        lost = np.flatnonzero(self.keys[found] != key)
        if len(lost):
            again = self.slots[1][(key[lost] & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)]
            found[lost] = np.where(self.keys[again] == key[lost], again, 0)
        return found

    def _pieces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and kind of pieces that tokenise independently: words of plain letters, single
        digits, runs of marks, and, where anything else occurs, what stands between white space."""
        kind = _KIND[data]
        lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF: letters but for two, small from U+00E0 on
        low = data[lead + 1]
        plain = lead[(low != 0x97) & (low != 0xB7)]
        kind[plain], kind[plain + 1] = _WORD, _WORD
        large = plain[data[plain + 1] < 0x9F] + 1
        data[large] += 0x20
        start, end = T.runs(data, T.NOT_SPACE)
        odd = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kind == _WHOLE, out=odd[1:])
        whole = odd[end] > odd[start]
        cover = np.zeros(len(data) + 1, np.int32)
        cover[start[whole]] += 1
        cover[end[whole]] -= 1
        kind[np.cumsum(cover[:-1]) > 0] = _WHOLE
        opens = (kind != _SPACE) & ((np.diff(kind, prepend=np.uint8(_SPACE)) != 0) | (kind == _DIGIT))
        starts = np.flatnonzero(opens)
        shut = np.ones(len(data), bool)
        shut[:-1] = opens[1:] | (kind[1:] == _SPACE)
        return starts, np.flatnonzero(shut & (kind != _SPACE)) + 1, kind[starts]

    def _learn(self, keys: np.ndarray, pieces: list[bytes], simple: list[bool]) -> None:
        read = lambda p: p.decode("ascii") if p.isascii() else p.decode("latin-1").translate(self.alphabet)
        got = [
            [x.id for x in self.model.tokenize(read(p))] if plain else self.tokenizer.encode(p.decode("utf-8", "replace"), add_special_tokens=False).ids
            for p, plain in zip(pieces, simple)
        ]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter((i for x in got for i in x), np.int32, int(sizes.sum()))
        new = slice(self.n, self.n + len(keys))
        while new.stop > len(self.keys):
            self.keys, self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.keys, self.at, self.size))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.keys[new], self.at[new], self.size[new] = keys, self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.n = self.used + len(ids), new.stop
        number, high = np.arange(new.start, new.stop, dtype=np.int32), (keys >> np.uint64(64 - _SLOTS)).astype(np.int64)
        free = self.slots[0][high] == 0
        self.slots[0][high[free]] = number[free]
        rest = np.flatnonzero(self.slots[0][high] != number)
        self.slots[1][(keys[rest] & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)] = number[rest]

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's end among them."""
        data = _LOWER[data]
        start, end, kind = self._pieces(data)
        key = T.range_hash(T.prefix_hash(data), start, end)
        if self.n > KNOWN:
            self.clear()
        place = self._find(key)
        unknown = np.flatnonzero(place == 0)
        if len(unknown):
            new, first, back = np.unique(key[unknown], return_index=True, return_inverse=True)
            f, raw, at = unknown[first], data.tobytes(), self.n
            self._learn(new, [raw[a:b] for a, b in zip(start[f].tolist(), end[f].tolist())], (kind[f] != _WHOLE).tolist())
            place[unknown] = at + back
        size = self.size[place]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = self.ids[np.repeat(self.at[place] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(start, ends)]


_FIELDS = [("doc_no", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("part", pa.int64()), ("window", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64()), ("open", pa.bool_())]


class _Packer:
    """Open windows as (fill, number), by fill; their pieces wait until the window is emitted."""

    def __init__(self, part: int, window: int):
        self.part, self.window, self.fills, self.held, self.next, self.out = part, window, [], {}, 0, []

    def _emit(self, fill: int, number: int, still_open: bool = False) -> None:
        self.out += [(*piece, fill, still_open) for piece in self.held.pop(number)]

    def _put(self, i: int | None, piece: tuple, n: int) -> None:
        if i is None:
            fill, number = 0, self.next
            self.next += 1
            self.held[number] = []
        else:
            fill, number = self.fills.pop(i)
        self.held[number].append((*piece, self.part, number, fill))
        if fill + n == self.window:
            self._emit(fill + n, number)
        else:
            insort(self.fills, (fill + n, number))

    def add(self, piece, total: int) -> None:
        """piece(start, length) gives what is kept of that part of the document."""
        start = 0
        while start < total:
            n = min(self.window, total - start)
            i = bisect_left(self.fills, (self.window - n + 1, -1)) - 1  # the fullest window it fits
            if n < self.window and i < 0 and len(self.fills) == OPEN:
                free = self.window - self.fills[-1][0]
                if free <= MAX_GAP:
                    self._emit(*self.fills.pop())
                    continue
                n, i = free, OPEN - 1  # none fits: cut to fill the fullest
            self._put(i if i >= 0 and n < self.window else None, piece(start, n), n)
            start += n

    def close(self) -> None:
        for fill, number in self.fills:
            self._emit(fill, number, True)

    def batch(self, columns) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(list(zip(*rows)) or [[]] * len(columns), columns)], [n for n, _ in columns])


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids)."""
    columns = [_FIELDS[0], *_FIELDS[1:5], *([("ids", pa.list_(pa.int32()))] if with_ids else []), *_FIELDS[5:]]

    def run(batches):
        part = TaskContext.get().partitionId()
        tokens, packer = WordTokens(tokenizer), _Packer(part, window)
        for batch in batches:
            for at, data, ends in T.chunks(batch["text"], lower=False):
                ids, stop = tokens.encode(data, ends)
                for doc, a, b in zip(batch["doc_no"].slice(at, len(ends)).to_pylist(), T.begins(stop).tolist(), stop.tolist()):
                    own = np.append(ids[a:b], END_ID).astype("<u4")

                    def piece(start, n):
                        cut = own[start : start + n]
                        return (doc, start, n, zlib.crc32(cut.tobytes()), len(own), *([cut.astype(np.int32)] if with_ids else []))

                    packer.add(piece, len(own))
                if packer.out:
                    yield packer.batch(columns)
        packer.close()
        yield packer.batch(columns)

    schema = f"doc_no long, start long, length long, ids_crc32 long, doc_tokens long, {'ids array<int>, ' * with_ids}part long, window long, offset long, fill long, open boolean"
    pieces = settle(docs.select(F.col(doc_id).cast("long").alias("doc_no"), F.col(text).alias("text")).mapInArrow(run, schema), "packed")

    def merge(table: pa.Table) -> pa.Table:
        left = sorted(zip(*(table[c].to_pylist() for c in ("fill", "part", "window"))), reverse=True)
        hosts, rows = [], []  # (fill, part, window), by fill
        for fill, part, number in left:
            i = bisect_left(hosts, (window - fill + 1,)) - 1
            host = hosts.pop(i) if i >= 0 else (0, part, number)
            rows.append((part, number, host[1], host[2], host[0]))
            insort(hosts, (host[0] + fill, *host[1:]))
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("part", "window", "host_part", "host_window", "shift"), list(zip(*rows)) or [[]] * 5)})

    leftovers = pieces.where("open").groupBy("part", "window").agg(F.max("fill").alias("fill")).withColumn("group", F.expr(f"part div {MERGED}"))
    moved = leftovers.groupBy("group").applyInArrow(merge, "part long, window long, host_part long, host_window long, shift long")
    number = lambda part, own: F.shiftleft(F.col(part), 32) + F.col(own)
    done = pieces.where("not open").withColumn("sequence_id", number("part", "window"))
    late = pieces.where("open").join(moved, ["part", "window"]).withColumn("sequence_id", number("host_part", "host_window")).withColumn("offset", F.col("offset") + F.col("shift"))
    kept = [F.col("doc_no").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    return done.select(*kept).unionByName(late.select(*kept))

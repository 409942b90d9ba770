"""Vectorised word and n-gram hashing over Arrow string columns (numpy, inside tasks).

A word is a maximal run of ASCII letters, digits, ``_`` and non-ASCII characters of
the lower-cased text; everything else separates words.  Texts are handled whole, about
CHUNK_BYTES of them at a time (a longer one by itself), so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
_MIX1, _MIX2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)

_byte = np.arange(256)
_LETTER = ((_byte | 32) >= 97) & ((_byte | 32) <= 122) | (_byte >= 128)
IS_WORD = _LETTER | (_byte >= 48) & (_byte <= 57) | (_byte == 95)
IS_LETTER = _LETTER
NOT_SPACE = ~((_byte == 32) | (_byte >= 9) & (_byte <= 13))

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, CHUNK_BYTES + 4096), U64(base))
        out[0] = 1
        have = _powers[base] = np.multiply.accumulate(out)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Final avalanche of a 64-bit hash."""
    h = (h ^ (h >> U64(33))) * _MIX1
    h = (h ^ (h >> U64(33))) * _MIX2
    return h ^ (h >> U64(33))


def chunks(texts: pa.Array | pa.ChunkedArray, lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (first row, bytes, end of each text); every text ends with a newline, null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at, n = 0, len(texts)
    while at < n:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + CHUNK_BYTES, "right")))
        part = texts.slice(at, to - at)
        part = pc.binary_join_element_wise(pc.utf8_lower(part) if lower else part, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        _, ends, data = part.buffers()
        ends = np.frombuffer(ends, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        yield at, data, ends[1:] - ends[0]
        at = to


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] the (position-shifted) hash of data[i:j]."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * _power(_BASE_INV, len(prefix))[start] + (end - start).astype(U64))


def runs(data: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of member bytes (texts end with a separator)."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = member[data]
    change = np.flatnonzero(np.diff(inside)) if len(data) else np.zeros(0, np.int64)
    return change[0::2], change[1::2]


def words(data: np.ndarray, ends: np.ndarray, member: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and the end (in words) of every text."""
    start, end = runs(data, member)
    return range_hash(prefix_hash(data), start, end), start, end, np.searchsorted(start, ends)


def begins(ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(ends), np.int64)
    out[1:] = ends[:-1]
    return out


def per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values within each text."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[begins(ends)]


def spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for n places of each."""
    total = np.cumsum(n)
    return np.repeat(begin - (total - n), n) + np.arange(total[-1] if len(total) else 0)

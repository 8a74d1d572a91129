"""Words of UTF-8 texts as numpy arrays: no Python object per word.

A batch of texts is one byte array plus document offsets.  Words are maximal
runs of bytes other than the ASCII white space ``\\x20 \\x09-\\x0D``; A-Z count
as a-z.  A word's 64-bit hash is a polynomial over its bytes modulo 2^64
(random table value per byte, odd base), finished by a bit mixer, so equal
words have equal hashes in every task and on every run.  Two different words
share a hash with probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 22
_rng = np.random.default_rng(20240607)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_TABLE[65:91] = _TABLE[97:123]
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))
#: factors that tie a word to its place in a window
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer (splitmix64 finish) over uint64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power_arrays(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, min(CHUNK_BYTES, 1 << (n - 1).bit_length()))  # a worker keeps them: no longer than its chunks need
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(n, U64(base), U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers = (out[0], out[1])
    return _powers


@dataclass
class Chunk:
    """Documents ``lo <= d < hi`` of a batch: bytes and offsets into them."""
    lo: int
    hi: int
    data: np.ndarray
    off: np.ndarray


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column in runs of whole documents of about ``limit`` bytes (a longer
    document is a run of its own), which bounds the arrays made from them."""
    data, off = bytes_of(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield Chunk(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


@dataclass
class Words:
    """Word table of a chunk.  ``first[d] .. first[d+1]`` are document d's words."""
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words(c: Chunk) -> Words:
    data, off = c.data, c.off
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, U64), np.zeros(len(off), np.int64))
    space = _SPACE[data]
    left = np.empty(n, bool)
    left[0] = True
    left[1:] = space[:-1]
    right = np.empty(n, bool)
    right[-1] = True
    right[:-1] = space[1:]
    full = off[1:] > off[:-1]
    left[off[:-1][full]] = True
    right[off[1:][full] - 1] = True
    start = np.flatnonzero(~space & left)
    end = np.flatnonzero(~space & right) + 1
    return Words(start, end, span_hash(data, start, end), np.searchsorted(start, off))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every byte span, the same wherever the span stands."""
    n = len(data)
    power, inverse = _power_arrays(max(n, 1))
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum(_TABLE[data] * power[:n], out=total[1:])
    inner = (total[end] - total[start]) * inverse[np.minimum(start, max(n - 1, 0))]
    return mix(inner + (end - start).astype(U64) * _PLACE[63])


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``k`` words inside one
    document."""
    n = len(h)
    if n < k:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    out = h[:n - k + 1] * _PLACE[0]
    for j in range(1, k):
        out = out + h[j:n - k + 1 + j] * _PLACE[j]
    inside = np.ones(n, bool)
    for j in range(1, k):  # the last k-1 words of a document start no window
        p = first[1:] - j
        inside[p[(p >= first[:-1]) & (p >= 0)]] = False
    inside = inside[:n - k + 1]
    at = np.flatnonzero(inside)
    return mix(out[at] ^ U64(k)), at


def shingles(w: Words, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingle hashes per document; with fewer words the
    whole sequence is one shingle, without words none."""
    hs, at = windows(w.hash, w.first, k)
    lo = np.searchsorted(at, w.first)
    for d in range(len(w.first) - 1):
        a, b = lo[d], lo[d + 1]
        if b > a:
            yield np.unique(hs[a:b])
        else:
            own = w.hash[w.first[d]:w.first[d + 1]]
            yield (mix(np.array([(own * _PLACE[:len(own)]).sum(dtype=U64)], U64) ^ U64(len(own)))
                   if len(own) else own)

"""Operator 13 - periodic runs of words, found in a Re-Pair grammar.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
and length of at least ``max(MIN_LENGTH, REPEATS * q)`` that no neighbouring word extends.

Texts are compressed together, ``CHUNK_BYTES`` at a time (a longer text alone); runs never cross a
text's end.  In a chunk:

1. Words become ids (a dictionary, no hashes).
2. Re-Pair in rounds: every repeated pair of neighbouring symbols that is more frequent than the
   pairs it overlaps becomes a nonterminal, all its places at once, until nothing
   repeats or a round shortens the texts by less than 1 in ``LEAST``.  What is left of each text is
   paired up level by level into one symbol, equal pairs again sharing one.
   Copies of a passage share their nonterminals.
3. A run lies whole in the expansion of some nonterminal X -> YZ and crosses the
   boundary of Y and Z.  As it holds REPEATS periods, one period repeats at the
   boundary, at its right or at its left: each period up to a quarter of
   the expansion is tested there, words first, then a hash of the whole period, and those that
   repeat are extended both ways by binary search over hashes.  Every nonterminal is done once.
4. The intervals found are carried to all places of their nonterminals in the texts, going only down
   into symbols that hold one.  Of one text and period, intervals inside
   another are dropped: what is left are the maximal ones.
5. Each run is checked word by word and at both ends; hashes are polynomials modulo
   2^61 - 1 with a base per attempt, and a failed check repeats the chunk with another.

Work is the chunk's length times the grammar's depth; memory a fixed multiple of the
chunk.  There is no shuffle: a document is one row of one task.

:func:`runs` returns spans for any texts.  The query first rewrites some documents (:func:`planted`).

Defined results: null, empty and blank texts have no words, no runs and the empty
text's hash; a null doc_id is never rewritten; repeated rows are each answered;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MIN_LENGTH, REPEATS = 6, 4
CHUNK_BYTES = 1 << 21
PIECE_BYTES = 1 << 20
LEAST = 64
SLICE = 1 << 19
PRIME = (1 << 61) - 1
OUT = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
       "runs_sha256 string, collapsed_sha256 string")
SPANS = "id long, start long, length long, period long"


# ---- arithmetic modulo 2^61 - 1 -------------------------------------------------------------
def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, both below it."""
    u = np.uint64
    ah, al, bh, bl = a >> u(31), a & u((1 << 31) - 1), b >> u(31), b & u((1 << 31) - 1)
    mid = ah * bl + al * bh  # below 2^62
    x = ah * bh * u(2) + (mid >> u(30)) + ((mid & u((1 << 30) - 1)) << u(31)) + al * bl  # 2^62 = 2 modulo the prime
    x = (x & u(PRIME)) + (x >> u(61))
    return np.where(x >= u(PRIME), x - u(PRIME), x)


class Hashes:
    """Hash of every stretch of a sequence, by prefix sums."""

    def __init__(self, ids: np.ndarray, base: int):
        n = len(ids)
        power = np.ones(n + 1, np.uint64)
        done = 1
        while done <= n:  # powers by doubling
            step = np.uint64(pow(base, done, PRIME))
            more = power[:min(done, n + 1 - done)]
            power[done:done + len(more)] = _times(more, np.full(len(more), step, np.uint64))
            done *= 2
        self.power = power
        value = _times((ids + 1).astype(np.uint64), power[:n])
        # sums modulo the prime: high and low halves apart, so that a prefix sum cannot overflow
        high = np.cumsum(value >> np.uint64(31), dtype=np.uint64)
        low = np.cumsum(value & np.uint64((1 << 31) - 1), dtype=np.uint64)
        p = np.uint64(PRIME)
        total = _times(high % p, np.full(n, 1 << 31, np.uint64)) + low % p
        self.prefix = np.concatenate([np.zeros(1, np.uint64), total % p])

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the stretches of ``length`` at a and at b > a the same?"""
        p = np.uint64(PRIME)
        left = (self.prefix[a + length] + p - self.prefix[a]) % p
        right = (self.prefix[b + length] + p - self.prefix[b]) % p
        return _times(left, self.power[b - a]) == right


# ---- the grammar ------------------------------------------------------------------------------
@dataclass
class Grammar:
    """Symbols below ``words`` are words.  Symbol ``words + k`` is ``left[k] right[k]``; its expansion
    also stands in the text at ``at[k]``, ``length[k]`` words long.  ``root[d]`` is text d's symbol (-1: empty)."""
    words: int
    left: np.ndarray
    right: np.ndarray
    at: np.ndarray
    length: np.ndarray
    root: np.ndarray
    rounds: list[int]  # number of rules before each round


def re_pair(ids: np.ndarray, first: np.ndarray) -> Grammar:
    """Grammar of the texts ``ids[first[d]:first[d + 1]]``, each symbol's parts older than itself."""
    words = int(ids.max(initial=-1)) + 1
    seq, at = ids.astype(np.int64), np.arange(len(ids))
    size = np.ones(len(ids), np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    left, right, place, length, rounds = [], [], [], [], []
    known = words

    def shorten(take: np.ndarray, rule: np.ndarray) -> None:
        """Join the symbols at ``take`` with their right neighbours into ``rule``."""
        nonlocal seq, at, size, text
        seq[take] = rule
        size[take] += size[take + 1]
        keep = np.ones(len(seq), bool)
        keep[take + 1] = False
        seq, at, size, text = seq[keep], at[keep], size[keep], text[keep]

    def name(take: np.ndarray) -> np.ndarray:
        """Symbols for the pairs at ``take``, equal pairs alike."""
        nonlocal known
        pair = seq[take] * known + seq[take + 1]
        _, one, which = np.unique(pair, return_index=True, return_inverse=True)
        rounds.append(known - words)
        i = take[one]
        left.append(seq[i])
        right.append(seq[i + 1])
        place.append(at[i])
        length.append(size[i] + size[i + 1])
        rule = known + which
        known += len(one)
        return rule

    while len(seq) > 1:
        inside = text[:-1] == text[1:]
        pair = np.where(inside, seq[:-1] * known + seq[1:], -1)
        distinct, which, count = np.unique(pair, return_inverse=True, return_counts=True)
        often = np.where(distinct >= 0, count, 0)
        # rank of each place: frequency, then the pair itself, so that no two pairs tie
        rank = np.empty(len(distinct), np.int64)
        rank[np.lexsort((distinct, often))] = np.arange(len(distinct))
        r = np.where(often[which] > 1, rank[which], -1)
        before = np.concatenate([[-1], r[:-1]])
        after = np.concatenate([r[1:], [-1]])
        best = (r >= 0) & (r >= before) & (r >= after)
        # in a stretch of one repeated symbol every second place
        start = best & ~(np.concatenate([[False], best[:-1]]) & (before == r))
        index = np.arange(len(r))
        since = index - np.maximum.accumulate(np.where(start, index, 0))
        take = np.flatnonzero(best & (since % 2 == 0))
        uses = np.bincount(which[take], minlength=len(distinct))
        take = take[uses[which[take]] > 1]
        if len(take) * LEAST < len(seq):
            break
        shorten(take, name(take))
    while True:  # what is left of every text: neighbours by twos
        begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else np.zeros(0, np.int64)
        nth = np.arange(len(text)) - np.repeat(begin, np.diff(np.append(begin, len(text))))
        paired = (nth[:-1] % 2 == 0) & (text[:-1] == text[1:])
        take = np.flatnonzero(paired)
        if not len(take):
            break
        shorten(take, name(take))
    root = np.full(len(first) - 1, -1, np.int64)
    root[text] = seq

    def joined(parts):
        return np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64)

    return Grammar(words, joined(left), joined(right), joined(place), joined(length), root, rounds)


# ---- runs -------------------------------------------------------------------------------------
def _extent(same, limit: np.ndarray) -> np.ndarray:
    """The largest e <= limit with same(e), by binary search (same holds up to some e)."""
    low, high = np.zeros(len(limit), np.int64), limit.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        ok = same(mid)
        low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
    return low


def _least(q: np.ndarray) -> np.ndarray:
    return np.maximum(MIN_LENGTH, REPEATS * q)


def boundary_runs(ids: np.ndarray, g: Grammar, hashes: Hashes) -> tuple[np.ndarray, ...]:
    """(rule, start, end, period): the runs of each rule's expansion that cross its boundary, from
    the expansion's start."""
    k = len(g.left)
    part = np.ones(g.words + k, np.int64)
    part[g.words:] = g.length
    cut = part[g.left]
    wide = np.flatnonzero(g.length >= MIN_LENGTH)
    out = []
    for side in (1, -1):
        half = (g.length - cut if side > 0 else cut)[wide] // 2
        most = np.minimum(half, g.length[wide] // REPEATS)
        end = np.cumsum(most)
        total = int(end[-1]) if len(end) else 0
        for a in range(0, total, SLICE):  # (rule, period) pairs, a bounded number at a time
            flat = np.arange(a, min(a + SLICE, total))
            which = np.searchsorted(end, flat, "right")
            q = flat - (end[which] - most[which]) + 1
            rule = wide[which]
            m = g.at[rule] + cut[rule]  # the boundary's place in the text
            near = m if side > 0 else m - 1
            ok = ids[near] == ids[near + side * q]
            rule, q, m = rule[ok], q[ok], m[ok]
            one = m if side > 0 else m - 2 * q
            ok = hashes.equal(one, one + q, q)
            rule, q, one = rule[ok], q[ok], one[ok]
            # the stretch with this period around the square
            lo, hi = g.at[rule], g.at[rule] + g.length[rule]
            ahead = _extent(lambda e: hashes.equal(one, one + q, e), hi - one - q)  # noqa: B023
            back = _extent(lambda e: hashes.equal(one - e, one + q - e, e), one - lo)  # noqa: B023
            start, stop, m = one - back, one + q + ahead, lo + cut[rule]
            ok = (start < m) & (stop > m) & (stop - start >= _least(q))
            out.append((rule[ok], (start - lo)[ok], (stop - lo)[ok], q[ok]))
    rule, start, end, q = (np.concatenate([*(o[i] for o in out), np.zeros(0, np.int64)]).astype(np.int64) for i in range(4))
    # a multiple of the smallest period has the same ends
    order = np.lexsort((q, end, start, rule))
    rule, start, end, q = rule[order], start[order], end[order], q[order]
    new = np.ones(len(rule), bool)
    new[1:] = (rule[1:] != rule[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return rule[new], start[new], end[new], q[new]


def _places(g: Grammar, first: np.ndarray, rule: np.ndarray, start: np.ndarray, end: np.ndarray, q: np.ndarray
            ) -> tuple[np.ndarray, ...]:
    """(start, end, period) of the rules' runs at all their places in the texts."""
    k = len(g.left)
    holds = np.zeros(g.words + k, bool)
    holds[g.words + rule] = True
    bounds = [*g.rounds, k]
    for a, z in zip(bounds[:-1], bounds[1:], strict=True):  # parts are older than the whole
        holds[g.words + a:g.words + z] |= holds[g.left[a:z]] | holds[g.right[a:z]]
    part = np.ones(g.words + k, np.int64)
    part[g.words:] = g.length
    begin = np.searchsorted(rule, np.arange(k + 1))
    text = np.flatnonzero(g.root >= 0)
    symbol, at = g.root[text], first[text]
    found = []
    while True:
        live = holds[symbol]
        symbol, at = symbol[live], at[live]
        if not len(symbol):
            break
        r = symbol - g.words
        count = begin[r + 1] - begin[r]
        has = count > 0
        n, base, from_ = count[has], at[has], begin[r[has]]
        i = np.repeat(from_ - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        shift = np.repeat(base, n)
        found.append((start[i] + shift, end[i] + shift, q[i]))
        symbol, at = np.concatenate([g.left[r], g.right[r]]), np.concatenate([at, at + part[g.left[r]]])
    return tuple(np.concatenate([*(f[i] for f in found), np.zeros(0, np.int64)]).astype(np.int64) for i in range(3))


def _maximal(start: np.ndarray, end: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each period, the intervals that lie in no other one."""
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    far = np.maximum.accumulate(end + q * (int(end.max(initial=0)) + 1))  # a period's ends never reach the next one's
    keep = np.ones(len(q), bool)
    keep[1:] = (end + q * (int(end.max(initial=0)) + 1))[1:] > far[:-1]
    start, end, q = start[keep], end[keep], q[keep]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _proved(ids: np.ndarray, first: np.ndarray, start: np.ndarray, end: np.ndarray, q: np.ndarray) -> bool:
    """Word by word: every run has its period and cannot be extended."""
    text = np.searchsorted(first, start, "right") - 1
    lo, hi = first[text], first[text + 1]
    if (ids[np.maximum(start - 1, 0)] == ids[np.maximum(start - 1, 0) + q])[start > lo].any():
        return False
    last = np.minimum(end, len(ids) - 1)
    if (ids[last] == ids[last - q])[end < hi].any():
        return False
    n = end - start - q
    for a in range(0, len(n), 4096):
        m = n[a:a + 4096]
        i = np.repeat(start[a:a + 4096] - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(int(m.sum()))
        if (ids[i] != ids[i + np.repeat(q[a:a + 4096], m)]).any():
            return False
    return True


def runs_of(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) by start, then period, of all runs of the texts
    ``ids[first[d]:first[d + 1]]``; places count from the first text's start."""
    if len(ids) < MIN_LENGTH:
        z = np.zeros(0, np.int64)
        return z, z, z
    g = re_pair(ids, first)
    attempt = 0
    while True:
        base = int.from_bytes(hashlib.sha256(f"runs {attempt}".encode()).digest()[:7], "little") + 2
        found = _maximal(*_places(g, first, *boundary_runs(ids, g, Hashes(ids, base))))
        if _proved(ids, first, *found):
            return found
        attempt += 1


# ---- texts ------------------------------------------------------------------------------------
def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at white space, or where it has none for long, whole words."""
    a = 0
    while a < len(data):
        z = a + PIECE_BYTES
        while z < len(data) and data[z] not in b" \t\n\r\x0b\x0c":
            z += 1
        yield data[a:z]
        a = z


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) from which a document of n words is rewritten, if it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


class _Chunk:
    """Texts held until they are answered together."""

    def __init__(self, rewrite: bool):
        self.rewrite, self.keys, self.sizes, self.ids, self.bytes = rewrite, [], [], [], 0
        self.number: dict[bytes, int] = {}

    def add(self, key: int | None, text: str | None) -> None:
        number, ids = self.number, []
        data = (text or "").encode("utf-8", "surrogatepass")
        for piece in _pieces(data):
            ids.append(np.array([number.setdefault(w, len(number)) for w in piece.split()], np.int32))
        own = np.concatenate([*ids, np.zeros(0, np.int32)])
        plan = planted(key, len(own)) if self.rewrite else None
        if plan:
            a, p = plan
            own = np.concatenate([own[:a], own[a + np.arange(len(own) - a) % p]])
        self.keys.append(key)
        self.sizes.append(len(own))
        self.ids.append(own)
        self.bytes += len(data) + 64

    def answer(self) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...], list[bytes]]:
        """(ids, first, runs, words)"""
        ids = np.concatenate([*self.ids, np.zeros(0, np.int32)])
        first = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        return ids, first, runs_of(ids, first), list(self.number)


def _chunks(batches: Iterable[pa.RecordBatch], rewrite: bool) -> Iterator[_Chunk]:
    held = _Chunk(rewrite)
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = text.as_py()
            if held.keys and held.bytes + len(text or "") > CHUNK_BYTES:
                yield held
                held = _Chunk(rewrite)
            held.add(key, text)
    if held.keys:
        yield held


def _digest_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query's row of every document."""
    for c in _chunks(batches, True):
        ids, first, (start, end, q), words = c.answer()
        text = np.searchsorted(first, start, "right") - 1
        begin = np.searchsorted(text, np.arange(len(c.keys) + 1))
        step = np.zeros(len(ids) + 1, np.int64)
        np.add.at(step, start + q, 1)
        np.add.at(step, end, -1)
        dropped = np.cumsum(step)[:-1] > 0
        out = []
        for d, key in enumerate(c.keys):
            lo, hi = first[d], first[d + 1]
            r = slice(begin[d], begin[d + 1])
            s, n, p = (start[r] - lo), (end - start)[r], q[r]
            kept = ids[lo:hi][~dropped[lo:hi]].tolist()
            best = [None] * 4
            if len(s):
                i = int(np.argmax(n))  # the first of the longest: smallest start, then period
                best = [int(s[i]), int(n[i]), int(p[i]), 1000 * int(n[i]) // int(p[i])]
            lines = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s.tolist(), n.tolist(), p.tolist(), strict=True))
            out.append((key, int(hi - lo), len(s), *best, hashlib.sha256(lines.encode()).hexdigest(),
                        hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest()))
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                         [f.split()[0] for f in OUT.split(", ")])


def _span_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in _chunks(batches, False):
        _, first, (start, end, q), _ = c.answer()
        text = np.searchsorted(first, start, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([c.keys[t] for t in text], pa.int64()), pa.array(start - first[text]), pa.array(end - start), pa.array(q)],
            ["id", "start", "length", "period"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, period): every run of every text, as written."""
    return _rows(docs, id_col, text_col).mapInArrow(_span_rows, SPANS).withColumnRenamed("id", id_col)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document after :func:`planted` rewriting: number of runs, the longest, digests of all runs and
    of the text without repetitions."""
    return _rows(docs, id_col, text_col).mapInArrow(_digest_rows, OUT).withColumnRenamed("doc_id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    return run_digests(table(spark, sf_dir, "documents"))

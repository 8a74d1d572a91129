"""Operator 3 - benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens: words without outer punctuation, lower-cased.  Numbers,
units after a number and names (title case inside a sentence) become typed
placeholders, their values are the slots.  Windows are ``k`` tokens and enter twice:

* word for word, every window: equal when all lower-cased tokens agree, whatever
  their types (numbers, names and letter case do not matter for a copy);
* as a template, windows with slots and at least ``MIN_LITERAL`` literal tokens: in the
  hash a slot counts as (type, position of the window's first slot of the same value), so
  two windows are equal when their literal words agree and their slots map one to one.

* The benchmark's windows make an index with one row per window hash, item and, for
  windows with slots, place in the item: items of one template share hashes, and
  each is compared by its own slots.  Items shorter than ``k`` tokens are one
  window of their own length; below ``MIN_LITERAL`` tokens it is compared word for word with
  whole sentences and lines only.
* Documents are scanned once, ``CHUNK`` bytes at a time; a Bloom filter of fixed size (whatever the
  benchmark's size) drops most windows before the shuffle, and an exact hash join
  with the index decides the rest.
* Windows of one document and item on one diagonal (document position minus
  item position) form a run.  Item and document are aligned along it, beyond the windows
  as far as literals agree and slots have one type, and every slot aligned is compared: values
  must map one to one.  A run whose slot values contradict each other
  counts only by its windows that agree word for word.

Defined results: null and blank texts match nothing; an item text given twice is
reported under its smallest item_id; repeated rows of documents are reported
each (once per distinct doc_id and item); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X
from .common import cut_lineage, merge_slices, signed, slice_rows, table

K = 8
MIN_LITERAL = 5
BLOOM_BITS = 1 << 24
#: bytes of text worked on at once: a text's windows do not depend on what else is in its chunk
CHUNK = 1 << 19
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3

NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty "
                "seventy eighty ninety hundred thousand million billion").split()
UNIT_WORDS = ("mm cm m km meters metres kilometers kilometres miles mile inches inch feet foot yards mg g kg grams "
              "kilograms tons pounds lbs oz ounces ml l liters litres gallons s sec seconds second min minutes minute "
              "h hr hours hour days day weeks week months month years year mph km/h hz khz mhz ghz kb mb gb tb "
              "dollars dollar euros euro cents percent degrees watts volts joules newtons").split()
_MEASURE = re.compile(rb"[0-9][0-9.,:/-]*([A-Za-z%/]*)\Z")
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_ALNUM[128:] = True
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[33, 46, 58, 63, 10]] = True


def _hash_words(ws: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(ws).encode(), np.uint8)
    end = np.cumsum([len(w) for w in ws])
    return np.sort(X.span_hash(data, end - [len(w) for w in ws], end))


_NUMBERS, _UNITS = _hash_words(NUMBER_WORDS), _hash_words(UNIT_WORDS)
_MEASURES = {w.encode() for w in UNIT_WORDS} | {b"", b"%"}


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


class Tokens:
    """Canonical tokens of a chunk: hash, type (LITERAL, NUMBER, ...) and ``first`` per document."""

    def __init__(self, c: X.Chunk):
        w = X.words(c)
        data = c.data
        solid = np.flatnonzero(_ALNUM[data])
        i, j = np.searchsorted(solid, w.start), np.searchsorted(solid, w.end)
        keep = j > i
        i, j, ws, we = i[keep], j[keep], w.start[keep], w.end[keep]
        start, end = solid[i], solid[j - 1] + 1
        self.first = np.searchsorted(ws, c.off)
        self.hash = X.span_hash(data, start, end) if len(start) else np.zeros(0, np.uint64)
        n = len(start)
        self.type = kind = np.zeros(n, np.int8)
        self.opens = self.closes = np.zeros(n, bool)
        if not n:
            return
        lead = data[start]
        digit = (lead >= 48) & (lead <= 57)
        kind[_among(self.hash, _NUMBERS)] = NUMBER
        raw = data.tobytes()
        for t in np.flatnonzero(digit):
            m = _MEASURE.match(raw[start[t]:end[t]])
            if m and m[1].lower() in _MEASURES:
                kind[t] = NUMBER
        after_number = np.zeros(n, bool)
        after_number[1:] = kind[:-1] == NUMBER
        opening = self.first[:-1][self.first[:-1] < n]
        after_number[opening] = False  # the number is another text's last word
        kind[(kind == 0) & after_number & _among(self.hash, _UNITS)] = UNIT
        # names: title case, not at a document's, line's or sentence's start
        second = data[np.minimum(start + 1, end - 1)]
        title = (lead >= 65) & (lead <= 90) & (end - start > 1) & (second >= 97) & (second <= 122)
        fresh = np.ones(n, bool)
        fresh[1:] = _SENTENCE_END[data[we[:-1] - 1]] | _SENTENCE_END[data[ws[1:] - 1]]
        fresh[opening] = True
        kind[(kind == 0) & title & ~fresh] = NAME
        # the first and the last token of a sentence or line
        ends = np.concatenate([[0], np.cumsum(_SENTENCE_END[data])])
        fresh[1:] |= ends[ws[1:]] > ends[we[:-1] - 1]
        self.opens, self.closes = fresh, np.append(fresh[1:], True)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first token, number of slots, template?) of every window of ``k`` tokens
        word for word, then of those that count as templates."""
        n = len(self.hash)
        if n < k:
            z = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), z, z, np.zeros(0, bool)
        slot = self.type > 0
        exact, at = X.windows(self.hash, self.first, k)
        held = np.concatenate([[0], np.cumsum(slot)])
        slots = held[at + k] - held[at]
        mixed = np.flatnonzero((slots > 0) & (k - slots >= min(MIN_LITERAL, k)))
        if not len(mixed):
            return exact, at, slots, np.zeros(len(at), bool)
        h = X.windows(np.where(slot, np.uint64(0), self.hash), self.first, k)[0][mixed]
        a, extra = at[mixed], np.zeros(len(mixed), np.uint64)
        for j in range(k):
            place = np.full(len(a), j, np.uint64)
            for i in range(j - 1, -1, -1):
                same = slot[a + i] & (self.hash[a + i] == self.hash[a + j])
                place[same] = i
            code = X.mix((place + np.uint64(1)) * X._PLACE[j] + self.type[a + j].astype(np.uint64) * X._PLACE[40])
            extra += np.where(slot[a + j], code, np.uint64(0))
        h = X.mix(h + extra)
        return (np.concatenate([exact, h]), np.concatenate([at, a]), np.concatenate([slots, slots[mixed]]),
                np.arange(len(at) + len(a)) >= len(at))

    def around(self, at: np.ndarray, k: int) -> tuple[list[list[int]], list[list[int]]]:
        """(values as hashes, types) of the windows' tokens and of ``K - 1`` tokens to both
        sides; type -1 outside the document."""
        place = at[:, None] + np.arange(1 - K, k + K - 1)
        doc = np.searchsorted(self.first, at, "right") - 1
        inside = (place >= self.first[doc][:, None]) & (place < self.first[doc + 1][:, None])
        place = np.where(inside, place, 0)
        if not len(at):
            return [], []
        return signed(self.hash)[place].tolist(), np.where(inside, self.type[place], -1).tolist()


def aligned_pairs(k: int, a: np.ndarray, a_type: np.ndarray, b: np.ndarray, b_type: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per pair of equal windows the (item value, document value) of every slot they align: in the window, and
    to both sides of it as far as literals agree and slots have one type."""
    agree = (a_type == b_type) & (a_type >= 0) & ((a_type > LITERAL) | (a == b))
    left = np.logical_and.accumulate(agree[:, :K - 1][:, ::-1], axis=1)[:, ::-1]
    right = np.logical_and.accumulate(agree[:, K - 1 + k:], axis=1)
    held = np.concatenate([left, np.ones((len(a), k), bool), right], axis=1) & (a_type > LITERAL)
    return [list(zip(x[m].tolist(), y[m].tolist(), strict=True)) for x, y, m in zip(a, b, held, strict=True)]


_WINDOW = "w long, id long, pos long, k int, plain boolean, around array<long>, types array<int>"


def _window_rows(batches: Iterable[pa.RecordBatch], sizes, bits=None) -> Iterator[pa.RecordBatch]:
    """Rows (w, id, pos, k, plain, around, types) of each text's windows, ``plain`` without slots, the last
    two null word for word; with ``bits`` only those that may be in the index,
    without only K-windows plus whole short texts.  Windows shorter than ``MIN_LITERAL`` are whole
    sentences or lines."""
    names = [p.split()[0] for p in _WINDOW.split(", ")]
    for b in batches:
        ids = b.column(0).cast(pa.int64())
        for c in X.chunks(b.column(1), CHUNK):
            t = Tokens(c)
            own = ids.slice(c.lo, c.hi - c.lo)
            for k in sizes:
                h, at, slots, template = t.windows(k)
                doc = np.searchsorted(t.first, at, "right") - 1
                if bits is None:
                    ok = (k == K) | (t.first[doc + 1] - t.first[doc] == k)
                    ok = np.broadcast_to(ok, len(at))
                else:
                    s = (h & np.uint64(BLOOM_BITS - 1)).astype(np.int64)
                    ok = (bits.value[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 > 0
                    if k < MIN_LITERAL:
                        ok &= t.opens[at] & t.closes[at + k - 1]
                h, at, doc, slots, template = h[ok], at[ok], doc[ok], slots[ok], template[ok]
                if len(h):
                    empty = [None] * int((~template).sum())  # templates come last
                    around, types = t.around(at[template], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(h)), own.take(pa.array(doc)), pa.array(at - t.first[doc]),
                         pa.array(np.full(len(h), k, np.int32)), pa.array(slots == 0),
                         pa.array(empty + around, pa.list_(pa.int64())), pa.array(empty + types, pa.list_(pa.int32()))], names)


def _pair_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, item_id, diagonal, pos, plain, k, item's around and types, document's) -> the same with pairs."""
    for batch in batches:
        pairs: list = [None] * batch.num_rows
        k, cols = batch.column(5).to_numpy(), [batch.column(i) for i in range(6, 10)]
        slotted = cols[0].is_valid().to_numpy(zero_copy_only=False)
        for size in np.unique(k[slotted]):
            at = np.flatnonzero(slotted & (k == size))
            parts = [c.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1) for c in cols]
            for i, p in zip(at, aligned_pairs(int(size), *parts), strict=True):
                pairs[i] = [{"a": x, "b": y} for x, y in p]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(pairs, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
            [*batch.schema.names[:5], "pairs"])


def _bloom_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(BLOOM_BITS, bool)
    for b in batches:
        h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        seen[(h & np.uint64(BLOOM_BITS - 1)).astype(np.int64)] = True
    yield slice_rows(np.packbits(seen))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """(doc, item_id, n_windows, n_literal_windows, first_word, n_slots): every
    document with a passage of an item, re-parameterised or verbatim."""
    sizes = tuple(range(1, K + 1))
    index = cut_lineage(
        items.groupBy(item_text).agg(F.min(F.col(item_col).cast("long")).alias("id")).select("id", item_text)
        .mapInArrow(lambda it: _window_rows(it, sizes), _WINDOW)
        # a window that agrees word for word counts wherever it stands in the item
        .groupBy("w", "k", "id", F.when(F.col("around").isNotNull(), F.col("pos")).alias("place"))
        .agg(F.min(F.struct("pos", "around", "types")).alias("m"))
        .select("w", "k", F.col("id").alias("item_id"), F.col("m.pos").alias("item_pos"), F.col("m.around").alias("item_around"),
                F.col("m.types").alias("item_types")))
    lengths = tuple(sorted(r["k"] for r in index.select("k").distinct().collect()))  # at most K
    bits = docs.sparkSession.sparkContext.broadcast(
        merge_slices(index.select("w").mapInArrow(_bloom_rows, "slice int, counts binary"), BLOOM_BITS // 8, np.uint8, "or"))
    found = (docs.select(F.col(id_col).cast("long"), F.col(text_col))
             .mapInArrow(lambda it: _window_rows(it, lengths, bits), _WINDOW)
             .join(index, ["w", "k"])
             .select("id", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal"), "pos", "plain", "k", "item_around",
                     "item_types", "around", "types"))
    run = ["id", "item_id", "diagonal"]
    # two Python steps in one stage would need two workers for each task: the first one's rows are written
    found = cut_lineage(cut_lineage(found).mapInArrow(_pair_rows, "id long, item_id long, diagonal long, pos long, plain boolean, "
                                                     "pairs array<struct<a: long, b: long>>"))
    # slots of a run map one to one: neither a value of the item nor one of the document has two partners
    each = found.select(*run, F.explode("pairs").alias("p")).select(*run, "p.a", "p.b").distinct()
    both = (each.select(*run, F.lit(0).alias("side"), F.col("a").alias("v"), F.col("b").alias("partner"))
            .unionAll(each.select(*run, F.lit(1), "b", "a")))
    clash = (both.groupBy(*run, "side", "v").agg((F.min("partner") != F.max("partner")).alias("clash")).groupBy(*run)
             .agg(F.max("clash").alias("clash"), F.count_if(F.col("side") == 0).alias("slots")))
    hits = (found.join(clash.withColumnsRenamed({c: f"c_{c}" for c in run}),
                       [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in run], "left")
            .where("pairs IS NULL OR NOT clash"))
    # a window of the document counts once for an item, however many places of the item it equals
    runs = (hits.groupBy(*run).agg(F.max(F.coalesce("slots", F.lit(0))).alias("slots")).groupBy("id", "item_id")
            .agg(F.sum("slots").alias("n_slots")).withColumnsRenamed({"id": "r_id", "item_id": "r_item"}))
    words = (hits.groupBy("id", "item_id", "pos").agg(F.max(F.col("pairs").isNull() & F.col("plain")).alias("literal")).groupBy("id", "item_id")
             .agg(F.count("*").alias("n_windows"), F.count(F.when(F.col("literal"), 1)).alias("n_literal_windows"),
                  F.min("pos").alias("first_word")))
    return (words.join(runs, F.col("id").eqNullSafe(F.col("r_id")) & F.col("item_id").eqNullSafe(F.col("r_item")))
            .select(F.col("id").alias(id_col), "item_id", "n_windows", "n_literal_windows", "first_word", "n_slots"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against the whole ``benchmark``; flagged pairs only."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

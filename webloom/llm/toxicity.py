"""Operator 4 - character n-gram linear classifier with naive Bayes scaling.

Features are the distinct character n-grams of a whole text, 3 to 5 code points of the
lower-cased text and 4 to 6 of the text as written (white space as blanks),
hashed into 2^20 slots.  From labelled texts:

1. distributed counts give each slot's documents per class, and the log-count ratio
   ``r = log((p + a) / (P + 2a)) - log((n + a) / (N + 2a))``
2. all slots in at least ``MIN_DOCS`` documents with |r| >= ``MIN_RATIO`` are features; the
   others tell the classes apart too little to be worth a weight
3. a logistic regression over the features scaled by r (numpy, full
   batches, L2) gives the weights

The labelled sample is bounded: the ``SAMPLE`` rows of smallest hash, so that
the broadcast label list and the driver's sparse rows (one integer for each distinct feature of
a sampled text) are.  Scoring reads every whole text:
sigmoid of the bias plus the weights of the text's distinct features.

Labels come only from rows whose crc32(doc_id as text) mod 4 is not 2; label, language, source
and id are never inputs of a score.

Defined results: null and empty texts have no feature (score: the bias);
several labels of a doc_id count as toxic if one of them is; null labels and labels without
a document are ignored; a null doc_id is never labelled; without both classes
the score is the prior; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, hash_share, merge_slices, slice_rows, table

#: (lower-cased?, orders) of the n-grams
VIEWS = ((True, (3, 4, 5)), (False, (4, 5, 6)))
LONGEST = 6
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
SAMPLE = 20_000
MIN_DOCS, MIN_RATIO, ALPHA = 5, 1.0, 1.0
CUT = 0.3
PIECE_CHARS = 1 << 16
ENTRIES = 1 << 18
_FACTOR = np.random.default_rng(4).integers(1, 1 << 31, 8, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _slots(c: np.ndarray, orders: tuple[int, ...], salt: int) -> Iterator[np.ndarray]:
    """The slot of the n-gram at every position, for each order n."""
    h = c * _FACTOR[0] + np.uint32(salt)
    for n in range(1, min(max(orders), len(c))):
        h = h[:-1] + c[n:] * _FACTOR[n]
        if n + 1 in orders:
            m = h ^ (h >> np.uint32(15))
            m *= np.uint32(0x2C1B3C6D)
            yield (m >> np.uint32(32 - SLOT_BITS)).astype(np.int32)


class Features:
    """The distinct slots with a non-zero entry in ``table`` of one text after another.

    A text is read in pieces of ``PIECE_CHARS`` code points, each with the last
    ``LONGEST - 1`` of the piece before it.  Memory is two arrays over the slots and one
    piece, whatever the text's length."""

    def __init__(self, table: np.ndarray):
        self.used = table != 0
        self.last = np.zeros(SLOTS, np.int32)
        self.seen = np.zeros(SLOTS, bool)

    def _new(self, c: np.ndarray, lower: bool) -> np.ndarray:
        s = np.concatenate([*_slots(c, VIEWS[0][1] if lower else VIEWS[1][1], 977 * (not lower)), np.zeros(0, np.int32)])
        s = s[self.used[s] & ~self.seen[s]]
        at = np.arange(len(s), dtype=np.int32)
        self.last[s] = at  # of equal slots the last place stays
        return s[self.last[s] == at]

    def pieces(self, text: str | None) -> Iterator[np.ndarray]:
        """Slots of the text not given before, piece by piece."""
        given = []
        for lower, _ in VIEWS:
            tail = np.zeros(0, np.uint32)
            for a in range(0, len(text or ""), PIECE_CHARS):
                part = text[a:a + PIECE_CHARS]
                c = np.frombuffer((part.lower() if lower else part).encode("utf-32-le", "surrogatepass"), "<u4")
                c = np.concatenate([tail, np.where((c >= 9) & (c <= 13), np.uint32(32), c)])
                tail = c[-(LONGEST - 1):]
                found = self._new(c, lower)
                self.seen[found] = True
                yield found
                given.append(found)
        for found in given:  # a text gives each slot once: SLOTS numbers at most
            self.seen[found] = False

    def of(self, text: str | None) -> np.ndarray:
        return np.concatenate([*self.pieces(text), np.zeros(0, np.int32)])


def _count_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per slot (texts of one class)."""
    total, features = np.zeros(SLOTS, np.uint32), Features(np.ones(SLOTS, bool))
    for b in batches:
        for text in b.column(0):
            for found in features.pieces(text.as_py()):
                total[found] += 1
    yield slice_rows(total)


def _feature_rows(batches: Iterable[pa.RecordBatch], chosen) -> Iterator[pa.RecordBatch]:
    """(toxic, slots) of each labelled text."""
    features = Features(chosen.value)
    for b in batches:
        lists = [features.of(t.as_py()) for t in b.column(0)]
        off = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column(1), pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([*lists, np.zeros(0, np.int32)])))],
            ["toxic", "slots"])


def regress(y: np.ndarray, count: np.ndarray, flat: np.ndarray, ratio: np.ndarray, steps: int = 200, l2: float = 5e-3,
            rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression (Adam, full batches) over features scaled by ``ratio``: row i has
    label ``y[i]`` and the next ``count[i]`` slots of ``flat``.  Returns the weight per slot,
    already scaled, and the bias."""
    y = y.astype(np.float64)
    row = np.repeat(np.arange(len(y), dtype=np.int32), count)
    used = np.flatnonzero(np.bincount(flat, minlength=SLOTS))
    place = np.zeros(SLOTS, np.int32)
    place[used] = np.arange(len(used))
    scale = ratio[used]
    w, b = np.zeros(len(used)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    parts = [slice(a, a + ENTRIES) for a in range(0, len(flat), ENTRIES)]  # bounds what a step holds beside the rows
    for t in range(1, steps + 1):
        z, g = np.full(len(y), b), np.zeros(len(used))
        scaled = w * scale
        for p in parts:
            z += np.bincount(row[p], scaled[place[flat[p]]], len(y))
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        for p in parts:
            g += np.bincount(place[flat[p]], e[row[p]], len(used))
        g = np.append(g * scale + l2 * w, e.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        d = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w -= d[:-1]
        b -= d[-1]
    out = np.zeros(SLOTS, np.float32)
    out[used] = w * scale
    return out, b


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fold: int | None = 2, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """(weight per slot, bias) from the labelled rows outside ``fold``."""
    sc = docs.sparkSession.sparkContext
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic")))
    if fold is not None:
        lab = lab.where(F.crc32(F.col("id").cast("string").cast("binary")) % 4 != fold)
    total = lab.count()
    lab = cut_lineage(lab.where(hash_share("id", sample, total)))
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                       .join(F.broadcast(lab), "id").select("text", "toxic"))
    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    P, N = size.get(1, 0), size.get(0, 0)
    if not P or not N:
        return np.zeros(SLOTS, np.float32), float(np.log((P + 0.01) / (N + 1)))
    p, n = (merge_slices(rows.where(F.col("toxic") == k).select("text").mapInArrow(_count_rows, "slice int, counts binary"), SLOTS)
            .astype(np.float64) for k in (1, 0))
    ratio = np.log((p + ALPHA) / (P + 2 * ALPHA)) - np.log((n + ALPHA) / (N + 2 * ALPHA))
    chosen = (p + n >= MIN_DOCS) & (np.abs(ratio) >= MIN_RATIO)
    bc = sc.broadcast(chosen)
    got = rows.mapInArrow(lambda it: _feature_rows(it, bc), "toxic int, slots array<int>").toArrow()
    slots = got.column("slots").combine_chunks()
    return regress(got.column("toxic").to_numpy(), slots.value_lengths().to_numpy(), slots.flatten().to_numpy(), ratio)


class Scorer:
    """Scores of texts in a worker."""

    def __init__(self, model: tuple[np.ndarray, float]):
        self.weight, self.bias = model
        self.features = Features(self.weight)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        z = np.array([self.bias + sum(float(self.weight[f].sum(dtype=np.float64)) for f in self.features.pieces(t.as_py()))
                      for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _score_rows(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Every column of the input and its score; the text is the last column but the score."""
    scores = Scorer(model.value)
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores(b.column(b.num_columns - 1)))],
                                         [*b.schema.names[:-1], "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    bc = docs.sparkSession.sparkContext.broadcast(model)
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held.alias("held_out"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda it: _score_rows(it, bc), "id long, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` with a score below ``cut``, columns unchanged."""
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches):
        scores = Scorer(bc.value)
        for b in batches:
            yield b.filter(pa.array(scores(b.column(at)) < cut))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(clean, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``, from the labels of ``labels.toxic``."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))

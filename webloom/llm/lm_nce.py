"""Operator 1 - log-bilinear language model trained by noise-contrastive estimation.

Corpus statistics cover every training document: a distributed count of every
token gives N, V and each word's count.  The model predicts a *unit* from the
four units before it: the end token, the ``HEAD`` most frequent words, or one of
256 surface classes (of a word's last three bytes) for all other words.

* prediction vector: sum over positions of ``scale_j * R[unit_{t-j}]``
* logits: ``vector . Q[u] + b[u]``; the softmax over all units makes the
  probabilities sum to one (batched matrix products)
* a word of class g: ``p(class | context) * (c + 1) / (C_g + V_g + 1)`` with the
  class's token and word counts; the last 1 is the class's unknown word

Training is numpy NCE, minibatch AdaGrad, shared noise from the unit unigram.  Every
partition trains on all its training documents from the same start; the
parameters are averaged by token count on the executors, for a first round
over 1/16 of the documents (by hash) and a second over all of them.  The rounds
are the same for every size of the corpus.

A table of the most frequent words (at most ``TABLE`` entries, chosen by a
count threshold) is broadcast; all other words of the texts go through a
shuffle join with the count table, so results do not depend on the bound.

Words are 56-bit hashes plus the 8-bit class.  Defined results: null text is
the empty text (one end token); a null doc_id counts as the empty string in
the split rule; repeated rows are scored each; extra columns are ignored;
without training rows N = V = 0 and every word is unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X
from .common import cut_lineage, signed, table

HEAD, CLASSES = 255, 256
UNITS = HEAD + 1 + CLASSES
BOS = UNITS
DIM, CONTEXT, NOISE, BATCH = 16, 4, 64, 512
#: (one document in how many, rate) of every training round, whatever the corpus's size
ROUNDS = ((16, 1.), (1, 1.))
#: what :func:`rounds_for` goes by
LEARN_TOKENS, PASSES = 4_000_000, 16
PART_TOKENS = 1 << 16
TABLE = 1 << 19
END = np.uint64(0)
FLUSH_TOKENS = 1 << 22
_SLOT_BITS = 21


# ---- tokens --------------------------------------------------------------------------
def stream(c: X.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(word ids with one end per document, offsets of the documents in it)."""
    w = X.words(c)
    h = np.zeros(len(w.hash), np.uint64)
    for j in (1, 2, 3):
        p = w.end - j
        h += np.where(p >= w.start, X._TABLE[c.data[np.maximum(p, 0)]] if len(c.data) else h, np.uint64(0)) * X._PLACE[j]
    ids = (w.hash & ~np.uint64(255)) | (X.mix(h) & np.uint64(255))
    n = len(w.first) - 1
    off = w.first + np.arange(n + 1)
    out = np.full(int(off[-1]), END, np.uint64)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(w.first))] = ids
    return out, off


def _count_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) summed over runs of the partition's tokens."""
    held: list[np.ndarray] = []

    def flush():
        word, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(signed(word)), pa.array(n.astype(np.int64))], ["word", "n"])

    for b in batches:
        for c in X.chunks(b.column(0)):
            held.append(stream(c)[0])
            if sum(map(len, held)) >= FLUSH_TOKENS:
                yield flush()
    if held:
        yield flush()


class Vocabulary:
    """Frequent words in an open-addressing table: counts and units by word id."""

    def __init__(self, word: np.ndarray, count: np.ndarray):
        rank = np.lexsort((word, -count))
        rank = rank[word[rank] != END][:HEAD]
        unit = (HEAD + 1 + (word & np.uint64(255)).astype(np.int64)).astype(np.int16)
        unit[rank] = np.arange(1, len(rank) + 1)
        unit[word == END] = 0
        self.count, self.unit, self.head = count.astype(np.int64), unit, rank
        size = 1 << _SLOT_BITS
        self.key, self.at = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        left = np.arange(len(word))
        slot = (word >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        while len(left):
            free = self.at[slot[left]] < 0
            pick, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.key[pick], self.at[pick] = word[put], put
            done = np.zeros(len(word), bool)
            done[put] = True
            left = left[~done[left]]
            taken = self.at[slot[left]] >= 0
            slot[left[taken]] = (slot[left[taken]] + 1) & (size - 1)

    def find(self, word: np.ndarray) -> np.ndarray:
        """Row of each word, -1 where it is not in the table."""
        slot = (word >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        at = self.at[slot]
        out = np.where((at >= 0) & (self.key[slot] == word), at, -1)
        left = np.flatnonzero((at >= 0) & (out < 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.at) - 1)
            a = self.at[slot[left]]
            hit = (a >= 0) & (self.key[slot[left]] == word[left])
            out[left[hit]] = a[hit]
            left = left[(a >= 0) & ~hit]
        return out

    def units(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        own = HEAD + 1 + (word & np.uint64(255)).astype(np.int64)
        return np.where(at >= 0, self.unit[at] if len(self.unit) else 0, np.where(word == END, 0, own))


def contexts(unit: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(n, CONTEXT) units before each token of its document, BOS beyond its start."""
    n = len(unit)
    place = np.arange(n) - np.repeat(off[:-1], np.diff(off))
    out = np.full((n, CONTEXT), BOS, np.int64)
    for j in range(1, CONTEXT + 1):
        ok = place >= j
        out[ok, j - 1] = unit[np.flatnonzero(ok) - j]
    return out


# ---- the model -------------------------------------------------------------------------
@dataclass
class Model:
    R: np.ndarray      # (UNITS + 1, DIM) context vectors
    Q: np.ndarray      # (UNITS, DIM) target vectors
    b: np.ndarray      # (UNITS,) biases
    scale: np.ndarray  # (CONTEXT, DIM) position weights

    @staticmethod
    def start(unigram: np.ndarray) -> Model:
        rng = np.random.default_rng(7)
        f = np.float32
        return Model((rng.normal(0, .1, (UNITS + 1, DIM))).astype(f), rng.normal(0, .1, (UNITS, DIM)).astype(f),
                     np.log(unigram).astype(f), np.full((CONTEXT, DIM), 1 / CONTEXT, f))

    def pack(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.R, self.Q, self.b, self.scale)]).astype(np.float64)

    @staticmethod
    def unpack(v: np.ndarray) -> Model:
        out, at = [], 0
        for shape in ((UNITS + 1, DIM), (UNITS, DIM), (UNITS,), (CONTEXT, DIM)):
            n = math.prod(shape)
            out.append(v[at:at + n].reshape(shape).astype(np.float32))
            at += n
        return Model(*out)

    def hidden(self, ctx: np.ndarray) -> np.ndarray:
        return np.einsum("njd,jd->nd", self.R[ctx], self.scale)

    def log_probs(self, unit: np.ndarray, off: np.ndarray, block: int = 512) -> np.ndarray:
        """Normalised natural log-probability of every token's unit.  Each distinct context is normalised
        once; a block of logits stays in cache."""
        ctx = contexts(unit, off)
        packed = ctx[:, 0]
        for j in range(1, CONTEXT):
            packed = packed * (UNITS + 1) + ctx[:, j]
        _, one, which = np.unique(packed, return_index=True, return_inverse=True)
        ctx = ctx[one]
        h, log_sum = np.empty((len(ctx), DIM), np.float32), np.empty(len(ctx))
        side = np.concatenate([self.Q, self.b[:, None]], axis=1).T.copy()
        ones = np.ones(UNITS, np.float32)
        # no logit is above this bound, so no sum overflows; sums that could vanish below it are shifted on their own
        wide = float(np.linalg.norm(self.Q, axis=1).max())
        for a in range(0, len(ctx), block):
            x = self.hidden(ctx[a:a + block])
            h[a:a + block] = x
            z = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1) @ side
            top = 0.0
            if float(np.linalg.norm(x, axis=1).max(initial=0)) * wide + float(np.abs(self.b).max()) > 60:
                top = z.max(1)
                z -= top[:, None]
            np.exp(z, out=z)
            log_sum[a:a + block] = np.log(z @ ones) + top
        own = np.einsum("nd,nd->n", h[which], self.Q[unit]) + self.b[unit]
        return own - log_sum[which]


def _scatter(rows: np.ndarray, index: np.ndarray, out: np.ndarray) -> None:
    """Add ``rows`` to ``out`` by index."""
    order = np.argsort(index.astype(np.int16), kind="stable")  # radix sort
    key = index[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    out[key[begin]] += np.add.reduceat(rows[order], begin, axis=0)


class Trainer:
    """Minibatch NCE with AdaGrad steps."""

    def __init__(self, model: Model, unigram: np.ndarray, seed: int, rate: float):
        self.m, self.rate, self.rng = model, rate, np.random.default_rng(seed)
        self.cdf = np.cumsum(unigram)
        self.log_kp = np.log(NOISE * unigram).astype(np.float32)
        self.sum = [np.full_like(x, 1e-2) for x in (model.R, model.Q, model.b, model.scale)]
        self.seen = 0

    def fit(self, unit: np.ndarray, off: np.ndarray) -> None:
        ctx = contexts(unit, off)
        order = self.rng.permutation(len(unit))
        for a in range(0, len(order), BATCH):
            i = order[a:a + BATCH]
            self.step(ctx[i], unit[i])
        self.seen += len(unit)

    def step(self, ctx: np.ndarray, y: np.ndarray) -> None:
        m, n = self.m, len(y)
        noise = np.searchsorted(self.cdf, self.rng.random(NOISE)).clip(max=UNITS - 1)
        seen, own, other = m.R[ctx], m.Q[y], m.Q[noise]
        h = np.einsum("njd,jd->nd", seen, m.scale)
        data = -1 / (1 + np.exp(np.einsum("nd,nd->n", h, own) + m.b[y] - self.log_kp[y]))
        fake = 1 / (1 + np.exp(-(h @ other.T + (m.b[noise] - self.log_kp[noise]))))
        dh = data[:, None] * own + fake @ other
        dQ, dR = np.zeros_like(m.Q), np.zeros_like(m.R)
        _scatter(data[:, None] * h, y, dQ)
        _scatter(fake.T @ h, noise, dQ)
        db = np.bincount(y, data, UNITS)
        db += np.bincount(noise, fake.sum(0), UNITS)
        dscale = np.einsum("njd,nd->jd", seen, dh)
        _scatter((dh[:, None, :] * m.scale).reshape(-1, DIM), ctx.ravel(), dR)
        db = db.astype(np.float32)
        for x, g, s in zip((m.R, m.Q, m.b, m.scale), (dR, dQ, db, dscale), self.sum, strict=True):
            g = g / n
            s += g * g
            x -= self.rate * g / np.sqrt(s)


def _train_rows(batches: Iterable[pa.RecordBatch], vocab, start, unigram, rate: float) -> Iterator[pa.RecordBatch]:
    """One row per partition: parameters times tokens, and the token count."""
    t = None
    for b in batches:
        for c in X.chunks(b.column(0)):
            word, off = stream(c)
            if t is None:
                t = Trainer(Model.unpack(start.value), unigram.value, 11, rate)
            t.fit(vocab.value.units(word, vocab.value.find(word)), off)
    if t is not None:
        yield pa.RecordBatch.from_arrays([pa.array([float(t.seen)]), pa.array([(t.m.pack() * t.seen).tobytes()], pa.binary())],
                                         ["tokens", "params"])


def _add_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0.0, None
    for b in batches:
        for t, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            v = np.frombuffer(p)
            n, total = n + t, v.copy() if total is None else total + v
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()], pa.binary())], ["tokens", "params"])


def rounds_for(tokens: int) -> list[tuple[int, float]]:
    """Rounds for callers who want a corpus of fewer than ``LEARN_TOKENS`` read several times (``PASSES`` at most): a
    first look at one in 16, then passes over all documents, the last of several at half the rate.  Nothing here calls it:
    scores of a corpus do not change their schedule with its size."""
    passes = min(PASSES, max(1, -(-LEARN_TOKENS // max(tokens, 1))))
    return [(16, .1), *[(1, .1)] * max(passes - 1, 1), *[(1, .05)] * (passes > 1)]


def train(texts: DataFrame, vocab, unigram, tokens: int, rounds=ROUNDS) -> Model:
    """Rounds over the documents; each averages the models that the partitions trained from the
    common start."""
    # a model of too few steps is worth little in the average: at least PART_TOKENS each
    texts = texts.coalesce(max(1, tokens // PART_TOKENS))
    sc = texts.sparkSession.sparkContext
    params = Model.start(unigram.value).pack()
    schema = "tokens double, params binary"
    for share, rate in rounds:
        start = sc.broadcast(params)
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0) if share > 1 else texts
        done = (part.mapInArrow(lambda it, s=start, r=rate: _train_rows(it, vocab, s, unigram, r), schema)
                .repartition(8).mapInArrow(_add_rows, schema).collect())
        if done:
            params = sum(np.frombuffer(r["params"]) for r in done) / sum(r["tokens"] for r in done)
    return Model.unpack(params)


# ---- scoring -----------------------------------------------------------------------------
_ROWS = ("rid long, doc_id long, held_out boolean, n_tokens long, model double, found long, found_log double, "
         "found_tail double, missing array<long>")


def _score_rows(batches: Iterable[pa.RecordBatch], vocab, model, log_z) -> Iterator[pa.RecordBatch]:
    """Per document the model's log10 sum, the base's parts for words of the
    broadcast table, and the word ids outside it."""
    v, m, lz = vocab.value, model.value, log_z.value
    for b in batches:
        out: list[list] = [[] for _ in range(5)]
        missing, lengths = [], []
        for c in X.chunks(b.column(3)):
            word, off = stream(c)
            at = v.find(word)
            unit = v.units(word, at)
            found = at >= 0
            log_c = np.where(found, np.log10(v.count[at] + 1.0) if len(v.count) else 0.0, 0.0)
            tail = unit > HEAD
            lp = m.log_probs(unit, off) / math.log(10) - np.where(tail, lz[unit - HEAD - 1], 0.0)
            total = lambda x: np.add.reduceat(x, off[:-1])  # noqa: E731  every document has its end token
            for k, x in enumerate((np.diff(off), total(lp), total(found.astype(np.int64)), total(log_c),
                                   total(np.where(tail, log_c, 0.0)))):
                out[k].append(x)
            out_at = ~found & (word != END)
            missing.append(word[out_at])
            lengths.append(total(out_at.astype(np.int64)))
        cols = [np.concatenate(x) if x else np.zeros(0) for x in out]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]) if lengths else np.zeros(1)
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                         pa.array(signed(np.concatenate(missing)) if missing else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1).cast(pa.int64()), b.column(2), pa.array(cols[0].astype(np.int64)), pa.array(cols[1]),
             pa.array(cols[2].astype(np.int64)), pa.array(cols[3]), pa.array(cols[4]), lists],
            ["rid", "doc_id", "held_out", "n_tokens", "model", "found", "found_log", "found_tail", "missing"])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds=ROUNDS) -> DataFrame:
    """Score every row of ``docs``; see the module text for the model."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    texts = rows.where("NOT held_out").select("text")

    counts = cut_lineage(texts.mapInArrow(_count_rows, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    least, kept = 10 ** 6, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        kept += r["words"]
        if kept > TABLE:
            break
        least = r["step"]
    frequent = (step >= least) | (F.col("word") == 0)
    got = counts.where(frequent).toPandas()
    word, n = got["word"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)
    vocab = Vocabulary(word, n)
    # the rest of each surface class: all words but the end and the head words
    by_class = np.zeros((2, CLASSES), np.int64)
    for r in (counts.where("word != 0").groupBy(F.col("word").bitwiseAND(255).alias("c"))
              .agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()):
        by_class[:, r["c"]] = r["n"], r["v"]
    n_end = int(n[word == END].sum())
    N = int(by_class[0].sum()) + n_end
    V = int(by_class[1].sum()) + int(n_end > 0)
    own = (word[vocab.head] & np.uint64(255)).astype(np.int64)
    np.subtract.at(by_class[0], own, n[vocab.head])
    np.subtract.at(by_class[1], own, 1)
    unigram = np.ones(UNITS)
    unigram[0] += n_end
    unigram[1:1 + len(vocab.head)] += n[vocab.head]
    unigram[HEAD + 1:] += by_class[0]
    shared, uni = sc.broadcast(vocab), sc.broadcast(unigram / unigram.sum())
    model = sc.broadcast(train(texts, shared, uni, N, rounds))
    log_z = sc.broadcast(np.log10(by_class.sum(0) + 1.0))

    scored = cut_lineage(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text")
                         .mapInArrow(lambda it: _score_rows(it, shared, model, log_z), _ROWS))
    rare = counts.where(~frequent)
    outside = (scored.select("rid", F.explode("missing").alias("word")).join(rare, "word")
               .groupBy("rid").agg(F.count("*").alias("known"), F.sum(F.log10(F.col("n") + 1)).alias("logs")))
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.drop("missing").join(outside, "rid", "left").select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens",
        (F.col("found") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(N).cast("long").alias("train_tokens"),
        (F.col("found_log") + logs - F.col("n_tokens") * math.log10(N + V + 1)).alias("base_score"),
        (F.col("model") + F.col("found_tail") + logs).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))

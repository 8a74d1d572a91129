"""Operator 11 - near-duplicate documents by MinHash with tensored banding.

Documents are sets of distinct k-word shingles (64-bit hashes of lower-cased words); two of them
link when ``den * |A n B| >= num * |A u B|``.

A table key of plain banding is made of its own ``2 * HALF`` minhashes.  Here two collections of
``SIDE`` half keys (``HALF`` minhashes each) are computed, and a table's key is one half of the first
with one half of the second: ``SIDE^2`` tables from ``2 * SIDE * HALF`` minhashes, a square root
of what as many independent tables take.  Two sets of similarity s share a table with probability
``(1 - (1 - s^HALF)^SIDE)^2``: 0.9999 at 0.8 and more above it, 0.006 at 0.2.

1. One pass over the texts writes each document's set size, its 64-bit fingerprint, a second one and the
   half keys.  Documents of equal fingerprint form a class; if two second fingerprints ever
   stand for one fingerprint, the pass is repeated with another seed (so classes are equal to 128 bits).
2. Half keys that only one class has cannot be part of a shared table key; only the others are
   combined.  Table keys of two classes or more are the buckets.
3. Hubs: each class is compared, whole set against whole set, with the smallest class of its buckets.
   That is one pair per class and joins up large groups of copies.  A bucket whose classes then
   belong to one component is finished.
4. Classes that meet in any other bucket are gathered into clusters, cut into blocks
   of bounded bytes by size band, and a task finds all links between the components it holds: sets
   not yet reached stand in an inverted index, each set reached is counted against them once, and the
   index is rebuilt whenever half of them have been reached.
5. Components of the links; each class takes its component's smallest doc_id.

Links are only ever made from whole sets.  No pair of a group is emitted: rows are
linear in documents times tables, tasks hold two blocks.  An unfinished cluster of B blocks
takes up to B^2 / 2 tasks.

Defined results: null or blank texts have the empty set, link with nothing and
form their own component; fewer than k words make one shingle of the whole sequence; repeated rows are
copies, with one answer; a null doc_id never becomes a component id unless all ids of the component are null, and
is kept only then; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X
from .common import components, cut_lineage, signed, table
from .jaccard_join import BLOCK_BYTES, _block_pairs, _bloom, _bloom_slots, linked_rows

#: half keys of a collection, minhashes of a half key
SIDE, HALF = 14, 3
_rng = np.random.default_rng(1101)
_TOSS = _rng.integers(0, 1 << 63, 2 * SIDE * HALF, dtype=np.uint64)
_TURN = _rng.integers(0, 1 << 63, 2 * SIDE * HALF, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprints(s: np.ndarray, seed: int) -> tuple[int, int]:
    """Two signed 64-bit digests of a sorted set."""
    d = hashlib.blake2b(s.tobytes(), digest_size=16, salt=seed.to_bytes(4, "little")).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def half_keys(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x 2 * SIDE) half keys of non-empty sets: first the one collection, then the other."""
    flat = np.concatenate(sets)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2 * SIDE), np.uint64)
    for i in range(2 * SIDE):
        key = np.full(len(sets), i, np.uint64)  # a half is its own, whatever values another has
        for t in range(i * HALF, (i + 1) * HALF):
            key = X.mix(key ^ np.minimum.reduceat((flat ^ _TOSS[t]) * _TURN[t], begin))
        out[:, i] = key
    return out


def _set_rows(batches: Iterable[pa.RecordBatch], k: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(id, n, fp, check, keys) per document; keys for the first document of a set in a partition."""
    done: set[int] = set()
    for b in batches:
        n, fp, check, new, fresh = [], [], [], [], []
        for c in X.chunks(b.column(1)):
            for s in X.shingles(X.words(c), k):
                f, g = fingerprints(s, seed)
                if len(s) and f not in done:
                    done.add(f)
                    new.append(len(n))
                    fresh.append(s)
                n.append(len(s))
                fp.append(f)
                check.append(g)
        at = np.zeros(len(n) + 1, np.int32)
        at[np.array(new, np.int64) + 1] = 2 * SIDE
        keys = signed(half_keys(fresh)).ravel() if fresh else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(check, pa.int64()),
             pa.ListArray.from_arrays(pa.array(np.cumsum(at, dtype=np.int32)), pa.array(keys))],
            ["id", "n", "fp", "check", "keys"])


def _member_sets(batches: Iterable[pa.RecordBatch], k: int, seed: int, bits) -> Iterator[pa.RecordBatch]:
    """(fp, n, shingles) of the sets that may be wanted, each once per partition."""
    done: set[int] = set()
    for b in batches:
        rows = []
        for c in X.chunks(b.column(0)):
            for s in X.shingles(X.words(c), k):
                f = fingerprints(s, seed)[0]
                at = int(_bloom_slots(np.array([f], np.int64))[0])
                if len(s) and f not in done and bits.value[at >> 3] >> (7 - (at & 7)) & 1:
                    done.add(f)
                    rows.append((f, len(s), s.tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True),
                                              (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["fp", "n", "shingles"])


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


# ---- inside one task ------------------------------------------------------------------------
def links_between(sets: list[np.ndarray], group: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Links that join the groups: every set is counted once against all sets that no link has
    reached from it yet, so the returned pairs connect exactly what all links would."""
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    _, group = np.unique(np.array(group, np.int64), return_inverse=True)
    out, waiting = [], np.ones(len(sets), bool)  # waiting: not reached
    tokens = int(flat.max()) + 1

    def index():
        held = np.flatnonzero(waiting)
        cell = np.repeat(waiting, size)
        tok, own = flat[cell], np.repeat(held, size[held])
        order = np.argsort(tok, kind="stable")
        return own[order], np.searchsorted(tok[order], np.arange(tokens + 1)), len(held)

    holder, begin, left = index()
    count = int(waiting.sum())
    by_group = np.argsort(group, kind="stable")
    bound = np.searchsorted(group[by_group], np.arange(int(group.max()) + 2))

    def of(g):
        return by_group[bound[g]:bound[g + 1]]

    while count:
        first = int(np.argmax(waiting))
        stack = list(of(group[first]))
        waiting[stack] = False
        count -= len(stack)
        while stack and count:
            if count * 2 < left:
                holder, begin, left = index()
            i = int(stack.pop())
            own = flat[at[i]:at[i + 1]]
            seen = np.concatenate([holder[begin[t]:begin[t + 1]] for t in own])
            seen = seen[waiting[seen]]
            if not len(seen):
                continue
            near, both = np.unique(seen, return_counts=True)
            for j in near[den * both >= num * (size[i] + size[near] - both)]:
                if waiting[j]:
                    out.append((i, int(j)))
                    fresh = of(group[j])
                    waiting[fresh] = False
                    count -= len(fresh)
                    stack += list(fresh)
    return out


def _solve(batches: Iterable[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows (task, fp, group, shingles) sorted by task -> links (a, b)."""
    task, held = None, {}

    def flush():
        fps = list(held)
        pairs = links_between([held[f][1] for f in fps], [held[f][0] for f in fps], num, den)
        return pa.RecordBatch.from_arrays([pa.array([fps[i] for i, _ in pairs], pa.int64()),
                                           pa.array([fps[j] for _, j in pairs], pa.int64())], ["a", "b"])

    for b in batches:
        for t, fp, g, s in zip(*(b.column(i).to_pylist() for i in range(3)), _sets(b.column(3)), strict=True):
            if t != task:
                if len(held) > 1:
                    yield flush()
                task, held = t, {}
            held[fp] = (g, s)
    if len(held) > 1:
        yield flush()


# ---- the operator -----------------------------------------------------------------------------
def _classes(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame, int]:
    """(rows, classes, seed): :func:`_set_rows` written once, and a row per fingerprint."""
    seed = 0
    while True:
        rows = cut_lineage(docs.mapInArrow(lambda it, s=seed: _set_rows(it, k, s),
                                           "id long, n long, fp long, check long, keys array<long>"))
        classes = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("low"), F.min("n").cast("int").alias("n"),
                                                     (F.min("check") != F.max("check")).alias("clash")))
        if classes.where("clash").isEmpty():
            return rows, classes, seed
        seed += 1


def buckets(rows: DataFrame) -> DataFrame:
    """(key, fp, low): the classes of every table key that two of them have, and the smallest of these."""
    half = rows.where(F.size("keys") > 0).select("fp", F.posexplode("keys").alias("pos", "half"))
    shared = half.groupBy("half").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x < y").select("half")
    side = [F.collect_set(F.when((F.col("pos") < SIDE) == first, F.col("half"))) for first in (True, False)]  # SIDE at most
    live = cut_lineage(half.join(shared, "half", "left_semi").groupBy("fp").agg(side[0].alias("first"), side[1].alias("second")))
    keys = (live.select("fp", F.explode("first").alias("x"), "second").select("fp", "x", F.explode("second").alias("y"))
            .select("fp", F.xxhash64("x", "y").alias("key")))
    met = keys.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high").select("key", "low")
    return cut_lineage(keys.join(met, "key").select("key", "fp", "low"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80,
                    den: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``docs``."""
    spark = docs.sparkSession
    rows, classes, seed = _classes(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), k)
    met = buckets(rows)
    hubs = cut_lineage(met.groupBy("fp").agg(F.min("low").alias("hub")))
    bits = _bloom(hubs.select("fp"))
    sets = cut_lineage(docs.select(F.col(text_col).alias("text"))
                       .mapInArrow(lambda it: _member_sets(it, k, seed, bits), "fp long, n int, shingles binary")
                       .dropDuplicates(["fp"]))
    mine = sets.select("fp", F.col("shingles").alias("x"))
    theirs = sets.select(F.col("fp").alias("hub"), F.col("shingles").alias("y"))
    links = cut_lineage(hubs.where("fp != hub").join(mine, "fp").join(theirs, "hub").select("fp", "hub", "x", "y")
                        .mapInArrow(lambda it: linked_rows(it, num, den), "a long, b long"))

    # buckets whose classes are not of one component yet
    comp = components(links).withColumnsRenamed({"id": "fp"})
    seen = met.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    open_ = (seen.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key"))
    unfinished = cut_lineage(seen.join(open_, "key").select("fp", "low", "component"))
    cluster = components(unfinished.select(F.col("fp").alias("a"), F.col("low").alias("b"))).withColumnsRenamed({"id": "fp"})
    member = cut_lineage(cluster.join(classes.select("fp", "n"), "fp").select("fp", "component", "n"))
    group = unfinished.select("fp", F.col("component").alias("grp")).distinct()
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = _block_pairs(member, num, den, block_bytes).join(group, "fp").join(sets, "fp").select("task", "fp", "grp", "shingles")
    more = cut_lineage(work.repartition(n_parts, "task").sortWithinPartitions("task")
                       .mapInArrow(lambda it: _solve(it, num, den), "a long, b long"))

    comp = components(links.unionAll(more)).withColumnsRenamed({"id": "fp"})
    label = classes.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    best = label.groupBy("component").agg(F.min("low").alias("component_id"))
    label = label.join(best, "component").select("fp", "component_id")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (rows.select("id", "n", "fp").join(label, "fp")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                    F.col("id").eqNullSafe(own).alias("kept")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` table, 2-word shingles, 80 in 100."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)

"""Operator 6 - n-gram Jaccard join with set-relation skipping.

Documents are sets of distinct k-word shingles (64-bit hashes of lower-cased
words).  Two documents link when ``den * |A n B| >= num * |A u B|``.

Plan
  1. One pass over the texts writes (doc, set size, set fingerprint); documents
     with equal sets form one class, and only classes are compared.
  2. A count array of fixed size over all shingles gives one total order (count, hash).  Any
     order is exact for prefix filtering; counts only keep frequent shingles
     out of the prefixes.
  3. Each class enters the index under the first ``|A| - ceil(t|A|) + 1``
     shingles of the order.  Linked sets share such a shingle, so classes that
     share none are never compared.  Classes that share one and whose sizes allow
     the threshold form clusters.
  4. A cluster is cut into blocks of bounded bytes by size band; two blocks meet
     only if their sizes allow the threshold.  A task holds one block pair and
     finds every link in it (:func:`links_in`) by
     * index skipping: the postings of a shingle are ordered by set size, and
       only the run of positions that the size bound allows is read;
     * answer skipping: the overlaps of a set are derived from those of a
       similar set already answered, reading only postings of shingles
       in which the two differ.
     Tasks emit one edge per linked set, never all pairs of a group.  A first
     run over the index parts (a tenth of the sets) splits the clusters by a safe
     bound.  Then the whole sets of each cluster meet its hubs: the smallest class first, and in
     ``HUBS - 1`` further rounds what no hub has linked yet meets a random class of the group
     linked so far that was no hub.  A cluster that the hubs join is finished after one pair per class and round; of any
     other, a last run over whole sets decides, without the hubs, which have met all that is left, and without
     the blocks of its linked group among themselves.
  5. Components of the links; each class takes its component's smallest doc_id.

Defined results: null or blank texts have the empty set, link with nothing and
form their own component; fewer than k words make one shingle of the whole
sequence; repeated rows are copies; a null doc_id never becomes a component id
unless all ids of the component are null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X
from .common import components, cut_lineage, merge_slices, signed, slice_rows, table

COUNTERS = 1 << 22
BLOOM_BITS = 1 << 24
BLOCK_BYTES = 16 << 20
#: bytes of text worked on at once: a set does not depend on what else is in its chunk
CHUNK = 1 << 19
HUBS = 4


def slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 22)).astype(np.int64)


def fingerprint(s: np.ndarray) -> int:
    """Signed 64-bit digest of a sorted set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int, num: int, den: int) -> int:
    """Shingles of the order that a set of ``n`` must be indexed under: an
    overlap of at least ceil(n * num / den) leaves out fewer than this."""
    return n - -(-n * num // den) + 1


def index_part(s: np.ndarray, counts, num: int, den: int) -> np.ndarray:
    """The first shingles of a set in the total order (count, hash)."""
    order = np.argsort(counts.value[slots(s)], kind="stable")
    return s[order[:prefix_length(len(s), num, den)]]


# ---- passes over the texts ----------------------------------------------------------
def _set_rows(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Per document (id, n, fp), and the partition's shingle counts as slices."""
    counts = np.zeros(COUNTERS, np.uint32)

    def docs(ids, n, fp):
        m = len(n)
        return pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.int64()),
             pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], ["id", "n", "fp", "slice", "counts"])

    for b in batches:
        n, fp = [], []
        for c in X.chunks(b.column(1), CHUNK):
            sets = list(X.shingles(X.words(c), k))
            n += [len(s) for s in sets]
            fp += [fingerprint(s) for s in sets]
            at, times = np.unique(slots(np.concatenate([*sets, np.zeros(0, np.uint64)])), return_counts=True)
            counts[at] += times.astype(np.uint32)
        yield docs(b.column(0), n, fp)
    s = slice_rows(counts)
    m = s.num_rows
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), s.column(0), s.column(1)],
        ["id", "n", "fp", "slice", "counts"])


def _prefix_rows(batches: Iterable[pa.RecordBatch], k: int, counts, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """(token, fp, n) for each shingle a set is indexed under, each set once
    per partition."""
    done: set[int] = set()
    for b in batches:
        toks, fps, ns = [], [], []
        for c in X.chunks(b.column(0), CHUNK):
            for s in X.shingles(X.words(c), k):
                n = len(s)
                fp = fingerprint(s)
                if not n or fp in done:
                    continue
                done.add(fp)
                toks.append(index_part(s, counts, num, den))
                fps.append(np.full(len(toks[-1]), fp, np.int64))
                ns.append(np.full(len(toks[-1]), n, np.int32))
        if toks:
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate(toks))), pa.array(np.concatenate(fps)), pa.array(np.concatenate(ns))],
                ["token", "fp", "n"])


def _bloom_slots(fp: np.ndarray) -> np.ndarray:
    return (X.mix(fp.view(np.uint64)) & np.uint64(BLOOM_BITS - 1)).astype(np.int64)


def _bloom_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(BLOOM_BITS, bool)
    for b in batches:
        seen[_bloom_slots(b.column(0).to_numpy(zero_copy_only=False))] = True
    yield slice_rows(np.packbits(seen))


def _maybe(batches: Iterable[pa.RecordBatch], bits) -> Iterator[pa.RecordBatch]:
    """The rows whose first column may be in the Bloom filter."""
    for b in batches:
        at = _bloom_slots(b.column(0).to_numpy(zero_copy_only=False))
        yield b.filter(pa.array((bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0))


def _bloom(df: DataFrame):
    """Broadcast Bloom filter (fixed size) of a one-column table of longs."""
    return df.sparkSession.sparkContext.broadcast(
        merge_slices(df.mapInArrow(_bloom_rows, "slice int, counts binary"), BLOOM_BITS // 8, np.uint8, "or"))


def _member_sets(batches: Iterable[pa.RecordBatch], k: int, bits, part=None) -> Iterator[pa.RecordBatch]:
    """(fp, n, set) of the documents whose fingerprint may be in a cluster, each
    set once per partition; ``part`` picks the shingles to send."""
    done: set[int] = set()
    for b in batches:
        fps, ns, sets = [], [], []
        for c in X.chunks(b.column(0), CHUNK):
            for s in X.shingles(X.words(c), k):
                if not len(s):
                    continue
                fp = fingerprint(s)
                at = int(_bloom_slots(np.array([fp], np.int64))[0])
                if fp not in done and bits.value[at >> 3] >> (7 - (at & 7)) & 1:
                    done.add(fp)
                    fps.append(fp)
                    ns.append(len(s))
                    sets.append((s if part is None else part(s)).tobytes())
        if fps:
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(ns, pa.int32()), pa.array(sets, pa.binary())],
                                             ["fp", "n", "shingles"])


# ---- inside one task ------------------------------------------------------------------
def links_in(sets: list[np.ndarray], sizes: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning set of links among ``sets``: the returned pairs are all links
    of the answer graph that first join two components.  Every pair that the
    size bound allows is decided from its exact overlap.

    Given index parts in place of whole sets (``sizes`` counts whole sets), a pair stays
    if its sets may link: of the set whose part ends first in the order, at
    most ``|A| - overlap needed`` shingles are missing from the other's part."""
    order = sorted(range(len(sets)), key=lambda i: sizes[i])
    sets = [sets[i] for i in order]
    m = len(sets)
    size = np.array(sizes, np.int64)[order]
    held = np.array([len(s) for s in sets])
    unseen = size - held
    token, flat = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(held)])
    own = [flat[at[i]:at[i + 1]] for i in range(m)]
    by_token = np.argsort(flat, kind="stable")  # postings in order of set size
    holder = np.repeat(np.arange(m), held)[by_token]
    begin = np.searchsorted(flat[by_token], np.arange(len(token) + 1))
    # positions that the size bound allows, and a wider run that relatives share
    low = np.searchsorted(size, -(-size * num // den), "left")
    high = np.searchsorted(size, size * den // num, "right")
    wide_low = np.searchsorted(size, size * num * num // (den * den), "left")
    wide_high = np.searchsorted(size, -(-size * den * den // (num * num)), "right")
    parent = list(range(m))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def overlaps(tokens, a, b):
        """Number of ``tokens`` in each set of positions a .. b-1, reading only
        that run of each posting list."""
        if not len(tokens):
            return np.zeros(b - a, np.int64)
        parts = []
        for t in tokens:
            p = holder[begin[t]:begin[t + 1]]
            if len(p) > 1:
                x, y = np.searchsorted(p, (a, b))
                parts.append(p[x:y])
            else:
                parts.append(p)
        p = np.concatenate(parts)
        p = p[(p >= a) & (p < b)]
        return np.bincount(p - a, minlength=b - a)

    out, answered, seen = [], {}, np.zeros(m, bool)
    for first in range(m):
        if seen[first]:
            continue
        stack = [(first, None)]
        while stack:
            i, relative = stack.pop()
            if seen[i]:
                continue
            seen[i] = True
            a, b = wide_low[i], wide_high[i]
            known = answered.get(relative)
            if known and known[0] <= low[i] and known[1] >= high[i]:
                a, b = known[0], known[1]
                mine, theirs = own[i], own[relative]
                count = (known[2] + overlaps(np.setdiff1d(mine, theirs, assume_unique=True), a, b)
                         - overlaps(np.setdiff1d(theirs, mine, assume_unique=True), a, b))
            else:
                count = overlaps(own[i], a, b)
            near = np.arange(low[i], high[i])
            c = count[low[i] - a:high[i] - a]
            linked = near[(num + den) * (c + np.maximum(unseen[near], unseen[i])) >= num * (size[near] + size[i])]
            for j in linked[linked != i]:
                x, y = root(i), root(int(j))
                if x != y:
                    parent[x] = y
                    out.append((order[i], order[int(j)]))
            next_ones = [int(j) for j in linked if not seen[j]]
            if next_ones:
                answered[i] = (a, b, count)
                stack += [(j, i) for j in next_ones]
        answered.clear()
    return out


def _solve(batches: Iterable[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows (task, fp, n, shingles) sorted by task -> edges (a, b) from
    every linked set to the smallest fingerprint of its component in the task."""
    task, fps, ns, sets, here = None, [], [], [], set()

    def flush():
        parent = list(range(len(fps)))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i, j in links_in(sets, ns, num, den):
            x, y = sorted((root(i), root(j)), key=fps.__getitem__)
            parent[y] = x
        star = [(f, fps[root(i)]) for i, f in enumerate(fps) if root(i) != i]
        return pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in star], pa.int64()), pa.array([r for _, r in star], pa.int64())], ["a", "b"])

    for batch in batches:
        for t, fp, n, s in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
            if t != task:
                if len(sets) > 1:
                    yield flush()
                task, fps, ns, sets, here = t, [], [], [], set()
            if fp not in here:
                here.add(fp)
                fps.append(fp)
                ns.append(n)
                sets.append(np.frombuffer(s.as_buffer(), np.uint64))
    if len(sets) > 1:
        yield flush()


def linked_rows(batches: Iterable[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, set of a, set of b) -> the linked (a, b)."""
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(den * both >= num * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))


# ---- the operator ----------------------------------------------------------------------
def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, num: int = 90,
                       den: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    text = docs.select(F.col(text_col).alias("text"))
    passed = cut_lineage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: _set_rows(it, k), "id long, n long, fp long, slice int, counts binary"))
    rows = passed.where("fp IS NOT NULL").select("id", "n", "fp")
    counts = sc.broadcast(merge_slices(passed.where("slice IS NOT NULL").select("slice", "counts"), COUNTERS))

    entries = cut_lineage(text.mapInArrow(lambda it: _prefix_rows(it, k, counts, num, den), "token long, fp long, n int"))
    shared = cut_lineage(entries.groupBy("token").agg(F.min("fp").alias("x"), F.max("fp").alias("y"))
                         .where("x != y").select("token"))
    bits = _bloom(shared)
    live = cut_lineage(entries.mapInArrow(lambda it: _maybe(it, bits), entries.schema).join(shared, "token"))
    sizes = rows.groupBy("fp").agg(F.first("n").alias("n"))
    clusters = components(_meetings(live, num, den))
    # the index parts alone tell most clusters apart; whole sets are sent only for what remains
    maybe = _solved(text, clusters, sizes, k, num, den, block_bytes, lambda s: index_part(s, counts, num, den))
    possible = cut_lineage(components(maybe))
    bits_held = _bloom(possible.select("id"))
    held = cut_lineage(text.mapInArrow(lambda it: _member_sets(it, k, bits_held), "fp long, n int, shingles binary").dropDuplicates(["fp"])
                       .join(possible.withColumnsRenamed({"id": "fp"}), "fp"))
    links, rest = _meet_hubs(held, num, den)
    links = links.unionAll(_decided(_among(held, _bloom(rest.select("fp"))), rest, num, den, block_bytes))
    comp = components(links).withColumnsRenamed({"id": "fp"})

    low = rows.groupBy("fp").agg(F.min("id").alias("low"))
    label = low.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    best = label.groupBy("component").agg(F.min("low").alias("component_id"))
    label = label.join(best, "component").select("fp", "component_id")
    return (rows.join(label, "fp", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def _among(held: DataFrame, bits) -> DataFrame:
    """The rows of ``held`` whose class may be in the Bloom filter: what no later join needs is not shuffled."""
    return held.mapInArrow(lambda it: _maybe(it, bits), held.schema)


def _meet_hubs(held: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(links (a, b), unfinished classes (fp, component, n, main)) of the clusters' sets ``held`` (fp, n, shingles,
    component): ``main`` marks the classes of a cluster that links join to its smallest class.  A hub has met every
    class that is not ``main``, so no hub is unfinished; a cluster whose linked group has no class but
    hubs has nothing new to meet."""
    same = F.col("fp") == F.col("component")
    state = held.select("fp", "component", "n", same.alias("main"), same.alias("hub"))
    first = held.where(same).select("component", F.col("fp").alias("b"), F.col("shingles").alias("y"))
    pairs = held.where(~same).join(first, "component").select(F.col("fp").alias("a"), "b", F.col("shingles").alias("x"), "y")
    links = None
    for r in range(HUBS):
        if r:
            hub = cut_lineage(state.where("main AND NOT hub").groupBy("component").agg(F.max_by("fp", F.xxhash64("fp", F.lit(r))).alias("b"))
                              .join(state.where("NOT main").select("component").distinct(), "component", "left_semi"))
            ids = state.where("NOT main").join(hub, "component").select(F.col("fp").alias("a"), "b")
            mine = _among(held, _bloom(ids.select("a"))).select(F.col("fp").alias("a"), F.col("shingles").alias("x"))
            theirs = _among(held, _bloom(hub.select("b"))).select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
            pairs = ids.join(mine, "a").join(theirs, "b").select("a", "b", "x", "y")
            state = state.join(hub, "component", "left").withColumn("hub", F.col("hub") | F.coalesce(F.col("fp") == F.col("b"), F.lit(False))).drop("b")
        met = cut_lineage(pairs.mapInArrow(lambda it: linked_rows(it, num, den), "a long, b long"))
        links = met if links is None else links.unionAll(met)
        won = met.select(F.col("a").alias("fp"), F.lit(True).alias("won"))
        state = cut_lineage(state.join(won, "fp", "left").select("fp", "component", "n", (F.col("main") | F.col("won").isNotNull()).alias("main"), "hub"))
    left = state.where("NOT hub").drop("hub")
    unfinished = left.groupBy("component").agg(F.count("*").alias("classes"), F.count_if(~F.col("main")).alias("open")).where("classes > 1 AND open > 0")
    return links, cut_lineage(left.join(unfinished, "component", "left_semi"))


def _solved(text: DataFrame, clusters: DataFrame, sizes: DataFrame, k: int, num: int, den: int, block_bytes: int,
            part=None) -> DataFrame:
    """Links (a, b) inside the clusters (id, component)."""
    member = clusters.join(sizes, F.col("id") == F.col("fp")).select("fp", "component", "n")
    if part is not None:  # an index part is what a block is filled with
        member = member.withColumn("bytes", ((F.col("n") * (den - num) / den).cast("long") + 1) * 8)
    member = cut_lineage(member)
    bits = _bloom(member.select("fp"))
    sets = text.mapInArrow(lambda it: _member_sets(it, k, bits, part), "fp long, n int, shingles binary")
    return _decided(sets, member, num, den, block_bytes)


def _decided(sets: DataFrame, member: DataFrame, num: int, den: int, block_bytes: int) -> DataFrame:
    """Links (a, b) among the classes (fp, component, n) of each cluster."""
    n_parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(sets.join(_block_pairs(member, num, den, block_bytes), "fp").select("task", "fp", "n", "shingles")
                       .repartition(n_parts, "task").sortWithinPartitions("task")
                       .mapInArrow(lambda it: _solve(it, num, den), "a long, b long"))


def _band(n, num: int, den: int):
    """Size band: linked sizes lie in the same or in neighbouring bands."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(den / num)) + F.lit(1e-9)).cast("long")


def _meetings(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) that connect all classes which share an index shingle and
    whose sizes allow the threshold: a star per shingle and band, and an edge between
    neighbouring bands.  Rows are linear in the entries."""
    e = entries.withColumn("band", _band(F.col("n"), num, den))
    star = e.groupBy("token", "band").agg(F.min("fp").alias("rep"), F.min("n").alias("low"), F.max("n").alias("high"))
    inside = e.join(star, ["token", "band"]).select(F.col("fp").alias("a"), F.col("rep").alias("b"))
    above = star.select("token", (F.col("band") - 1).alias("band"), F.col("rep").alias("b"), F.col("low").alias("low_above"))
    across = (star.join(above, ["token", "band"]).where(F.col("high") * den >= F.col("low_above") * num)
              .select(F.col("rep").alias("a"), "b"))
    return inside.unionAll(across).where("a != b").distinct()


def _block_pairs(member: DataFrame, num: int, den: int, block_bytes: int) -> DataFrame:
    """(fp, task): every block pair a class belongs to.

    A cluster whose sets fit ``block_bytes`` is one block.  A larger one is split into
    size bands and salted blocks inside a band; linked sets lie in the same or
    in neighbouring bands, other block pairs are skipped, and so are pairs of blocks that hold classes
    already joined (``main``)."""
    main = F.col("main") if "main" in member.columns else F.lit(False)
    held = F.col("bytes") if "bytes" in member.columns else F.col("n") * 8
    weight = member.select("component", "fp", held.alias("bytes"), _band(F.col("n"), num, den).alias("band"), main.alias("main"))
    total = weight.groupBy("component").agg(F.sum("bytes").alias("total")).where(F.col("total") > block_bytes)
    large = weight.join(total.select("component"), "component")
    salts = large.groupBy("component", "band", "main").agg(F.ceil(F.sum("bytes") / block_bytes).cast("long").alias("salts"))
    block = large.join(salts, ["component", "band", "main"]).select(
        "component", "fp", "band", "main", F.pmod(F.xxhash64("fp"), F.col("salts")).alias("salt"))
    partner = salts.select("component", F.col("band").alias("band2"), F.col("main").alias("main2"), F.col("salts").alias("salts2"))
    met = (block.join(partner, "component").where("abs(band - band2) <= 1 AND NOT (main AND main2)")
           .withColumn("salt2", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts2") - 1))))
    mine = F.struct("band", "main", "salt")
    other = F.struct(F.col("band2").alias("band"), F.col("main2").alias("main"), F.col("salt2").alias("salt"))
    met = met.select("fp", F.xxhash64("component", F.least(mine, other), F.greatest(mine, other)).alias("task"))
    small = weight.join(total.select("component"), "component", "left_anti").select(
        "fp", F.xxhash64("component").alias("task"))
    return small.unionAll(met)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` table, 3-word shingles, 90 in 100."""
    return jaccard_components(table(spark, sf_dir, "documents"))

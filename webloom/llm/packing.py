"""Operator 9 - best-fit packing by hierarchical residual packing.

1. Every partition tokenises its documents (end id appended), cuts those
   longer than a sequence into full pieces (the first piece takes the rest), and packs
   the pieces of each block of bounded size best-fit, longest first.  Bins that are
   full up to ``SLACK`` tokens are final, the others are residual.
2. Residual bins are items of their fill.  They are dealt to groups of
   bounded size and packed best-fit again; rounds repeat with the fewer
   bins that remain, up a tree, until a round merges less than 1 % of them.
3. A piece's place is its place in its first bin plus that bin's place in
   the final sequence.  Only pieces of residual bins are joined with the rounds'
   result; pieces of final bins keep theirs, so token ids are not shuffled for them.

Rows: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

Defined results: null or empty text is the end id alone; repeated rows are
packed each; a null doc_id is carried through; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, table
from .tokenize import CACHE_ENTRIES, encoder, vocabulary

LENGTH = 2048
SLACK = 8
END_ID = 0
BLOCK_IDS = 8 << 20      # token ids that one block of a partition holds
GROUP_BINS = 1 << 16     # residual bins that one group of a round holds
_PIECE = ("doc_id long, piece int, start long, length long, ids binary, bin long, place long, residual boolean, fill long")


def best_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit-decreasing: (bin, place in the bin) of each item, fill of each bin.

    Open bins are kept by their remaining room; a bit mask of the rooms in use
    gives the tightest one that still takes an item."""
    bin_of, place = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    mask = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        fits = mask >> n
        if fits:
            left = (fits & -fits).bit_length() - 1 + n
            b = by_room[left].pop()
            if not by_room[left]:
                mask &= ~(1 << left)
        else:
            left, b = room, len(fill)
            fill.append(0)
        bin_of[i], place[i] = b, fill[b]
        fill[b] += n
        left -= n
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    return bin_of, place, np.array(fill, np.int64)


def _pack_rows(batches: Iterable[pa.RecordBatch], vocab: str, length: int, entries: int) -> Iterator[pa.RecordBatch]:
    """Tokenise, cut and pack one partition block by block."""
    enc = encoder(vocab, True, END_ID, entries)
    next_bin = TaskContext.get().partitionId() << 33
    names = [c.split()[0] for c in _PIECE.split(", ")]
    held: list[tuple] = []  # (doc_id, piece, start, ids)
    tokens = 0

    def flush():
        nonlocal next_bin, tokens
        n = np.array([len(h[3]) // 4 for h in held], np.int64)
        b, place, fill = best_fit(n, length)
        residual = fill < length - SLACK
        for a in range(0, len(held), 2048):
            part, s = held[a:a + 2048], slice(a, a + 2048)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in part], pa.int64()), pa.array([h[1] for h in part], pa.int32()),
                 pa.array([h[2] for h in part], pa.int64()), pa.array(n[s]), pa.array([h[3] for h in part], pa.binary()),
                 pa.array(b[s] + next_bin), pa.array(place[s]), pa.array(residual[b[s]]), pa.array(fill[b[s]])], names)
        next_bin += len(fill)
        held.clear()
        tokens = 0

    for batch in batches:
        for i, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist()), strict=True):
            n = len(ids) // 4
            first = (n - 1) % length + 1
            cuts = [0, *range(first, n + 1, length)]
            for p, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                held.append((i, p, a, ids[4 * a:4 * z]))
            tokens += n
            if tokens >= BLOCK_IDS:
                yield from flush()
    if held:
        yield from flush()


def _merge_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (group, bin, fill) sorted by group -> (bin, into, place, total)."""
    group, bins, fills = None, [], []

    def flush():
        b, place, fill = best_fit(np.array(fills, np.int64), length)
        ids = np.array(bins, np.int64)
        name = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(name, b, ids)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(name[b]), pa.array(place), pa.array(fill[b])],
                                          ["bin", "into", "place", "total"])

    for batch in batches:
        for g, i, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if g != group and bins:
                yield flush()
                bins, fills = [], []
            group = g
            bins.append(i)
            fills.append(f)
    if bins:
        yield flush()


def pack(docs: DataFrame, vocab: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
         entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row per piece with its ids and its place; see the module text.  ``entries`` bounds the pieces of text that a
    worker keeps with their ids, whatever the result."""
    pieces = cut_lineage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                         .mapInArrow(lambda it: _pack_rows(it, vocab, length, entries), _PIECE))
    residual = pieces.where("residual AND place = 0").select("bin", "fill")
    # at: where each first bin stands now; bins: the residual bins of the round
    at = cut_lineage(residual.select("bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("place")))
    bins, left = residual, at.count()
    salt = 0
    while left > 1:
        groups = -(-left // GROUP_BINS)
        salt += 1
        dealt = bins.select(F.pmod(F.xxhash64("bin", F.lit(salt)), F.lit(groups)).alias("group"), "bin", "fill")
        merged = cut_lineage(dealt.repartition(groups, "group").sortWithinPartitions("group", "bin")
                             .mapInArrow(lambda it: _merge_rows(it, length), "bin long, into long, place long, total long"))
        step = merged.select(F.col("bin").alias("was"), F.col("into").alias("now"), F.col("place").alias("shift"))
        at = cut_lineage(at.join(step, F.col("into") == F.col("was"), "left").select(
            "bin", F.coalesce("now", "into").alias("into"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place")))
        bins = merged.where(f"into = bin AND total < {length - SLACK}").select("bin", F.col("total").alias("fill"))
        now = bins.count()
        if groups == 1 or now > 0.99 * left:
            break
        left = now
    done = pieces.where("NOT residual").select("doc_id", "piece", "start", "length", "ids", F.col("bin").alias("sequence_id"),
                                               F.col("place").alias("offset"))
    moved = (pieces.where("residual").join(at.select("bin", "into", F.col("place").alias("base")), "bin")
             .select("doc_id", "piece", "start", "length", "ids", F.col("into").alias("sequence_id"),
                     (F.col("place") + F.col("base")).alias("offset")))
    return done.unionAll(moved)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` in sequences of at most 2048 tokens."""
    packed = pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")

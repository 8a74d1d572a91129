"""Shared pieces of the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage, read_table  # noqa: F401

#: rows and bytes per Arrow batch handed to Python: whole texts come in
#: batches, so a batch is kept small against an executor's memory
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), sf_dir, name)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as the signed longs that Spark holds."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def hash_share(key: str, sample: int, total: int) -> Column:
    """True for about ``sample`` of ``total`` rows, chosen by a 64-bit hash of ``key`` whatever
    the table's size: the hash's whole range is cut, so no share is ever rounded to nothing."""
    if total <= sample:
        return F.lit(True)
    return F.xxhash64(key) < F.lit(max((sample << 64) // total, 1) - (1 << 63))


SLICES = 64


def slice_rows(counts: np.ndarray) -> pa.RecordBatch:
    """A count array as ``SLICES`` compressed rows (slice, counts)."""
    parts = np.split(counts, SLICES)
    keep = [i for i, p in enumerate(parts) if p.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array(keep, pa.int32()), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in keep], pa.binary())],
        ["slice", "counts"])


def merge_slices(rows: DataFrame, size: int, dtype=np.uint32, how: str = "sum") -> np.ndarray:
    """Add up (or OR) the partitions' count arrays slice by slice on the
    executors; the driver receives one array of ``size`` entries, whatever the
    input's size, in one job: read partition by partition, each would be a job of its own."""
    step = size // SLICES

    def add(batches: Iterable[pa.RecordBatch]):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                a = np.frombuffer(zlib.decompress(z), dtype)
                if i not in total:
                    total[i] = a.copy()
                elif how == "sum":
                    total[i] += a
                else:
                    total[i] |= a
        for i, a in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([zlib.compress(a.tobytes(), 1)], pa.binary())],
                ["slice", "counts"])

    out = np.zeros(size, dtype)
    merged = rows.repartition(min(SLICES, 16), "slice").mapInArrow(add, "slice int, counts binary")
    for r in merged.collect():
        out[r["slice"] * step:(r["slice"] + 1) * step] = np.frombuffer(zlib.decompress(r["counts"]), dtype)
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a long, b long)``: (id, component) for every id in
    an edge; component is the smallest id of the component.

    Each round links the smaller neighbours of a node to the smallest of them
    (a node's smaller neighbours are few, so no group is large) and then lets every
    edge point past its end to that end's own smallest neighbour, which halves the
    paths.  A round is written to the shared folder; the loop ends when it changes no
    edge, of which the driver sees a checksum only.
    """
    def signature(df):
        r = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return r["n"], r["x"]

    cur = cut_lineage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = signature(cur)
    while before[0]:
        low = F.min("b").over(Window.partitionBy("a"))
        # one edge for each: the node itself, and each of its other smaller neighbours, to the smallest
        linked = (cur.select("a", "b", low.alias("m"))
                  .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
                  .distinct())
        own = linked.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        cur = cut_lineage(linked.join(own, F.col("b") == F.col("node"), "left")
                          .select("a", F.coalesce("low", "b").alias("b")).distinct())
        now = signature(cur)
        if now == before:
            break
        before = now
    member = cur.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return member.unionAll(member.select(F.col("component").alias("id"), "component").distinct())

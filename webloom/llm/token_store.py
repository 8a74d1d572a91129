"""Operator 2 - token ids in binary segments with Elias-Fano document bounds.

Documents are range-partitioned by id and tokenised in order; every partition writes
segments of at most ``SEGMENT_IDS`` ids (a longer document is a segment of
its own).  File format, one Parquet row per segment (Spark's writer reaches
any store that the cluster reads):

  shard, segment   order of the segments
  base             ids of the shard before the segment
  n_ids, width     number of ids and bytes per id (2 if all ids fit, else 4)
  doc_ids          the documents, in order
  bounds           Elias-Fano code of the documents' ends in the segment
  ids              the concatenated little-endian ids

No 64-bit offset table exists: an offset is ``shard start + base +
select(i)``, and the shard starts come from the shards' totals.

Defined results: null text is empty (one end id); null doc_ids come first; rows of equal
doc_id stand side by side in some fixed order; an empty table gives no segments;
extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import table
from .tokenize import encoder, vocabulary

SEGMENT_IDS = 1 << 20
END_ID = 2
SEGMENT = "shard int, segment int, base long, n_ids long, width int, doc_ids array<long>, bounds binary, ids binary"
_NAMES = [c.split()[0] for c in SEGMENT.split(", ")]


class EliasFano:
    """A non-decreasing sequence of n values up to ``top``: the low bits of
    each value verbatim, the high bits as unary gaps; about
    ``2 + log2(top / n)`` bits a value."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        pad = np.zeros(-len(high) % 8, np.uint8)
        self._words = np.concatenate([high, pad]).view("<u8")
        self._rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self._words))]).astype(np.uint32)

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.int64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = ((v[:, None] >> np.arange(bits)) & 1).astype(np.uint8).ravel()
        high = np.zeros((top >> bits) + n + 1, np.uint8)
        high[(v >> bits) + np.arange(n)] = 1
        return EliasFano(n, bits, np.packbits(low, bitorder="little"), np.packbits(high, bitorder="little"))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u4")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> EliasFano:
        n, bits, a, b = (int(x) for x in np.frombuffer(raw, "<u4", 4))
        return EliasFano(n, bits, np.frombuffer(raw, np.uint8, a, 16), np.frombuffer(raw, np.uint8, b, 16 + a))

    def select(self, i: np.ndarray) -> np.ndarray:
        """Values at the positions ``i``: the i-th one of the high part, found by a
        32-bit rank per 64-bit word, and the low bits beside it."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return i
        word = np.searchsorted(self._rank, i, "right") - 1
        bit = np.unpackbits(self._words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inside = np.argmax(np.cumsum(bit, axis=1, dtype=np.int16) == (i - self._rank[word] + 1)[:, None], axis=1)
        value = (word * 64 + inside - i) << self.low_bits
        if self.low_bits:
            at = i[:, None] * self.low_bits + np.arange(self.low_bits)
            value |= (((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << np.arange(self.low_bits)).sum(1)
        return value


def _segments(batches: Iterable[pa.RecordBatch], path: str, spaces: bool, end: int, limit: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, spaces, end)
    shard, segment, base = TaskContext.get().partitionId(), 0, 0
    doc_ids: list = []
    coded: list[bytes] = []
    held = 0

    def flush():
        nonlocal segment, base, held
        ids = np.frombuffer(b"".join(coded), "<u4")
        width = 2 if len(ids) == 0 or ids.max() < 1 << 16 else 4
        bounds = EliasFano.of(np.cumsum([len(c) // 4 for c in coded]))
        row = [shard, segment, base, len(ids), width, list(doc_ids), bounds.to_bytes(), ids.astype(f"<u{width}").tobytes()]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        segment, base, held = segment + 1, base + len(ids), 0
        doc_ids.clear()
        coded.clear()
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], _NAMES)

    for b in batches:
        for i, c in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
            n = len(c) // 4
            if coded and held + n > limit:
                yield flush()
            doc_ids.append(i)
            coded.append(c)
            held += n
    if coded:
        yield flush()


def write(docs: DataFrame, folder: str, vocab: str, spaces: bool = False, end: int = END_ID, id_col: str = "doc_id",
          text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text and write the segments in ascending id order."""
    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
     .repartitionByRange("id").sortWithinPartitions("id")
     .mapInArrow(lambda it: _segments(it, vocab, spaces, end, segment_ids), SEGMENT)
     .write.mode("overwrite").option("compression", "zstd").parquet(folder))


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in range(b.num_rows):
            row = {n: b.column(i)[r] for i, n in enumerate(_NAMES)}
            width = row["width"].as_py()
            ids = np.frombuffer(row["ids"].as_buffer(), f"<u{width}").astype("<u4")
            ends = EliasFano.from_bytes(row["bounds"].as_py())
            ends = ends.select(np.arange(ends.n))
            begin = np.concatenate([[0], ends[:-1]])
            flat = memoryview(ids).cast("B")
            offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ends), row["shard"].as_py(), np.int32)), row["doc_ids"].values,
                 pa.array(begin + row["base"].as_py()), pa.array(ends - begin),
                 pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat)])
                 .cast(pa.binary())],
                ["shard", "doc_id", "start", "n_tokens", "ids"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document from the files; ``ids``
    are little-endian unsigned 32-bit, ``start`` counts the ids of all documents before."""
    stored = spark.read.schema(SEGMENT).parquet(folder)
    # one row per shard: the files' manifest, not the data
    starts = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    docs = stored.select(*_NAMES).mapInArrow(_documents, "shard int, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("start") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex}"
    write(docs, folder, vocabulary("word_bpe_49k.json"))
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))



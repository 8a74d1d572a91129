"""Operator 12 - embedding whitening from a bit-sliced scatter matrix.

Every vector entry c becomes the integer ``x = floor(64 * c) + 1000000``.  The fit list is each
distinct x vector once; means, covariances and components come from it alone.

1. The distinct vectors (one shuffle on the vector itself, combined before it) are written once.
2. A task cuts its vectors into blocks of ``BLOCK_ROWS``.  In a block each dimension is
   shifted to start at 0 and cut into bit planes; a plane's bits over the rows are
   packed into 64-bit words.  The cross-product of two dimensions is the sum over their
   planes of ``2^(a+b) * popcount(plane_a AND plane_b)``: whole numbers, no rounding.
   The shifts are put back in whole numbers, and a task sends one matrix, row by row.
3. The matrices are added up on the executors, a dimension's row in one task.  The driver
   holds one D x D matrix of Python integers, centres it as ``n * sum(xy) - sum(x) * sum(y)``, and
   only then divides and calls ``eigh``.
4. A pass over the fit list measures the whitened covariance (partial means and
   centred products, merged), a pass over all rows projects them.

Memory depends on the dimension and on ``BLOCK_ROWS`` alone; what reaches the driver are
D rows of D numbers.

Defined results.  Rows with a null vector or a null, infinite or NaN entry
are dropped; so are empty vectors, entries whose ``64 * c`` is beyond 2^62 (no long holds
them), and vectors whose length is not the
commonest one of the distinct vectors (ties: the longer).  A null vec_id
is kept; repeated rows are each returned but enter the fit list once; extra
columns are ignored.  A vector of D < 16 entries has D components.  ``whitened`` is null
and ``explained`` 0 for components without variance (an eigenvalue below 1e-12 of the largest), and
``identity_error`` covers the others (0 if there are none).  ``deviation`` is null where its
exact value is beyond a long; ``deviation_wide`` (decimal) holds it as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, table

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
BLOCK_ROWS = 1 << 15
LARGEST = 2.0 ** 62
NO_VARIANCE = 1e-12
MERGERS = 16
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double, deviation_wide decimal(38,0)")


# ---- rows -> integer vectors -----------------------------------------------------------
def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries x of all usable vectors, their offsets, usable flag per row)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths().fill_null(0), np.int64)
    flat = column.flatten().cast(pa.float64())
    c = flat.fill_null(np.nan).to_numpy(zero_copy_only=False) * SCALE
    row = np.repeat(np.arange(len(size)), size)
    bad = np.bincount(row[~(np.abs(c) <= LARGEST)], minlength=len(size)) > 0
    ok = (size > 0) & ~bad
    return np.floor(c[ok[row]]).astype(np.int64) + OFFSET, np.concatenate([[0], np.cumsum(size[ok])]), ok


def _whole_rows(batches: Iterable[pa.RecordBatch], keep_id: bool) -> Iterator[pa.RecordBatch]:
    """(id, x): usable rows, x as the bytes of its 64-bit entries."""
    for b in batches:
        x, off, ok = _vectors(b.column(1))
        # 32-bit offsets of a binary array: a batch is a few MB
        v = pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * 8).astype(np.int32)), pa.py_buffer(x)])
        ids = b.column(0).filter(pa.array(ok))
        yield pa.RecordBatch.from_arrays([ids, v] if keep_id else [v], ["id", "x"] if keep_id else ["x"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The binary column as rows of ``dim`` integers."""
    if not len(column):
        return np.zeros((0, dim), np.int64)
    column = column.cast(pa.binary())
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]]
    return np.frombuffer(data.tobytes(), np.int64).reshape(-1, dim)


# ---- the scatter -----------------------------------------------------------------------
def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact column sums and ``x.T @ x`` of a block, as Python integers, by AND and
    popcount over bit planes."""
    rows, dim = x.shape
    low = x.min(axis=0)
    u = x.astype(np.uint64) - low.astype(np.uint64)
    bits = max(1, int(u.max()).bit_length())
    padded = np.zeros((-(-rows // 64) * 64, dim), np.uint64)
    padded[:rows] = u
    planes = np.concatenate([
        np.ascontiguousarray(np.packbits(((padded >> np.uint64(p)) & np.uint64(1)).astype(bool).T, axis=1)).view(np.uint64)
        for p in range(bits)])
    # planes: (bit, dimension) x words
    total = np.zeros((dim, dim), object)
    for p in range(bits):
        for q in range(p, bits):
            part = np.empty((dim, dim), np.int64)
            other = planes[q * dim:(q + 1) * dim]
            for d in range(dim):
                part[d] = np.bitwise_count(planes[p * dim + d] & other).sum(axis=1, dtype=np.int64)
            part = part if p == q else part + part.T
            total += part.astype(object) << (p + q)
    shift = np.array([int(v) for v in low], object)
    sums = np.array([int(v) for v in np.bitwise_count(planes).sum(axis=1, dtype=np.int64)], object).reshape(bits, dim)
    s = sum((sums[p] << p for p in range(bits)), np.zeros(dim, object))
    return s + rows * shift, total + np.outer(s, shift) + np.outer(shift, s) + rows * np.outer(shift, shift)


def _scatter_rows(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """One row per dimension: (dimension, [n, its sum, its cross-products] as decimal text)."""
    count, sums, cross = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
    held: list[np.ndarray] = []

    def add():
        nonlocal count, sums, cross
        x = np.concatenate(held)
        held.clear()
        for a in range(0, len(x), BLOCK_ROWS):
            s, c = cross_products(x[a:a + BLOCK_ROWS])
            count, sums, cross = count + len(x[a:a + BLOCK_ROWS]), sums + s, cross + c

    for b in batches:
        if b.num_rows:
            held.append(_matrix(b.column(0), dim))
            if sum(map(len, held)) >= BLOCK_ROWS:
                add()
    if held:
        add()
    if count:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([[str(count), str(sums[d]), *map(str, cross[d])] for d in range(dim)])],
            ["key", "sums"])


def _add_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list[int]] = {}
    for b in batches:
        for k, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            v = list(map(int, s))
            total[k] = [p + q for p, q in zip(total[k], v, strict=True)] if k in total else v
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([list(map(str, v)) for v in total.values()],
                                                                                     pa.list_(pa.string()))], ["key", "sums"])


class Whitening:
    """A fitted model: n, sums S, components (columns), eigenvalues, trace."""

    def __init__(self, n: int, sums: list[int], cross: list[list[int]]):
        self.n, self.sums, self.dim = n, sums, len(sums)
        centred = [[(n * cross[i][j] - sums[i] * sums[j]) / n ** 2 for j in range(self.dim)] for i in range(self.dim)]
        value, vector = np.linalg.eigh(np.array(centred, float))
        top = np.argsort(-value, kind="stable")[:COMPONENTS]
        self.value, self.vector = value[top], vector[:, top]
        self.trace = sum(centred[i][i] for i in range(self.dim))
        self.varies = self.value > NO_VARIANCE * max(float(value.max()), 0.0)
        # the mean as a whole part and a rest below 1: a centred entry loses no digits
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s - n * (s // n)) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows of x on the components with variance."""
        v = self.varies
        return self.centred(x) @ self.vector[:, v] / np.sqrt(self.value[v])

    def explained(self) -> list[float]:
        return [float(e / self.trace) if ok else 0.0 for e, ok in zip(self.value, self.varies, strict=True)]

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum over dimensions of (n * x - S)^2 per row: with x = whole + y and
        S = n * whole + r it is n^2 * sum(y^2) - 2n * sum(y * r) + sum(r^2)."""
        y = (x - self.whole).astype(object if np.abs(x - self.whole).max(initial=0) >= 1 << 24 else np.int64)
        r = [s - self.n * int(w) for s, w in zip(self.sums, self.whole, strict=True)]
        high, low = (np.array(part, y.dtype) for part in zip(*(divmod(v, 1 << 24) for v in r), strict=True))
        squares, up, down = (y * y).sum(axis=1).tolist(), (y @ high).tolist(), (y @ low).tolist()
        rr = sum(v * v for v in r)
        return [self.n ** 2 * s - 2 * self.n * ((a << 24) + b) + rr for s, a, b in zip(squares, up, down, strict=True)]


# ---- the whitened covariance ---------------------------------------------------------------
def _merge(a, b):
    """Counts, means and centred products of two parts together."""
    (n, m, c), (k, w, d) = a, b
    step = w - m
    return n + k, m + step * (k / (n + k)), c + d + np.outer(step, step) * (n * k / (n + k))


def _moments(n, m, c) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n]), pa.array([m.tolist()], pa.list_(pa.float64())),
                                       pa.array([c.ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "cross"])


def _moment_rows(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    held = None
    for b in batches:
        if b.num_rows:
            y = model.value.whiten(_matrix(b.column(0), model.value.dim))
            m = y.mean(axis=0)
            part = (len(y), m, (y - m).T @ (y - m))
            held = part if held is None else _merge(held, part)
    if held:
        yield _moments(*held)


def _merge_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for b in batches:
        for n, m, c in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            part = (n, np.array(m), np.array(c).reshape(len(m), len(m)))
            held = part if held is None else _merge(held, part)
    if held:
        yield _moments(*held)


def identity_error(fit_list: DataFrame, model) -> float:
    """Largest entry of the fit list's whitened covariance minus the identity."""
    kind = "n long, mean array<double>, cross array<double>"
    parts = fit_list.mapInArrow(lambda it: _moment_rows(it, model), kind).repartition(MERGERS).mapInArrow(_merge_rows, kind)
    held = None
    for r in parts.collect():  # at most MERGERS rows of 16 x 16 numbers
        k = len(r["mean"])
        part = (r["n"], np.array(r["mean"]), np.array(r["cross"]).reshape(k, k))
        held = part if held is None else _merge(held, part)
    if held is None or not len(held[1]):
        return 0.0
    return float(np.abs(held[2] / held[0] - np.eye(len(held[1]))).max())


# ---- the operator --------------------------------------------------------------------------
def fit(vectors: DataFrame, vector_col: str = "embedding") -> tuple[Whitening, float] | None:
    """(model, identity error) of the table's distinct vectors; None without any."""
    spark = vectors.sparkSession
    rows = vectors.select(F.lit(None).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = cut_lineage(rows.mapInArrow(lambda it: _whole_rows(it, False), "x binary").distinct())
    common = whole.groupBy((F.length("x") / 8).cast("int").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return None
    dim = common["dim"]
    fit_list = whole.where(F.length("x") == 8 * dim)
    rows = (fit_list.mapInArrow(lambda it: _scatter_rows(it, dim), "key int, sums array<string>")
            .repartition(min(dim, MERGERS), "key").mapInArrow(_add_rows, "key int, sums array<string>"))
    got = {r["key"]: list(map(int, r["sums"])) for r in rows.collect()}
    if not got:
        return None
    model = Whitening(got[0][0], [got[d][1] for d in range(dim)], [got[d][2:] for d in range(dim)])
    return model, identity_error(fit_list, spark.sparkContext.broadcast(model))


def _project(batches: Iterable[pa.RecordBatch], model, error: float) -> Iterator[pa.RecordBatch]:
    m: Whitening = model.value
    k = len(m.value)
    explained = np.array(m.explained())
    for b in _whole_rows(batches, True):
        same = np.diff(np.frombuffer(b.column(1).buffers()[1], np.int32)[:b.num_rows + 1]) == 8 * m.dim if b.num_rows else []
        b = b.filter(pa.array(same, pa.bool_()))
        if not b.num_rows:
            continue
        x = _matrix(b.column(1), m.dim)
        white = np.full((len(x), k), np.nan)
        white[:, m.varies] = m.whiten(x)
        wide = m.deviations(x)
        each = np.repeat(np.arange(len(x)), k)
        long = pa.array([d if d < 1 << 63 else None for d in wide], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
             pa.array(np.full(len(each), m.n, np.int64)), long.take(pa.array(each)),
             pa.array(white.ravel(), mask=np.tile(~m.varies, len(x))), pa.array(np.tile(explained, len(x))),
             pa.array(np.full(len(each), error)),
             pa.array([Decimal(d) for d in wide], pa.decimal128(38, 0)).take(pa.array(each))],
            ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide"])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per usable vector and component, numbered from 1 by falling eigenvalue."""
    spark = vectors.sparkSession
    fitted = fit(vectors, vector_col)
    if fitted is None:
        return spark.createDataFrame([], OUT).withColumnRenamed("vec_id", id_col)
    model, error = spark.sparkContext.broadcast(fitted[0]), fitted[1]
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(lambda it: _project(it, model, error), OUT).withColumnRenamed("vec_id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``embeddings``, up to 16 components."""
    return whiten(table(spark, sf_dir, "embeddings"))

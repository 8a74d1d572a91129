"""Operator 8 - exact top-k inner products with a three-phase uniform threshold.

Every vector component x becomes floor(64 * x).  The components are cut into ``NODES`` slices;
a slice's partial products are the score list of one node, a score is
the sum over the nodes.  Queries meet all candidates block by block: a block
pair is one matrix product per slice.

1. Gather: each block sends, per query, the best exact scores among the top-k
   entries of its local score lists.
2. Cutoff: the k-th best of these scores, tau, is a safe lower bound of a query's
   k-th best score and goes back to the blocks with the query.  A candidate of
   score tau or more reaches the uniform threshold tau / NODES on at least one node;
   only such entries are collected.
3. Resolve: the collected entries' other partial scores are added, those
   of tau or more are sent, and the best k per query are kept (ties to the smaller vec_id).

Fewer candidates than k give no cutoff and are all returned.  Defined results: rows with a
null vec_id, a null vector or a null or non-finite component take no part;
shorter vectors count as padded with zeros; a repeated row is a candidate of
its copy (a row excludes only itself); extra columns are ignored.  Scores
must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, table

SCALE, NODES, TOP = 64, 2, 20
CANDIDATE_ROWS, QUERY_ROWS = 8192, 1024
GROUPS = 48
LOWEST = np.iinfo(np.int64).min
_BLOCK = "block long, rid binary, vec_id binary, vectors binary, large boolean"


def _blocks(batches: Iterable[pa.RecordBatch], dim: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Rows (rid, vec_id, vector) -> matrices of at most ``rows`` integer vectors."""
    part, number = TaskContext.get().partitionId() << 32, 0
    rid, ids, vectors = [], [], []

    def flush():
        nonlocal number
        m = np.concatenate(vectors)
        large = bool(len(m) and np.abs(m).max() > np.iinfo(np.int32).max)
        out = pa.RecordBatch.from_arrays(
            [pa.array([part + number]), pa.array([np.concatenate(rid).tobytes()], pa.binary()),
             pa.array([np.concatenate(ids).tobytes()], pa.binary()),
             pa.array([m.astype(np.int64 if large else np.int32).tobytes()], pa.binary()), pa.array([large])],
            ["block", "rid", "vec_id", "vectors", "large"])
        number += 1
        for x in (rid, ids, vectors):
            x.clear()
        return out

    for b in batches:
        col = b.column(2)
        size = np.asarray(col.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        flat = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)
        m = np.zeros((len(size), dim), np.int64)
        row = np.repeat(np.arange(len(size)), size)
        m[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = np.floor(SCALE * flat).astype(np.int64)
        for a in range(0, len(m), rows):
            s = slice(a, a + rows)
            if sum(map(len, rid)) + len(m[s]) > rows and rid:
                yield flush()
            rid.append(b.column(0).to_numpy()[s])
            ids.append(b.column(1).to_numpy()[s])
            vectors.append(m[s])
    if rid:
        yield flush()


class _Pair:
    """A query block against a candidate block: partial score matrices per node."""

    def __init__(self, row: dict, dim: int, nodes: int):
        def matrix(name):
            kind = np.int64 if row[f"{name}_large"] else np.int32
            return np.frombuffer(row[f"{name}_vectors"], kind).reshape(-1, dim)

        self.q_rid, self.c_rid = (np.frombuffer(row[f"{s}_rid"], np.int64) for s in "qc")
        self.q_id, self.c_id = (np.frombuffer(row[f"{s}_vec_id"], np.int64) for s in "qc")
        q, c = matrix("q"), matrix("c")
        bound = int(np.abs(q).max()) * int(np.abs(c).max()) * dim
        # products are exact in the narrowest type that holds the bound
        kind = (np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object)
        cuts = np.linspace(0, dim, nodes + 1).astype(int)
        self.parts = [q[:, a:b].astype(kind) @ c[:, a:b].astype(kind).T for a, b in zip(cuts, cuts[1:], strict=False)]
        self.own = self.q_rid[:, None] == self.c_rid[None, :] if np.intersect1d(self.q_rid, self.c_rid).size else None

    def total(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return sum(p[i, j] for p in self.parts).astype(np.int64)


def _pairs(batches: Iterable[pa.RecordBatch], dim: int, nodes: int) -> Iterator[tuple[_Pair, dict]]:
    for b in batches:
        for r in range(b.num_rows):
            row = b.slice(r, 1).to_pylist()[0]
            yield _Pair(row, dim, nodes), row


def _gather(batches: Iterable[pa.RecordBatch], dim: int, nodes: int, k: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: (rid, score) of each query's k best among the local lists' tops."""
    for p, _ in _pairs(batches, dim, nodes):
        n = len(p.c_rid)
        i, j = [], []
        for part in p.parts:
            top = np.argpartition(part, n - min(k + 1, n), axis=1)[:, n - min(k + 1, n):]
            i.append(np.repeat(np.arange(len(top)), top.shape[1]))
            j.append(top.ravel())
        pair = np.unique(np.concatenate(i) * n + np.concatenate(j))
        i, j = pair // n, pair % n
        if p.own is not None:
            keep = ~p.own[i, j]
            i, j = i[keep], j[keep]
        s = p.total(i, j)
        order = np.lexsort((-s, i))
        i, s = i[order], s[order]
        best = np.arange(len(i)) - np.searchsorted(i, i) < k
        yield pa.RecordBatch.from_arrays([pa.array(p.q_rid[i[best]]), pa.array(s[best])], ["rid", "score"])


def _collect(batches: Iterable[pa.RecordBatch], dim: int, nodes: int) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3: entries over the uniform threshold on some node, resolved to exact scores;
    those at or above the cutoff."""
    for p, row in _pairs(batches, dim, nodes):
        cut = dict(zip(row["cut_rid"] or [], row["cut_score"] or [], strict=True))
        tau = np.array([cut.get(r, LOWEST) for r in p.q_rid.tolist()], np.int64)
        over = np.zeros(p.parts[0].shape, bool)
        # integers: a sum of tau needs a part of ceil(tau / nodes); no cutoff (LOWEST, whose negative wraps) takes all
        share = np.where(tau == LOWEST, LOWEST, -(-tau // nodes))
        for part in p.parts:
            over |= part >= share[:, None]
        if p.own is not None:
            over &= ~p.own
        i, j = np.nonzero(over)
        s = p.total(i, j)
        keep = s >= tau[i]
        i, j, s = i[keep], j[keep], s[keep]
        yield pa.RecordBatch.from_arrays([pa.array(p.q_rid[i]), pa.array(p.q_id[i]), pa.array(p.c_id[j]), pa.array(s)],
                                         ["rid", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding",
          nodes: int = NODES, candidate_rows: int = CANDIDATE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row for which
    the column expression ``is_query`` holds."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = cut_lineage(vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"),
        v.cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("q")))
    facts = rows.agg(F.max(F.size("vector")).alias("dim"), F.count(F.when(F.col("q"), 1)).alias("n")).first()
    dim, n_queries = max(facts["dim"] or 0, nodes), facts["n"]
    plain = rows.select("rid", "vec_id", "vector")
    c = plain.mapInArrow(lambda it: _blocks(it, dim, candidate_rows), _BLOCK)
    q = cut_lineage(rows.where("q").select("rid", "vec_id", "vector").repartition(max(1, -(-n_queries // query_rows)))
                    .mapInArrow(lambda it: _blocks(it, dim, query_rows), _BLOCK))
    c = cut_lineage(c.select(F.pmod(F.xxhash64("block"), F.lit(GROUPS)).alias("g"),
                             *[F.col(x).alias(f"c_{x}") for x in _names()]))
    # the stated query set against all rows: every query block is sent to every group of candidate blocks
    q = q.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(GROUPS - 1).cast("long"))).alias("g"),
                 *[F.col(x).alias(f"q_{x}") for x in _names()])
    # merged, never broadcast: Spark takes the repeated query blocks for as small as the file they are read from
    local = c.join(q.hint("merge"), "g").mapInArrow(lambda it: _gather(it, dim, nodes, k), "rid long, score long")
    place = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score")))
    cut = local.withColumn("place", place).where(F.col("place") == k).select("rid", "score")
    # cutoffs of a query block travel with it
    mine = q.where("g = 0").mapInArrow(_members, "q_block long, rid long")
    cuts = (mine.join(cut, "rid").groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("rid", "score"))).alias("cuts")))
    cuts = cut_lineage(cuts)
    q = q.join(cuts, "q_block", "left").select(
        *q.columns, F.col("cuts.rid").alias("cut_rid"), F.col("cuts.score").alias("cut_score"))
    found = c.join(q.hint("merge"), "g").mapInArrow(
        lambda it: _collect(it, dim, nodes), "rid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _names() -> list[str]:
    return [c.split()[0] for c in _BLOCK.split(", ")]


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, rid) of every query of the query blocks."""
    for b in batches:
        for block, raw in zip(b.column("q_block").to_pylist(), b.column("q_rid").to_pylist(), strict=True):
            rid = np.frombuffer(raw, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rid), block)), pa.array(rid)], ["q_block", "rid"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose vec_id is divisible by 20 against all rows."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid
  WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""

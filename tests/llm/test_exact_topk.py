import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import exact_topk as T

SCHEMA = "vec_id long, embedding array<float>, label int, rid long, score long"


def brute(rows, k, step):
    ok = [(n, i, [math.floor(64 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows)
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in ok:
        if i % step == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in ok if m != n)
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, k, step, **kw):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA).repartition(3)
    got = T.top_k(df, F.col("vec_id") % step == 0, k, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("nodes, k", [(2, 5), (4, 5), (1, 3), (2, 1000)])
def test_matches_brute_force(spark, nodes, k):
    r = np.random.default_rng(nodes)
    rows = [(i, r.normal(0, .3, 16).astype(np.float32).tolist()) for i in range(230)]
    rows += [(500 + i, rows[i % 7][1]) for i in range(30)]  # ties
    assert run(spark, rows, k, 20, nodes=nodes, candidate_rows=32, query_rows=4) == brute(rows, k, 20)


def test_defined_cases(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.5, None]), (40, None), (60, [float("nan"), 1.0]), (80, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (1, [1.0]), (2, []), (0, [1.0, 2.0]), (3, [-3.0, 1e6])]
    assert run(spark, rows, 20, 20) == brute(rows, 20, 20)
    assert run(spark, [], 20, 20) == []
    assert run(spark, [(0, [1.0])], 20, 20) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])], 20, 20) == []


def test_large_components_stay_exact(spark):
    r = np.random.default_rng(1)
    rows = [(i, (r.normal(0, 1, 8) * 1e7).astype(np.float32).tolist()) for i in range(60)]
    assert run(spark, rows, 4, 20) == brute(rows, 4, 20)


@pytest.mark.parametrize("nodes", [1, 2, 3])
def test_fewer_candidates_than_k_are_all_returned(spark, nodes):
    rows = [(i, [float(i), -1.5, 0.25, 2.0]) for i in range(0, 60, 10)]
    got = run(spark, rows, 20, 20, nodes=nodes)
    assert len(got) == 3 * 5 and got == brute(rows, 20, 20)


def test_query_blocks_are_not_broadcast(spark, monkeypatch):
    cut, plans = T.cut_lineage, []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(T, "cut_lineage", watched)
    rows = [(i, [float(i % 7), -1.5, 0.25, 2.0]) for i in range(200)]
    df = T.top_k(spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA), F.col("vec_id") % 20 == 0, 3)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    met = [line for p in plans for line in p.splitlines() if "Join [g#" in line]
    # repeated GROUPS times, the query blocks are far larger than Spark's estimate of them
    assert len(met) == 2 and all("SortMergeJoin" in line for line in met)

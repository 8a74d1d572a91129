"""Operator 12 against a direct computation with numpy."""

import math

import numpy as np
import pytest

from webloom.llm import whitening as W

KIND = "vec_id long, embedding array<float>, x string, n int, label int"


def table(spark, vectors, parts=3):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in vectors], KIND).repartition(parts)


def expected(vectors):
    """{vec_id: (deviation, |whitened| per component)}, n, explained from plain sums."""
    rows = [(i, [math.floor(64 * float(np.float32(c))) + 10 ** 6 for c in v]) for i, v in vectors
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(t) for t in sorted({tuple(x) for _, x in rows})]
    n, dim = len(fit), len(fit[0])
    s = [sum(x[d] for x in fit) for d in range(dim)]
    m = np.array(fit, float) - np.array(s, float) / n
    value, vector = np.linalg.eigh(m.T @ m / n)
    top = np.argsort(-value)[:16]
    out = {i: (sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)),
               np.abs((np.array(x) - np.array(s) / n) @ vector[:, top] / np.sqrt(value[top]))) for i, x in rows}
    return out, n, value[top] / value.sum()


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 20)) * np.linspace(0.1, 3, 20)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a third of the rows is one vector
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] * 20), (2004, [float("inf")] + [0.0] * 19)]
    return rows


def test_whole_result_equals_direct_computation(spark, vectors):
    got = W.whiten(table(spark, vectors)).collect()
    want, n, explained = expected(vectors)
    assert len(got) == 16 * len(want)
    by = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["deviation"] == want[r["vec_id"]][0] == r["deviation_wide"]
        assert abs(abs(r["whitened"]) - want[r["vec_id"]][1][r["component"] - 1]) < 1e-7
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        by.setdefault((r["vec_id"], r["component"]), []).append(r["whitened"])
    assert all(len(v) == 1 for v in by.values())
    # one sign for all rows: equal vectors have equal values
    assert len({by[1000 + i, 3][0] for i in range(150)}) == 1


def test_bit_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for rows, low, high in ((1, -5, 5), (63, 0, 1), (64, 10 ** 6, 10 ** 6 + 500), (1000, -2 ** 62, 2 ** 62)):
        x = rng.integers(low, high + 1, (rows, 5))
        sums, cross = W.cross_products(x)
        big = x.astype(object)
        assert (sums == big.sum(axis=0)).all() and (cross == big.T @ big).all()


def test_blocks_and_partitions_do_not_matter(spark, vectors, monkeypatch):
    def rows(parts):
        return sorted((r["vec_id"], r["component"], r["deviation"], round(abs(r["whitened"]), 9)) for r in
                      W.whiten(table(spark, vectors, parts)).collect())
    whole = rows(1)
    monkeypatch.setattr(W, "BLOCK_ROWS", 7)
    assert rows(5) == whole


def test_defined_cases(spark):
    assert W.whiten(table(spark, [])).count() == 0
    assert W.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    one = W.whiten(table(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()  # one distinct vector: no variance
    assert len(one) == 4 and all(r["whitened"] is None and r["explained"] == 0 and r["n"] == 1 and r["deviation"] == 0
                                 and r["identity_error"] == 0 for r in one)
    line = W.whiten(table(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])).collect()  # rank one
    assert {r["component"]: r["whitened"] is None for r in line} == {1: False, 2: True, 3: True}
    mixed = W.whiten(table(spark, [(i, [float(i), 1.0]) for i in range(4)] + [(9, [1.0]), (10, [1e30, 0.0])])).collect()
    assert {r["vec_id"] for r in mixed} == {0, 1, 2, 3} and {r["n"] for r in mixed} == {4}


def test_deviations_beyond_a_long():
    n = 1 << 40
    m = W.Whitening(n, [5 * n + 3], [[30 * n]])
    x = np.array([[10 ** 6], [-7]])
    want = [(n * int(v) - 5 * n - 3) ** 2 for v in (10 ** 6, -7)]
    assert m.deviations(x) == want and want[0] > 1 << 63

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from webloom.llm import jaccard_join as J
from webloom.llm import text as X
from webloom.llm.common import components

WORDS = [f"w{i}" for i in range(400)]


def brute(rows, k=3):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else
                    frozenset([tuple(w)]) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            x = len(a & b)
            if a and b and 100 * x >= 90 * (len(a) + len(b) - x):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, len(sets[i]), low[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed=1):
    r = random.Random(seed)
    rows, n = [], 0

    def add(t):
        nonlocal n
        rows.append((n, t))
        n += 1

    passage = " ".join(r.choices(WORDS, k=60))
    base = r.choices(WORDS, k=150)
    for _ in range(60):  # a dense group of near copies, linked by chains
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(WORDS)
        add(" ".join(w))
    for _ in range(40):  # clean texts with a shared passage
        add(" ".join(r.choices(WORDS, k=r.randint(1, 120))) + " " + passage)
    for _ in range(12):
        add(rows[70][1].upper())
    for t in (None, "", "  \n", "one", "ONE", "one two", "one two", "one two three", "a\tb\nc d"):
        add(t)
    return rows


@pytest.mark.parametrize("block_bytes", [J.BLOCK_BYTES, 6000])
def test_components_match_brute_force(docs_of, block_bytes):
    rows = corpus()
    got = J.jaccard_components(docs_of(rows), block_bytes=block_bytes).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(docs_of):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "q r s"), (None, None)]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(docs_of(rows)).collect()), key=str)
    assert got == sorted([(None, 2, 5), (5, 2, 5), (5, 2, 5), (None, 1, None), (None, 0, None)], key=str)
    assert J.jaccard_components(docs_of([])).count() == 0


def test_derived_overlaps_equal_fresh_ones():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 300, r.integers(5, 60)).astype(np.uint64)) for _ in range(80)]
    sets += [np.unique(np.append(s[1:], np.uint64(9999))) for s in sets[:40]]
    sizes = [len(s) for s in sets]
    for num, den in ((90, 100), (60, 100)):
        links = J.links_in(sets, sizes, num, den)
        parent = list(range(len(sets)))

        def root(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for i, j in links:
            x = len(np.intersect1d(sets[i], sets[j]))
            assert den * x >= num * (sizes[i] + sizes[j] - x)
            parent[root(i)] = root(j)
        for i in range(len(sets)):
            for j in range(i):
                x = len(np.intersect1d(sets[i], sets[j]))
                if den * x >= num * (sizes[i] + sizes[j] - x):
                    assert root(i) == root(j)


def test_index_parts_lose_no_link():
    """Near copies stay together when only their index parts are compared."""
    class Counts:
        value = np.zeros(J.COUNTERS, np.uint32)
    r = np.random.default_rng(3)
    base = np.unique(r.integers(0, 1 << 60, 200).astype(np.uint64))
    sets = [base] + [np.unique(np.append(np.delete(base, r.integers(0, len(base), 4)), r.integers(0, 1 << 60, 4).astype(np.uint64)))
                     for _ in range(20)]
    parts = [J.index_part(s, Counts, 90, 100) for s in sets]
    whole = J.links_in(sets, [len(s) for s in sets], 90, 100)
    part = J.links_in(parts, [len(s) for s in sets], 90, 100)
    assert len(part) >= len(whole) > 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 130)}}
    assert components(df.limit(0)).count() == 0


def test_hubs_leave_only_what_they_have_not_met(spark):
    """A pair that its hub has met and not linked is decided; of a larger cluster the hubs are left out."""
    sets = {1: range(100), 2: range(50, 150),  # a cluster of two, not linked
            10: range(1000, 1100), 11: range(1001, 1101), 12: range(1006, 1106),  # 12 is linked to 11, not to 10
            20: range(2000, 2100), 21: range(2050, 2150), 22: range(2052, 2152)}  # 21 and 22 are linked, the hub to neither
    rows = [(fp, len(s), bytearray(np.array(sorted(s), np.uint64).tobytes()), fp // 10 * 10 or 1) for fp, s in sets.items()]
    held = spark.createDataFrame(rows, "fp long, n int, shingles binary, component long")
    links, rest = J._meet_hubs(held, 90, 100)
    assert {tuple(r) for r in links.collect()} == {(11, 10), (12, 11)}
    assert {(r["fp"], r["component"], r["n"], r["main"]) for r in rest.collect()} == {(21, 20, 100, False), (22, 20, 100, False)}
    assert J._decided(held, rest, 90, 100, J.BLOCK_BYTES).count() == 1


def test_first_pass_holds_little(monkeypatch):
    """A worker holds the count array and arrays of one chunk, nothing of the count array's size besides."""
    monkeypatch.setattr(X, "_powers", (np.ones(1, np.uint64), np.ones(1, np.uint64)))
    r = random.Random(5)
    batch = pa.RecordBatch.from_arrays([pa.array(range(512)), pa.array([" ".join(r.choices(WORDS, k=500)) for _ in range(512)])], ["id", "text"])
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in J._set_rows([batch], 5))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 512 + 64 and peak < 72 << 20

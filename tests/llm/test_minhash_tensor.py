"""Operator 11 against all pairs of whole sets."""

import random

import numpy as np
import pytest

from webloom.llm import minhash_tensor as M


def shingle_set(text, k):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def expected(rows, k, num, den):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in low[root(i)] if x is not None]
        c = min(ids) if ids else None
        out.append((d, len(sets[i]), c if sets[i] else d, d == (c if sets[i] else d)))
    return sorted(out, key=str)


def edited(rng, words, share):
    out = list(words)
    for i in range(len(out)):
        if rng.random() < share:
            out[i] = f"e{rng.randint(0, 10 ** 6)}"
    return out


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.choice([1, 2, 30])):
            rows.append((n, " ".join(edited(rng, base, rng.choice([0, 0.01, 0.04, 0.08])))))
            n += 1
    rows += [(500 + i, rows[0][1].upper()) for i in range(40)]
    rows += [(600, None), (601, ""), (602, " \n\t"), (603, "one"), (604, "ONE"), (605, "one two"), (606, "one two one two"),
             (607, "one two"), (608, "é ö"), (609, "É Ö"), (603, "one"), (None, rows[1][1]), (None, "alone by itself"), (7, rows[7][1])]
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("k", "num", "den"), [(2, 80, 100), (5, 80, 100)])
def test_equals_all_pairs(docs_of, k, num, den):
    rows = corpus()
    assert result(M.near_duplicates(docs_of(rows), k=k)) == expected(rows, k, num, den)


def test_small_blocks_lose_no_link(docs_of):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(edited(rng, base, 0.05))) for i in range(120)]  # links in chains, few with the hub
    assert result(M.near_duplicates(docs_of(rows), k=2, block_bytes=4096)) == expected(rows, 2, 80, 100)


@pytest.mark.parametrize("seed", range(5))
def test_links_between_connects_what_all_links_connect(seed):
    rng = random.Random(seed)
    base = [set(rng.sample(range(400), 30)) for _ in range(4)]
    sets = []
    for _ in range(60):
        s = set(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randint(0, 400))
        sets.append(s)
    group = [rng.randint(0, 50) for _ in sets]

    def parts(pairs):
        parent = list(range(60))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i
        for i, j in [*pairs, *((i, j) for i in range(60) for j in range(i) if group[i] == group[j])]:
            parent[root(i)] = root(j)
        return [[root(i) == root(j) for j in range(60)] for i in range(60)]

    every = [(i, j) for i in range(60) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    got = M.links_between([np.array(sorted(s), np.uint64) for s in sets], group, 80, 100)
    assert set(map(frozenset, got)) <= set(map(frozenset, every))
    assert parts(got) == parts(every)


def test_share_of_pairs_that_meet_in_a_table():
    rng = np.random.default_rng(2)

    def met(similar, trials=400):
        hits = 0
        for _ in range(trials):
            n = 100
            common = round(2 * n * similar / (1 + similar))
            x = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
            a, b = M.half_keys([x[:n], x[n - common:]])
            same = a == b
            hits += same[:M.SIDE].any() and same[M.SIDE:].any()
        return hits / trials

    assert met(0.82) == 1.0 and met(0.1) < 0.02
    assert abs(met(0.5) - (1 - (1 - 0.5 ** M.HALF) ** M.SIDE) ** 2) < 0.08


def test_classes_of_distinct_sets(docs_of):
    rows, classes, seed = M._classes(docs_of([(1, "a b c"), (2, "a b d")]).select("doc_id", "text"), 2)
    assert seed == 0 and classes.count() == 2 and rows.count() == 2


def test_empty_table(spark):
    assert M.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from webloom.llm import lm_nce as L
from webloom.llm import text as X


def corpus(n=240, seed=2):
    """Two 'languages' of their own words: context tells them apart."""
    r = random.Random(seed)
    tongues = [[f"{p}{i}" for i in range(60)] for p in ("al", "be")]
    rows = []
    for i in range(n):
        words = tongues[i % 2]
        rows.append((i, " ".join(words[min(int(r.expovariate(.1)), 59)] for _ in range(r.randint(0, 60)))))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "Never SEEN words"), (n + 3, "Never SEEN words")]


def expected(rows):
    toks = [((t or "").encode().lower().split() + [b""]) for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for t, h in zip(toks, held, strict=True) if not h for w in t)
    N, V = sum(c.values()), len(c)
    return [(i, h, len(t), sum(c[w] > 0 for w in t), N, sum(math.log10((c[w] + 1) / (N + V + 1)) for w in t))
            for (i, _), t, h in zip(rows, toks, held, strict=True)]


def test_counts_and_base_scores(docs_of, monkeypatch):
    rows = corpus()
    for bound in (L.TABLE, 20):  # words outside the broadcast table go through the join
        monkeypatch.setattr(L, "TABLE", bound)
        got = L.score(docs_of(rows)).collect()
        want = expected(rows)
        assert len(got) == len(want)
        for g, w in zip(sorted(got, key=lambda r: r["doc_id"]), want, strict=True):
            assert (g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == w[:5]
            assert abs(g["base_score"] - w[5]) < 1e-8
        held = [g for g in got if g["held_out"]]
        assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_probabilities_sum_to_one():
    r = np.random.default_rng(0)
    m = L.Model.start(np.full(L.UNITS, 1 / L.UNITS))
    m.Q[:] = r.normal(0, 1, m.Q.shape)
    m.R[:] = r.normal(0, 1, m.R.shape)
    off = np.array([0, 3])
    total = sum(np.exp(m.log_probs(np.array([5, 9, u]), off)[2]) for u in range(L.UNITS))
    assert abs(total - 1) < 1e-3


def test_stream_ends_every_document():
    c = next(X.chunks(pa.array(["a B", None, "", "b"])))
    word, off = L.stream(c)
    assert off.tolist() == [0, 3, 4, 5, 7]
    assert (word[[2, 3, 4, 6]] == L.END).all() and word[1] == word[5]


def test_table_finds_exactly_its_words():
    r = np.random.default_rng(1)
    w = np.unique(r.integers(1, 1 << 63, 5000).astype(np.uint64))
    w[:400] = (np.uint64(7) << np.uint64(50)) + np.arange(400, dtype=np.uint64)  # one slot for all
    v = L.Vocabulary(w, np.arange(len(w)))
    assert v.find(w).tolist() == list(range(len(w)))
    assert (v.find(w + np.uint64(1 << 30)) < 0).all()


def test_null_ids_and_empty_table(docs_of):
    got = L.score(docs_of([(None, "a b"), (None, None)])).collect()
    assert sorted(g["n_tokens"] for g in got) == [1, 3] and all(g["train_tokens"] == 4 for g in got)
    assert L.score(docs_of([])).count() == 0


def test_no_training_rows(docs_of):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = L.score(docs_of([(i, "a b") for i in held])).collect()
    assert all((g["n_known"], g["train_tokens"], g["base_score"]) == (0, 0, 0.0) and math.isfinite(g["score"]) for g in got)


def test_log_probs_equal_plain_softmax():
    r = np.random.default_rng(5)
    for scale in (1, 40):  # small logits, and logits far beyond what exp can take
        m = L.Model.start(np.full(L.UNITS, 1 / L.UNITS))
        m.Q[:] = r.normal(0, scale, m.Q.shape)
        m.R[:] = r.normal(0, 1, m.R.shape)
        unit, off = r.integers(0, L.UNITS, 700), np.array([0, 1, 300, 700])
        unit[350:500] = unit[10:160]  # repeated contexts
        got, ctx = m.log_probs(unit, off, block=64), L.contexts(unit, off)
        for i in (0, 1, 5, 299, 300, 360, 499, 699):
            z = m.Q.astype(float) @ (m.R[ctx[i]].astype(float) * m.scale).sum(0) + m.b
            assert abs(got[i] - (z[unit[i]] - z.max() - np.log(np.exp(z - z.max()).sum()))) < 1e-3 * max(1, abs(got[i]))


def test_step_equals_plain_gradient():
    r = np.random.default_rng(6)
    uni = r.random(L.UNITS) + 0.1
    uni /= uni.sum()
    t = L.Trainer(L.Model.start(uni), uni, 3, 0.1)
    before = [x.astype(float).copy() for x in (t.m.R, t.m.Q, t.m.b, t.m.scale)]
    ctx, y = r.integers(0, L.UNITS + 1, (9, L.CONTEXT)), r.integers(0, L.UNITS, 9)
    noise = np.searchsorted(np.cumsum(uni), np.random.default_rng(3).random(L.NOISE)).clip(max=L.UNITS - 1)
    R, Q, b, s = before
    g = [np.zeros_like(x) for x in before]
    for c, w in zip(ctx, y, strict=True):
        h = (R[c] * s).sum(0)
        for u, label in [(w, 1), *((k, 0) for k in noise)]:
            e = 1 / (1 + np.exp(-(h @ Q[u] + b[u] - np.log(L.NOISE * uni[u])))) - label
            g[1][u] += e * h
            g[2][u] += e
            for j, k in enumerate(c):
                g[0][k] += e * Q[u] * s[j]
                g[3][j] += e * Q[u] * R[k]
    t.step(ctx, y)
    for x, old, grad in zip((t.m.R, t.m.Q, t.m.b, t.m.scale), before, g, strict=True):
        grad = grad / 9
        assert np.allclose(x, old - 0.1 * grad / np.sqrt(1e-2 + grad * grad), atol=2e-4)


def test_small_corpora_are_read_several_times():
    assert len(L.rounds_for(1000)) == L.PASSES + 1 and L.rounds_for(10 ** 9) == [(16, .1), (1, .1)]


def test_schedule_does_not_depend_on_the_size(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(60), "doc_id long, text string").coalesce(1)
    got = []
    for few in (1, 10 ** 9):  # no bound on the number of tokens changes how a corpus is learned
        monkeypatch.setattr(L, "LEARN_TOKENS", few)
        got.append(sorted((r["doc_id"], round(r["score"], 6)) for r in L.score(docs).collect()))
    assert got[0] == got[1]

"""Operator 13 against a search of every start and period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from webloom.llm import periodic_runs as P

WHITE = b" \t\n\r\x0b\x0c"


def brute(words):
    """[(start, length, period)] from every period's stretches of equal words."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # periods rise: the first is the smallest
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def rewritten(doc_id, text):
    words = (text or "").encode().split()
    h, n = (1 if doc_id is None else zlib.crc32(str(doc_id).encode())), len((text or "").encode().split())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = rewritten(doc_id, text)
    found = brute(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *(best[:1] + best[1:2] + best[2:] + (1000 * best[1] // best[2],) if best else (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def random_words(rng, alphabet, n):
    out = []
    while len(out) < n:
        if rng.random() < 0.4 and out:
            q = rng.randint(1, 9)
            unit = [rng.choice(alphabet) for _ in range(q)] if rng.random() < 0.5 else out[-q:]
            out += unit * rng.randint(2, 9)
            out += unit[:rng.randint(0, len(unit))]
        else:
            out.append(rng.choice(alphabet))
    return out[:n]


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [random_words(rng, "abcdefghij"[:rng.randint(1, 10)], rng.randint(0, 160)) for _ in range(12)]
    texts += [texts[0], texts[1] + texts[2]]
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int32)
    first = np.cumsum([0] + [len(t) for t in texts])
    start, end, q = P.runs_of(ids, first)
    got = [(int(s), int(e - s), int(p)) for s, e, p in zip(start, end, q, strict=True)]
    want = [(s + int(f), n, p) for t, f in zip(texts, first, strict=False) for s, n, p in brute(t)]
    assert got == want


@pytest.mark.parametrize("word", ["fibonacci", "thue-morse", "one letter", "nested"])
def test_structured_words(word):
    a = {"fibonacci": lambda: fibonacci(16), "thue-morse": lambda: [bin(i).count("1") % 2 for i in range(1500)],
         "one letter": lambda: [0] * 1200, "nested": lambda: (([0, 0, 0, 0, 0, 0, 1] * 5 + [2]) * 6 + [3]) * 5}[word]()
    ids = np.array(a, np.int32)
    start, end, q = P.runs_of(ids, np.array([0, len(a)]))
    assert [(int(s), int(e - s), int(p)) for s, e, p in zip(start, end, q, strict=True)] == brute(a)


def fibonacci(k):
    a, b = [0], [0, 1]
    for _ in range(k - 2):
        a, b = b, b + a
    return b


def test_grammar_expands_to_the_texts():
    rng = random.Random(5)
    texts = [random_words(rng, "abcd", n) for n in (0, 1, 2, 90, 300)]
    ids = np.array([ord(w) - 97 for t in texts for w in t])
    first = np.cumsum([0] + [len(t) for t in texts])
    g = P.re_pair(ids, first)

    def expand(s):
        return [s] if s < g.words else expand(g.left[s - g.words]) + expand(g.right[s - g.words])

    for d, t in enumerate(texts):
        assert (expand(g.root[d]) if t else []) == [ord(w) - 97 for w in t]
    for k in range(len(g.left)):
        assert expand(g.words + k) == ids[g.at[k]:g.at[k] + g.length[k]].tolist()
    assert len(g.left) < len(ids)


def test_digests_of_documents(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, " ".join(random_words(rng, "abcdefgh", rng.randint(0, 90)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "A a A a A a A a A a"), (204, "é b " * 30), (None, "x " * 40),
             (205, "x\x0by\x0cz " * 9), (206, "x y " * 9), (206, "x y " * 9), (210, "no runs here at all")]
    got = sorted((tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                       "collapsed_sha256")) for r in P.run_digests(docs_of(rows)).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert any(r[1] > 1 for r in got) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows[:120])


def test_chunk_size_does_not_matter(docs_of, monkeypatch):
    rng = random.Random(8)
    docs = docs_of([(i, " ".join(random_words(rng, "abc", 60))) for i in range(40)], 1)
    whole = sorted(P.run_digests(docs).collect())
    # functions of the package run in workers: the spans form is called here directly
    monkeypatch.setattr(P, "CHUNK_BYTES", 200)
    monkeypatch.setattr(P, "PIECE_BYTES", 7)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"id": r["doc_id"], "text": r["text"]} for r in docs.collect()])
    parts = list(P._digest_rows([batch]))
    assert len(parts) > 5
    assert sorted(tuple(x.values()) for p in parts for x in p.to_pylist()) == [tuple(r) for r in whole]


def test_spans(docs_of):
    got = P.runs(docs_of([(1, "q a b a b a b a b a c"), (2, "none"), (3, None)])).collect()
    assert [tuple(r) for r in got] == [(1, 1, 9, 2)]


def test_one_very_long_text_is_linear():
    import time
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 5000, 1_000_000).astype(np.int32)
    ids[200_000:600_000] = ids[200_000 + np.arange(400_000) % 1234]
    t = time.time()
    start, end, q = P.runs_of(ids, np.array([0, len(ids)]))
    assert (200_000, 600_000, 1234) in {(int(s), int(e), int(p)) for s, e, p in zip(start, end, q, strict=True)}
    assert time.time() - t < 120


def test_empty_table(spark, docs_of):
    assert P.run_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0

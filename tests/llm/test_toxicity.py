import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from webloom.llm import toxicity as T

WORDS = ["".join(random.Random(i).choices("abcdefghijklmnop", k=6)) for i in range(300)]
LABEL = "doc_id long, quality int, toxic int"


def corpus(n=600):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = r.choices(WORDS, k=r.randint(4, 150))
        if toxic:
            for _ in range(2):
                w.insert(r.randrange(len(w) + 1), r.choice(["zzidiotzz", "xqscum", "Xqscums"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(docs_of, spark):
    rows, labels = corpus()
    docs = docs_of(rows)
    got = T.score(docs, T.fit(docs, spark.createDataFrame(labels, LABEL))).collect()
    assert len(got) == len(rows)
    for g in got:
        assert g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2)
        assert 0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.3)
    held = [g for g in got if g["held_out"]]
    assert sum(g["predicted"] == (g["doc_id"] % 5 == 0) for g in held) >= 0.97 * len(held)


def test_held_out_labels_are_never_read(docs_of, spark):
    rows, labels = corpus(200)
    docs = docs_of(rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, b = (T.fit(docs, spark.createDataFrame(x, LABEL)) for x in (labels, flipped))
    assert a[1] == pytest.approx(b[1]) and np.allclose(a[0], b[0])


def ngrams(text):
    """(lower-cased?, n-gram): the features of a text before hashing, one by one."""
    out = set()
    for lower, orders in T.VIEWS:
        t = "".join(" " if "\t" <= c <= "\r" else c for c in (text.lower() if lower else text))
        out |= {(lower, t[i:i + n]) for n in orders for i in range(len(t) - n + 1)}
    return out


def slot_of(lower, gram):
    h = 977 * (not lower) % 2 ** 32
    for c, f in zip(gram, T._FACTOR, strict=False):
        h = (h + ord(c) * int(f)) % 2 ** 32
    return ((h ^ h >> 15) * 0x2C1B3C6D % 2 ** 32) >> 12


def test_features_equal_brute_force_whatever_the_pieces(monkeypatch):
    every = T.Features(np.ones(T.SLOTS, bool))
    texts = ["Hello wörld", "", "a", "x\ny " * 50, "Some LONGER text, with ever so many words in it 😀 and more"]
    want = [sorted({slot_of(*g) for g in ngrams(t)}) for t in texts]
    for piece in (T.PIECE_CHARS, 16, 7):
        monkeypatch.setattr(T, "PIECE_CHARS", piece)
        assert [sorted(every.of(t).tolist()) for t in texts] == want
    assert not every.seen.any() and every.of(None).tolist() == []


def test_scores_equal_brute_force():
    rng = np.random.default_rng(1)
    weight = np.where(rng.random(T.SLOTS) < 0.3, rng.normal(size=T.SLOTS), 0).astype(np.float32)
    texts = ["Hello wörld", None, "", "abc " * 40]
    got = T.Scorer((weight, -0.5))(pa.array(texts))
    for g, t in zip(got, texts, strict=True):
        z = -0.5 + sum(float(weight[s]) for s in {slot_of(*n) for n in ngrams(t or "")})
        assert g == pytest.approx(1 / (1 + np.exp(-z)))


def test_one_text_of_20_mb_takes_little_memory():
    import resource
    text = "".join(random.Random(1).choices("abcdefghij klmnop", k=1_000_000)) * 20
    every = T.Features(np.ones(T.SLOTS, bool))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = sum(len(f) for f in every.pieces(text))
    assert 0 < n <= T.SLOTS and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000


@pytest.mark.parametrize("total", [10, 10 ** 6, 10 ** 12, 10 ** 18])
def test_a_sample_is_never_empty_at_any_size(spark, total):
    from webloom.llm.common import hash_share
    share = spark.range(1).select(hash_share("id", 20_000, total).alias("s"))
    text = share._jdf.queryExecution().optimizedPlan().toString()
    assert "false" not in text.lower()
    if total == 10 ** 6:
        assert abs(spark.range(50_000).where(hash_share("id", 20_000, total)).count() - 1000) < 150


def test_defined_cases(docs_of, spark):
    rows, labels = corpus(100)
    docs = docs_of([*rows, (None, "zzidiotzz"), (900, None), (900, ""), (901, "zzidiotzz " * 20000)])
    lab = spark.createDataFrame([*labels, (1, 0, 1), (1, 0, None), (5555, 0, 1)], LABEL)
    got = T.score(docs, T.fit(docs, lab)).collect()
    assert len(got) == 104 and len({g["score"] for g in got if g["doc_id"] == 900}) == 1
    for bad in ([], [(i, 1, 0) for i in range(50)], [(i, 1, None) for i in range(50)]):
        model = T.fit(docs, spark.createDataFrame(bad, LABEL))
        assert all(g["predicted"] == 0 for g in T.score(docs, model).collect())
    assert T.score(docs_of([]), T.fit(docs_of([]), lab)).count() == 0


def test_keep_clean_keeps_columns(docs_of, spark):
    rows, labels = corpus(400)
    docs = docs_of(rows)
    model = T.fit(docs, spark.createDataFrame(labels, LABEL))
    kept = T.keep_clean(docs, model)
    assert kept.schema == docs.schema
    low = {g["doc_id"] for g in T.score(docs, model).collect() if g["score"] < T.CUT}
    assert {r["doc_id"] for r in kept.collect()} == low and 0 < len(low) < 400

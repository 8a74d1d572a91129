"""The pipeline against a plain version of every stage on a small corpus."""

import random
import struct
import zlib

import corpus_pipeline as C
import pytest

from webloom.llm import packing, toxicity
from webloom.llm.tokenize import encoder, vocabulary

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfglm" for b in ("ana", "elo", "iri", "utu", "obe", "ash")]
    item = " ".join(r.choices(words, k=20))
    rows, labels, facts = [], [], {}
    for i in range(260):
        w = r.choices(words, k=r.randint(20, 80))
        kind = ("toxic", "leak", "private", "copy", "clean")[i % 5]
        if kind == "toxic":
            w[5:5] = ["zqidiot", "zqscum"]
        if kind == "leak":
            w[3:3] = item.split()
        if kind == "private":
            w.insert(2, f"me{i}@mail.example.com")
        t = " ".join(w)
        if kind == "copy" and i >= 50:
            t = rows[i - 45][1]  # an earlier copy row
        rows.append((i, t, "en", f"src{i % 3}", len(t)))
        labels.append((i, 1, int(kind == "toxic")))
        facts[i] = kind
    rows += [(1000, None, "en", "s", 0), (1001, "", None, None, None), (1002, "zqidiot zqscum zqidiot", "en", "s", 22)]
    path = tmp_path_factory.mktemp("data")
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows, facts


def test_stages_and_run(spark, folder):
    path, rows, facts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    by_id = {r[0]: r for r in rows}
    kept = []
    cur = docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, cur, path)
        assert out.columns == docs.columns, name
        got = [tuple(r) for r in out.collect()]
        kept.append({r[0]: r for r in got})
        assert len(kept[-1]) == len(got)
        cur = spark.createDataFrame(got, docs.schema)
    toxic, near, clean, private = kept
    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    low = {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["score"] < toxicity.CUT}
    assert set(toxic) == low and not {i for i in low if facts.get(i) == "toxic"} and 1002 not in low
    assert {i for i, k in facts.items() if k != "toxic"} <= low
    first = {}
    for i in sorted(toxic):
        first.setdefault(toxic[i][1] or i, i)  # only equal texts link in this corpus
    assert set(near) == set(first.values())
    assert set(clean) == {i for i in near if facts.get(i) != "leak"}
    assert set(private) == set(clean)
    for i, r in private.items():
        if facts.get(i) == "private":
            assert f"me{i}@" not in r[1] and "<EMAIL>" in r[1] and r[4] == len(r[1])
        else:
            assert r == clean[i] == by_id[i] or r[1] == by_id[i][1]
    out = C.run(spark, path).collect()
    tok = encoder(vocabulary("byte_bpe_50k.json"), True, packing.END_ID).tokenizer
    want = {}
    for i, r in private.items():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want[(i, 0)] = (0, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == want
    total = sum(n for _, n, _ in want.values())
    assert len({r["sequence_id"] for r in out}) <= -(-total // 2048) + 1


def test_near_copies_by_five_words_and_four_fifths(spark, tmp_path):
    r = random.Random(3)

    def jaccard(a, b, k):
        x, y = ({tuple(t.split()[i:i + k]) for i in range(len(t.split()) - k + 1)} for t in (a, b))
        return len(x & y) / len(x | y)

    def edited(words, places):
        return " ".join(f"new{r.random()}" if i in places else w for i, w in enumerate(words))

    rows, near = [], set()
    for n in range(6):
        w = [f"w{n}x{i}" for i in range(200)]
        base = " ".join(w)
        scattered, stretch, far = edited(w, {20, 65, 110, 155}), edited(w, set(range(90, 104))), edited(w, set(range(10, 190, 30)))
        for t in (scattered, stretch):
            assert jaccard(base, t, 5) >= 0.8 and jaccard(base, t, 3) < 0.9
        assert jaccard(base, far, 5) < 0.8
        rows += [(10 * n, base), (10 * n + 1, scattered), (10 * n + 2, stretch), (10 * n + 3, far)]
        near |= {10 * n + 1, 10 * n + 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"] for r in C.drop_near_copies(spark, docs, str(tmp_path)).collect()}
    assert got == {i for i, _ in rows} - near


def test_repeated_and_null_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (3, "q")], "doc_id long, text string")
    got = C.drop_near_copies(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == [("1", "a b c d"), ("3", "q"), ("None", "a b c d")]


def test_empty_documents(spark, folder, tmp_path):
    path, _, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0

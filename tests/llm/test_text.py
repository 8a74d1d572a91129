import numpy as np
import pyarrow as pa

from webloom.llm import text as X

TEXTS = ["The  cat\tsat\n", None, "", " \n ", "the CAT", "a b é É", "x" * 70000 + " the cat sat", "\x1cq the"]


def plain(t):
    return (t or "").encode().lower().split()


def test_words_match_plain_split():
    seen = {}
    for c in X.chunks(pa.array(TEXTS)):
        w = X.words(c)
        for d in range(c.hi - c.lo):
            own = w.hash[w.first[d]:w.first[d + 1]].tolist()
            expect = plain(TEXTS[c.lo + d])
            assert len(own) == len(expect)
            for h, word in zip(own, expect, strict=True):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_windows_stay_inside_documents():
    c = next(X.chunks(pa.array(["a b c d", "b c", "", "a b c"])))
    w = X.words(c)
    h, at = X.windows(w.hash, w.first, 3)
    assert at.tolist() == [0, 1, 6]
    assert h[0] == h[2] != h[1]


def test_shingles_of_short_texts():
    c = next(X.chunks(pa.array(["a b c a b c", "a b", "", "A b"])))
    s = list(X.shingles(X.words(c), 3))
    assert [len(x) for x in s] == [3, 1, 0, 1]
    assert s[1] == s[3]


def test_chunks_cover_all_documents():
    many = pa.array(["w" * 1000] * 9000 + [None])
    parts = list(X.chunks(many))
    assert parts[0].lo == 0 and parts[-1].hi == 9001
    assert all(a.hi == b.lo for a, b in zip(parts, parts[1:]))
    assert max(len(p.data) for p in parts) <= X.CHUNK_BYTES
    assert X.bytes_of(pa.array([], pa.string()))[1].tolist() == [0]
    assert np.array_equal(X.bytes_of(many.slice(8999, 2))[1], [0, 1000, 1000])


def test_merging_slices_runs_no_job_per_partition(spark):
    from webloom.llm.common import SLICES, merge_slices, slice_rows
    sc = spark.sparkContext
    rows = spark.range(4, numPartitions=4).mapInArrow(lambda it: (slice_rows(np.arange(4 * SLICES, dtype=np.uint32)) for _ in it),
                                                      "slice int, counts binary")
    before = len(sc.statusTracker().getJobIdsForGroup(None))
    got = merge_slices(rows, 4 * SLICES)
    assert got.tolist() == (4 * np.arange(4 * SLICES)).tolist()
    assert len(sc.statusTracker().getJobIdsForGroup(None)) - before <= 3

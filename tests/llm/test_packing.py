import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from webloom.llm import packing as P
from webloom.llm.tokenize import encoder, vocabulary

VOCAB = vocabulary("byte_bpe_50k.json")


@settings(max_examples=100, deadline=None)
@given(sizes=st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_is_gapless_and_tight(sizes):
    s = np.array(sizes, np.int64)
    b, place, fill = P.best_fit(s, 64)
    for k in range(len(fill)):
        own = sorted(zip(place[b == k].tolist(), s[b == k].tolist(), strict=True))
        at = 0
        for p, n in own:
            assert p == at
            at += n
        assert at == fill[k] <= 64
    assert len(fill) <= 2 * -(-int(s.sum()) // 64) + 1
    assert sum(f <= 32 for f in fill) <= 1  # two bins up to half full would have been one


def check(rows, got, length):
    tok = encoder(VOCAB, True, 0).tokenizer
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        parts.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(parts):
            want = ids[i][at:at + r["length"]]
            assert (r["piece"], r["start"], bytes(r["ids"])) == (k, at, struct.pack(f"<{len(want)}I", *want))
            assert k == 0 or r["length"] == length
            at += r["length"]
        assert at == len(ids[i]) and len(parts) == -(-at // length)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= length
    return len(seqs), -(-sum(map(len, ids.values())) // length)


def test_pack_round_trip(docs_of):
    r = np.random.default_rng(1)
    rows = [(i, "word " * int(n)) for i, n in enumerate(r.integers(0, 90, 150))] + [(500, None), (501, ""), (502, "long text " * 300)]
    used, least = check(rows, P.pack(docs_of(rows, 6), VOCAB, length=64).collect(), 64)
    assert used <= least + 2


def test_rounds_merge_across_partitions(docs_of):
    rows = [(i, "a b c d e f g") for i in range(40)]
    used, least = check(rows, P.pack(docs_of(rows, 20), VOCAB, length=64).collect(), 64)
    assert used == least


def test_null_ids_repeats_and_empty_table(docs_of):
    got = P.pack(docs_of([(None, "a"), (1, "b c"), (1, "b c")]), VOCAB, length=64).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in got) == [(0, 2), (1, 3), (1, 3)]
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3
    assert P.pack(docs_of([]), VOCAB).count() == 0


def test_small_piece_cache_gives_the_same_pieces(docs_of):
    from webloom.llm.tokenize import Encoder
    texts = [" ".join(f"word{i * j % 83}," for j in range(1 + i % 20)) for i in range(60)]
    small = Encoder(VOCAB, True, P.END_ID, 40)
    assert [b for t in texts for b in small.encode([t])] == encoder(VOCAB, True, P.END_ID).encode(texts)
    assert 0 < len(small.cache) <= 40
    docs = docs_of(list(enumerate(texts)), 1)
    assert sorted(map(str, P.pack(docs, VOCAB, entries=40).collect())) == sorted(map(str, P.pack(docs, VOCAB).collect()))

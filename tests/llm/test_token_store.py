import functools
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from webloom.llm import token_store as S
from webloom.llm.tokenize import encoder, vocabulary

ODD = ["Hello  world", "a\n\n \nb", "tab\there", "nbsp x", "  lead", "trail  ", "\n", " ", "don't stop 1234 ñandú", "x\x1cy z",
       "<|endoftext|> a", "é" * 3000, "a" * 5000, "a \n b", "é a", "x   y", "日本 語", " a b"]


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cached_pieces_equal_whole_texts(name, spaces):
    e = encoder(vocabulary(name), spaces, 7)
    for t, got in zip(ODD, e.encode(ODD), strict=True):
        ids = e.tokenizer.encode(t, add_special_tokens=False).ids + [7]
        assert np.frombuffer(got, "<u4").tolist() == ids, t


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
@settings(max_examples=150, deadline=None)
@given(t=st.text(alphabet=st.sampled_from("ab 'sé\n\t.1 　\x1c!"), max_size=14))
def test_cached_pieces_on_random_texts(name, spaces, t):
    e = encoder(vocabulary(name), spaces, 7)
    assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids + [7]


@settings(max_examples=100, deadline=None)
@given(gaps=st.lists(st.integers(0, 5000), max_size=200))
def test_elias_fano_selects_every_value(gaps):
    v = np.cumsum(np.array(gaps, np.int64))
    e = S.EliasFano.from_bytes(S.EliasFano.of(v).to_bytes())
    assert e.select(np.arange(len(v))).tolist() == v.tolist()


def test_elias_fano_is_small():
    v = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10000))
    assert len(S.EliasFano.of(v).to_bytes()) * 8 / len(v) < 3 + np.log2(v[-1] / len(v))


@pytest.mark.parametrize("segment_ids", [1 << 20, 50])
def test_round_trip(spark, docs_of, tmp_path, segment_ids):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(900, None), (901, ""), (17_000_000_000, "last one")]
    path = vocabulary("word_bpe_49k.json")
    S.write(docs_of(rows), str(tmp_path / "s"), path, segment_ids=segment_ids)
    got = S.read(spark, str(tmp_path / "s")).orderBy("doc_id").collect()
    tok = encoder(path, False, S.END_ID).tokenizer
    start = 0
    for (i, t), r in zip(sorted(rows), got, strict=True):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        raw = struct.pack(f"<{len(ids)}I", *ids)
        assert (r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) == (i, start, len(ids), raw)
        assert zlib.crc32(bytes(r["ids"])) == zlib.crc32(raw)
        start += len(ids)


def test_null_ids_repeats_and_empty_table(spark, docs_of, tmp_path):
    path = vocabulary("word_bpe_49k.json")
    S.write(docs_of([(None, "a b"), (3, "c"), (3, "c"), (None, None)]), str(tmp_path / "a"), path)
    got = S.read(spark, str(tmp_path / "a")).collect()
    assert sorted((r["doc_id"] is None, r["start"]) for r in got)[0] == (False, 4)
    assert sorted(r["start"] + r["n_tokens"] for r in got)[-1] == sum(r["n_tokens"] for r in got) == 8
    S.write(docs_of([]), str(tmp_path / "b"), path)
    assert S.read(spark, str(tmp_path / "b")).count() == 0


@functools.cache
def _plain(name):
    """The library's tokenizer as it comes from the file."""
    return Tokenizer.from_file(vocabulary(name))


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>. z", "a  <|endoftext|>\n\nb ", "tab\t<|endoftext|> é",
           "<|EndOfText|> <|endoftext|", "don't<|endoftext|>'s", "\n <|endoftext|><|endoftext|> 12"]


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_special_tokens_in_texts_are_one_id(name, spaces):
    plain = _plain(name)
    e = encoder(vocabulary(name), spaces, 7)
    for t, got in zip(SPECIAL + ODD, e.encode(SPECIAL + ODD), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids + [7], t


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
@settings(max_examples=150, deadline=None)
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", " ", "\n", "  ", "ab", "é", "'s", "1", ".", "<|", "\t"]), max_size=9))
def test_special_tokens_on_random_texts(name, spaces, parts):
    t = "".join(parts)
    plain = _plain(name)
    assert np.frombuffer(encoder(vocabulary(name), spaces, 7).encode([t])[0], "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids + [7]

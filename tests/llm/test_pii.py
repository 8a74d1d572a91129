import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webloom.llm import pii as P

#: the contract's patterns, as plain expressions
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and 13 <= len(d) <= 19 and luhn
                    or k == 3 and 9 <= len(d) <= 15):
                out.append((k, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-1204+() \né_%", max_size=40))
def test_base_spans_equal_plain_patterns(t):
    assert sorted(P.base_spans(t)) == sorted(plain(t))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", "300.1.1.1", "5.6.7.8.9.10.11.12", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713",
                                 "a.b@c.de", "@x.y", "a@b", "a@b.c@d.e", " ", ".", "+", "-", "0", "word", "é"]), max_size=9))
def test_base_spans_on_pieces(parts):
    t = "".join(parts)
    assert sorted(P.base_spans(t)) == sorted(plain(t))


def test_long_texts_are_linear():
    for t in ("1" * 300000, "a" * 300000 + "@", "1." * 150000, "+1" * 150000, "a@" * 150000, "1 " * 150000):
        P.base_spans(t)


def test_marginals_and_viterbi_by_enumeration():
    import itertools
    r = np.random.default_rng(0)
    em = r.normal(0, 1, (4, P.TAGS))
    trans = np.where(P.ALLOWED, r.normal(0, 1, (P.TAGS, P.TAGS)), -1e4)
    score, paths = [], list(itertools.product(range(P.TAGS), repeat=4))
    for p in paths:
        s = sum(em[i, k] for i, k in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))
        score.append(s - 1e4 * (p[0] > 0 and p[0] % 2 == 0))
    score = np.array(score)
    w = np.exp(score - score.max())
    w /= w.sum()
    got = P.marginals(em[None], trans)[0][0]
    for i in range(4):
        for k in range(P.TAGS):
            assert got[i, k] == pytest.approx(sum(x for p, x in zip(paths, w, strict=True) if p[i] == k), abs=1e-6)
    assert tuple(P.viterbi(em, trans)) == paths[int(score.argmax())]


def test_gradients_by_differences():
    t, r = P.Tagger(), np.random.default_rng(1)
    x, y = r.integers(0, P.CLASSES, (3, 7)), np.zeros((3, 7), np.int64)
    y[0, 2:5] = [1, 2, 2]

    def loss():
        em, trans = t.emissions(x), t.transitions()
        own = em[np.arange(3)[:, None], np.arange(7), y].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        total = 0.0
        for e in em:
            a = e[0].copy()
            a[2::2] -= 1e4
            for i in range(1, 7):
                a = P._lse(a[:, None] + trans, 0) + e[i]
            total += P._lse(a, 0)
        return (total - own) / 3

    g = t.gradients(x, y)
    for name, at in (("E", (3, 2)), ("Wf", (5, 9)), ("Wb", (14, 30)), ("wf", (13,)), ("O", (4, 1)), ("T", (1, 2)), ("o", (0,))):
        v = t.p[name]
        old = v[at]
        v[at] = old + 1e-5
        up = loss()
        v[at] = old - 1e-5
        down = loss()
        v[at] = old
        assert g[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-4), name


TEXT = "Call +1 (017) 555-{0:04d} or mail u{0}@mail.example.com from 10.0.{1}.7 now, said the version 4.0 text."


def test_find_and_redact(docs_of):
    rows = [(i, TEXT.format(i, i % 200)) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "no data here"), (403, "x 017-555-1234 y"), (404, "é" * 50 + " a@b.cd"), (None, "a@b.cd"), (404, "é" * 50 + " a@b.cd")]
    docs = docs_of(rows)
    tagger = P.fit(docs)
    got = P.find(docs, tagger).collect()
    assert len(got) == len(rows)
    for g in got:
        t = next(t for i, t in rows if i == g["doc_id"]) or ""
        base = sorted(plain(t))
        coded = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert g["base_sha256"] == hashlib.sha256(coded.encode()).hexdigest()
        assert [g["n_email"], g["n_ip"], g["n_card"], g["n_phone"]] == [sum(k == x for k, _, _ in base) for x in range(4)]
        assert set(coded.split(",")) <= set(g["spans"].split(","))
        if g["doc_id"] in (400, 401, 402):
            assert g["spans"] == ""
    assert next(g for g in got if g["doc_id"] == 403)["spans"] in ("phone:2:14", "")
    clean = P.redact(docs, tagger)
    assert clean.schema == docs.schema
    out = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert out[7] == "Call <PHONE> or mail <EMAIL> from <IP> now, said the version 4.0 text."
    assert out[400] is None and out[402] == "no data here"


def test_tagger_learns_varied_phones(docs_of):
    rows = [(i, TEXT.format(i, i % 200)) for i in range(300)]
    tagger = P.fit(docs_of(rows))
    texts = [f"please ring 017-555-{n:04d} today at noon" for n in range(1000, 1060)]
    more = P.added_spans(texts, [P.base_spans(t) for t in texts], tagger)
    assert sum(m == [(3, 12, 24)] for m in more) >= 40
    plain_texts = ["chapter 12 of 30, page 4.2", "the year 1999 was fine", "version 3.0.1", "pay 20 now"]
    assert P.added_spans(plain_texts, [[]] * 4, tagger) == [[]] * 4


def test_empty_table_trains_nothing(docs_of):
    assert P.fit(docs_of([])) is None
    assert P.fit(docs_of([(1, None), (2, "none")])) is None
    assert P.find(docs_of([]), None).count() == 0

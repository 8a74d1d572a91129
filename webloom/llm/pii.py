"""Operator 5 - personal data by fixed patterns and a character BiLSTM-CRF.

Base spans (email, ip, card, phone) come from the patterns of the contract,
leftmost and non-overlapping per kind, in linear time.  The model adds spans to them:

* text: only stretches around a digit or ``@`` can hold one of the four kinds,
  so the tagger reads these stretches (``REACH`` characters to both sides) in
  overlapping windows of ``WINDOW`` characters
* a bidirectional LSTM over character classes and CRF transitions over
  B/I tags of the four kinds and O, trained in numpy from labelled spans: windows
  of a bounded sample of documents (``SAMPLE_DOCS`` of smallest hash among those with a
  digit or ``@``) labelled by their base spans, and the same windows with the separators of
  phones and cards varied, which the patterns no longer match
* overlapping windows are reconciled globally: their emissions are blended by distance to
  the window's edge into one sequence per stretch, which is decoded by a single Viterbi pass;
  a span is added if every tag in it has a posterior of ``SURE`` on average, it has
  the kind's form (digits, Luhn sum, ``@``), and no base span overlaps it

Offsets are code points, end exclusive.  Defined results: null and empty
texts have no span; repeated rows are read each; a null doc_id is kept; an empty table trains nothing
and adds nothing; extra columns are ignored (kept by :func:`redact`).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_share, table

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP, REACH = 64, 32, 24
HIDDEN, EMBED = 12, 10
SAMPLE_DOCS, SAMPLE_STRETCHES, SAMPLE_WINDOWS = 2000, 16, 4000
SURE = 0.65

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # (kind, start, end)


# ---- base spans ---------------------------------------------------------------------------
def _luhn(d: str) -> bool:
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every ``@`` with the run of local characters before it and the longest
    domain after it; runs are disjoint, so the scan is linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            yield a, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    if not _HINT.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        d = _DIGITS.sub("", m[0])
        if 13 <= len(d) <= 19 and _luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


# ---- the tagger -----------------------------------------------------------------------------
_SIGNS = "@.-+()/:, \n\"'=%_#*!?"
CLASSES = 5 + 10 + len(_SIGNS) + 1
TAGS = 1 + 2 * len(KINDS)
_CLASS = np.full(128, 1, np.int8)
_CLASS[97:123], _CLASS[65:91] = 2, 3
_CLASS[48:58] = np.arange(5, 15)
for _i, _c in enumerate(_SIGNS):
    _CLASS[ord(_c)] = 15 + _i
#: a tag may follow another: an I tag only its own B or I
ALLOWED = np.ones((TAGS, TAGS), bool)
for _k in range(len(KINDS)):
    ALLOWED[:, 2 + 2 * _k] = False
    ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True


def classes_of(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(c < 128, _CLASS[np.minimum(c, 127)], 4)


def tags_of(spans: list[Span], start: int, n: int) -> np.ndarray:
    """Tags of the characters start .. start+n-1."""
    t = np.zeros(n, np.int64)
    for kind, a, b in spans:
        a, b = max(a - start, 0), min(b - start, n)
        if a < b:
            t[a:b] = 2 + 2 * kind
            t[a] = 1 + 2 * kind
    return t


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Parameters of the network; arrays are (batch, time, ...)."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        h, e = HIDDEN, EMBED
        self.p = {"E": r.normal(0, .3, (CLASSES, e)), "O": r.normal(0, .2, (2 * h, TAGS)), "o": np.zeros(TAGS),
                  "T": r.normal(0, .1, (TAGS, TAGS))}
        for d in "fb":
            self.p[f"W{d}"] = r.normal(0, .3, (e + h, 4 * h))
            self.p[f"w{d}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])

    def _run(self, x: np.ndarray, d: str):
        """One direction: hidden states and what the backward pass needs."""
        n, t, _ = x.shape
        h, c, keep, out = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), [], np.empty((n, t, HIDDEN))
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = np.concatenate([x[:, i], h], 1)
            a = z @ self.p[f"W{d}"] + self.p[f"w{d}"]
            g = _sigmoid(a[:, :3 * HIDDEN])
            u = np.tanh(a[:, 3 * HIDDEN:])
            before = c
            c = g[:, HIDDEN:2 * HIDDEN] * c + g[:, :HIDDEN] * u
            s = np.tanh(c)
            h = g[:, 2 * HIDDEN:] * s
            out[:, i] = h
            keep.append((i, z, g, u, before, s))
        return out, keep

    def emissions(self, x: np.ndarray) -> np.ndarray:
        e = self.p["E"][x]
        h = np.concatenate([self._run(e, "f")[0], self._run(e, "b")[0]], 2)
        return h @ self.p["O"] + self.p["o"]

    def transitions(self) -> np.ndarray:
        return np.where(ALLOWED, self.p["T"], -1e4)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean negative log-likelihood of the tag paths ``y``."""
        n, t = x.shape
        e = self.p["E"][x]
        runs = {d: self._run(e, d) for d in "fb"}
        h = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        em = h @ self.p["O"] + self.p["o"]
        marginal, pair = marginals(em, self.transitions())
        dem = marginal
        dem[np.arange(n)[:, None], np.arange(t), y] -= 1
        dT = pair
        np.add.at(dT, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        g = {"T": dT * ALLOWED / n, "O": np.einsum("nth,ntk->hk", h, dem) / n, "o": dem.sum((0, 1)) / n}
        dh = dem @ self.p["O"].T
        de = np.zeros_like(e)
        for d, part in (("f", dh[..., :HIDDEN]), ("b", dh[..., HIDDEN:])):
            W = self.p[f"W{d}"]
            dW, dw = np.zeros_like(W), np.zeros(4 * HIDDEN)
            nh, nc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for i, z, gate, u, before, s in reversed(runs[d][1]):
                gi, gf, go = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:]
                k = part[:, i] + nh
                c = nc + k * go * (1 - s * s)
                a = np.concatenate([c * u * gi * (1 - gi), c * before * gf * (1 - gf), k * s * go * (1 - go), c * gi * (1 - u * u)], 1)
                dW += z.T @ a
                dw += a.sum(0)
                back = a @ W.T
                de[:, i] += back[:, :EMBED]
                nh, nc = back[:, EMBED:], c * gf
            g[f"W{d}"], g[f"w{d}"] = dW / n, dw / n
        g["E"] = np.zeros_like(self.p["E"])
        np.add.at(g["E"], x, de / n)
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01) -> Tagger:
        r = np.random.default_rng(3)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(p) for k, p in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for a in range(0, len(x), batch):
                i = order[a:a + batch]
                step += 1
                for k, g in self.gradients(x[i], y[i]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(em: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of every tag (n, t, k) and the summed posterior of tag pairs (k, k)."""
    n, t, k = em.shape
    start = np.zeros(k)
    start[2::2] = -1e4  # a path does not begin inside a span
    fwd, bwd = np.empty((n, t, k)), np.zeros((n, t, k))
    fwd[:, 0] = em[:, 0] + start
    for i in range(1, t):
        fwd[:, i] = _lse(fwd[:, i - 1, :, None] + trans, 1) + em[:, i]
    for i in range(t - 2, -1, -1):
        bwd[:, i] = _lse(trans + (em[:, i + 1] + bwd[:, i + 1])[:, None, :], 2)
    z = _lse(fwd[:, -1], 1)
    pair = np.zeros((k, k))
    for i in range(t - 1):
        pair += np.exp(fwd[:, i, :, None] + trans + (em[:, i + 1] + bwd[:, i + 1])[:, None, :] - z[:, None, None]).sum(0)
    return np.exp(fwd + bwd - z[:, None, None]), pair


def viterbi(em: np.ndarray, trans: np.ndarray) -> np.ndarray:
    t, k = em.shape
    best = em[0].copy()
    best[2::2] -= 1e4
    back = np.zeros((t, k), np.int64)
    for i in range(1, t):
        s = best[:, None] + trans
        back[i] = s.argmax(0)
        best = s.max(0) + em[i]
    path = np.empty(t, np.int64)
    path[-1] = best.argmax()
    for i in range(t - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


# ---- windows and decoding ----------------------------------------------------------------------
def stretches(text: str) -> list[tuple[int, int]]:
    """Maximal ranges within REACH characters of a digit or ``@``."""
    out: list[list[int]] = []
    for m in _HINT.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _window_starts(n: int) -> list[int]:
    return list(range(0, max(n - WINDOW, 0) + STEP, STEP)) if n > WINDOW else [0]


def added_spans(texts: list[str], bases: list[list[Span]], tagger: Tagger, batch: int = 512) -> list[list[Span]]:
    """Spans that the tagger adds to the base spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    trans = tagger.transitions()
    weight = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    todo: list[tuple[int, int, int]] = []

    def decode():
        wins, where = [], []
        for k, (i, a, b) in enumerate(todo):
            c = classes_of(texts[i][a:b])
            for s in _window_starts(len(c)):
                w = np.zeros(WINDOW, np.int64)
                part = c[s:s + WINDOW]
                w[:len(part)] = part
                wins.append(w)
                where.append((k, s, len(part)))
        em = np.concatenate([tagger.emissions(np.array(wins[j:j + batch])) for j in range(0, len(wins), batch)])
        total = [np.zeros((b - a, TAGS)) for _, a, b in todo]
        mass = [np.zeros(b - a) for _, a, b in todo]
        for (k, s, n), e in zip(where, em, strict=True):
            total[k][s:s + n] += e[:n] * weight[:n, None]
            mass[k][s:s + n] += weight[:n]
        for k, (i, a, _) in enumerate(todo):
            e = total[k] / mass[k][:, None]
            path = viterbi(e, trans)
            if not path.any():
                continue
            sure = marginals(e[None], trans)[0][0]
            for kind, p, q in _runs(path):
                span = (kind, a + p, a + q)
                if (sure[np.arange(p, q), path[p:q]].mean() >= SURE and _plausible(texts[i][a + p:a + q], kind)
                        and not any(x < span[2] and y > span[1] for _, x, y in bases[i])):
                    out[i].append(span)
        todo.clear()

    chars = 0
    for i, t in enumerate(texts):
        for a, b in stretches(t):
            todo.append((i, a, b))
            chars += b - a
            if chars > 1 << 17:
                decode()
                chars = 0
    if todo:
        decode()
    return out


def _runs(path: np.ndarray) -> Iterator[tuple[int, int, int]]:
    begin = np.flatnonzero(path % 2 == 1)
    for p in begin.tolist():
        kind = (int(path[p]) - 1) // 2
        q = p + 1
        while q < len(path) and path[q] == 2 + 2 * kind:
            q += 1
        yield kind, p, q


def _plausible(s: str, kind: int) -> bool:
    number = _DIGITS.sub("", s)
    digits = len(number)
    if kind == 0:
        return "@" in s and 0 < s.index("@") < len(s) - 3
    if kind == 1:
        return s.count(".") == 3 and 4 <= digits <= 12
    if kind == 2:
        return 13 <= digits <= 19 and _luhn(number)
    return 7 <= digits <= 15


def _varied(text: str, spans: list[Span], r: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with the separators of its phones and cards replaced."""
    out, new, at = [], [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        s = text[a:b]
        if kind == 3:
            d = _DIGITS.sub("", s)
            sep = ". -/"[r.integers(4)]
            s = f"{d[-10:-7]}{sep}{d[-7:-4]}{sep}{d[-4:]}" if r.random() < .6 else f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}"
        elif kind == 2:
            d = _DIGITS.sub("", s)
            sep = "./ -"[r.integers(4)]
            s = sep.join(d[i:i + 4] for i in range(0, len(d), 4))
        out += [text[at:a], s]
        begin = sum(map(len, out)) - len(s)
        new.append((kind, begin, begin + len(s)))
        at = b
    return "".join([*out, text[at:]]), new


def training_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags from the base spans of the texts, as found and varied."""
    r = np.random.default_rng(9)
    x, y = [], []
    for text in texts:
        for part in (text[i:i + 4 * WINDOW] for i in range(0, len(text), 4 * WINDOW)):
            spans = base_spans(part)
            for t, s in ((part, spans), _varied(part, spans, r)) if any(k >= 2 for k, _, _ in spans) else ((part, spans),):
                c = classes_of(t)
                for w in _window_starts(len(c)):
                    row = np.zeros(WINDOW, np.int64)
                    row[:len(c[w:w + WINDOW])] = c[w:w + WINDOW]
                    x.append(row)
                    y.append(tags_of(s, w, WINDOW))
            if len(x) >= SAMPLE_WINDOWS:
                return np.array(x), np.array(y)
    return np.array(x).reshape(-1, WINDOW), np.array(y).reshape(-1, WINDOW)


def _sample_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of a sampled text, at most ``SAMPLE_STRETCHES`` of each, by hash."""
    for b in batches:
        near = [s for t in b.column(0).to_pylist() for s in sorted((t[x:y] for x, y in stretches(t)), key=_lot)[:SAMPLE_STRETCHES]]
        yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["near"])


def _lot(text: str) -> bytes:
    """A text's place in a drawing that favours no beginning, length or position."""
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def fit(docs: DataFrame, text_col: str = "text") -> Tagger | None:
    """Train on the bounded sample; None without a text that holds a digit or ``@``."""
    found = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    total = found.count()
    rows = (found.where(hash_share("text", SAMPLE_DOCS, total))
            .mapInArrow(_sample_rows, "near string").distinct().collect())
    texts = sorted((r["near"] for r in rows), key=lambda t: (_lot(t), t))
    x, y = training_windows(texts)
    return Tagger().fit(x, y) if len(x) else None


# ---- rows ------------------------------------------------------------------------------------------
def _coded(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _spans_of(texts: list[str | None], tagger: Tagger | None) -> tuple[list[list[Span]], list[list[Span]]]:
    plain = [t or "" for t in texts]
    base = [base_spans(t) for t in plain]
    more = added_spans(plain, base, tagger) if tagger else [[] for _ in plain]
    return base, more


_FOUND = ("id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def _find_rows(batches: Iterable[pa.RecordBatch], tagger) -> Iterator[pa.RecordBatch]:
    for b in batches:
        base, more = _spans_of(b.column(1).to_pylist(), tagger.value)
        counts = [[sum(k == kind for k, _, _ in s) for s in base] for kind in range(4)]
        sha = [hashlib.sha256(_coded(s).encode()).hexdigest() for s in base]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string()),
             pa.array([_coded(s + m) for s, m in zip(base, more, strict=True)], pa.string()),
             pa.array([len(m) for m in more], pa.int64())],
            [c.split()[0] for c in _FOUND.split(", ")])


def find(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans per kind, their digest, and all spans of every row."""
    bc = docs.sparkSession.sparkContext.broadcast(tagger)
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(lambda it: _find_rows(it, bc), _FOUND).withColumnRenamed("id", id_col))


def redact(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """Every row with its spans replaced by ``<KIND>``; other columns unchanged."""
    bc = docs.sparkSession.sparkContext.broadcast(tagger)
    at = docs.columns.index(text_col)

    def rows(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            base, more = _spans_of(texts, bc.value)
            clean = [None if t is None else _masked(t, s + m) for t, s, m in zip(texts, base, more, strict=True)]
            cols = list(b.columns)
            cols[at] = pa.array(clean, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return docs.mapInArrow(rows, docs.schema)


def _masked(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find(docs, fit(docs))

"""Operator 7 - main text of pages by a tree-structured graphical model.

A page is cut into tags and texts, the block elements form the tree.  Every
block element v has a variable x_v (content or not) with

* a unary potential: a log-linear score of its tag, the words of its class, id
  and role, its link density, text length and sentence marks
* a potential for each parent-child edge by the two tags, with a shared default

One sum-product pass upward and one downward give the exact marginal of every node; a text
block is kept when its element's marginal is at least 1/2.  Script, style, head and other
unseen elements carry no text at all.

Training (numpy-free, a few thousand nodes, on the driver) maximises the likelihood
of labelled trees by AdaGrad with the exact marginals.  Labelled pages are (a) a bounded sample
(``SAMPLE`` pages of smallest hash) of the table's pages that mark their article themselves with
``<article>`` or ``<main>``, and (b) ``LAYOUTS`` generated layouts whose article, menus, adverts,
notices, forms, sidebars and comments are known, for pages without such marks.

Defined results: null and empty html give the empty text; text outside any tag belongs to
the root; unclosed and stray tags are repaired as browsers do in the common cases (paragraphs,
list items, table cells, a head without its end tag); a page without content gives the empty text; repeated
rows are extracted each; null keys are kept; extra columns are ignored.
"""

from __future__ import annotations

import html as H
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_share, table

#: marked pages and generated layouts to train on; a marked page is shorter than this
SAMPLE, LAYOUTS = 150, 250
LONGEST_SAMPLE = 1 << 17

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video select option textarea "
                   "button datalist".split())
#: any other start tag, and any text, ends an open head
IN_HEAD = frozenset("title meta link base basefont bgsound style script noscript noframes template head".split())
RAW = frozenset("script style textarea title noscript iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr br img ruby rt rp input".split())
#: a start tag ends an open element of these names
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}
SCOPE = frozenset("table ul ol dl html body article section div main aside nav form td th blockquote header footer".split())


class Node:
    __slots__ = ("tag", "words", "parent", "chars", "linked", "marks", "label")

    def __init__(self, tag: str, words: tuple[str, ...], parent: int):
        self.tag, self.words, self.parent = tag, words, parent
        self.chars = self.linked = self.marks = 0
        self.label = 0


def _attributes(raw: str) -> tuple[str, ...]:
    if "=" not in raw:
        return ()
    found = [x or y or z for _, x, y, z in _ATTRIBUTE.findall(raw)]
    return tuple(dict.fromkeys(w.lower() for v in found for w in _WORD.findall(v)))


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """(block elements in document order, text blocks as (element, text))."""
    nodes = [Node("#root", (), -1)]
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements and their block element
    run: list[str] = []
    hidden, links, at, owner = 0, 0, 0, 0

    def flush():
        if run:
            text = " ".join("".join(run).split())
            if text:
                blocks.append((owner, text))
            run.clear()

    def text(a, b):
        if stack[-1][0] == "head" and a < b and not page[a:b].isspace():
            end_head()
        if a < b and not hidden:
            s = H.unescape(page[a:b])
            run.append(s)
            n = len(s) - s.count(" ")
            nodes[owner].chars += n
            nodes[owner].marks += s.count(".") + s.count(",") + s.count("?") + s.count("!")
            if links:
                nodes[owner].linked += n

    def pop():
        nonlocal hidden, links, owner
        tag, _ = stack.pop()
        if tag in UNSEEN:
            hidden -= 1
        if tag == "a":
            links -= 1
        if tag not in INLINE:
            flush()
        owner = stack[-1][1]

    def end_head():
        while stack[-1][0] == "head":
            pop()

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            break
        text(at, m.start())
        at = m.end()
        closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in SCOPE and tag not in SCOPE:
                    break
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            end_head()
        if tag in VOID:
            if tag in ("br", "hr") and not hidden:
                run.append(" ")
            continue
        if tag not in INLINE:
            flush()
            names = CLOSES.get(tag, ("p",) if tag not in UNSEEN else ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in SCOPE and stack[k][0] not in names:
                    break
        if raw.endswith("/") and tag in UNSEEN:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in UNSEEN:
            hidden += 1
        if tag == "a":
            links += 1
        if tag not in INLINE:
            nodes.append(Node(tag, _attributes(raw), owner))
            owner = len(nodes) - 1
        stack.append((tag, owner))
    if at < end:
        text(at, end)
    flush()
    return nodes, blocks


# ---- the model ---------------------------------------------------------------------------------
def features(nodes: list[Node]) -> list[list[str]]:
    """Unary features of every node; text measures cover the whole subtree."""
    n = len(nodes)
    chars, linked, marks = ([getattr(v, a) for v in nodes] for a in ("chars", "linked", "marks"))
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        linked[p] += linked[i]
        marks[p] += marks[i]
    out = []
    for i, v in enumerate(nodes):
        c = chars[i]
        share = linked[i] / c if c else 0.0
        out.append(["bias", "t:" + v.tag, f"l:{min(int(share * 4), 3)}", f"n:{min(c, 4095).bit_length()}",
                    f"m:{min(int(100 * marks[i] / c), 4) if c else 9}", *["w:" + w for w in v.words]])
    return out


def _soft(x: float) -> float:
    """log(1 + e^x)"""
    return x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))


class Model:
    """Weights by feature; edges by (parent tag, child tag): the log-potentials of
    (0,1), (1,0) and (1,1) against (0,0)."""

    def __init__(self):
        self.w: dict[str, float] = defaultdict(float)
        self.edge: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
        self.edge[("*", "*")] = [-2.0, -2.0, 0.0]

    def _potential(self, p: str, c: str) -> tuple[float, float, float]:
        base, own = self.edge[("*", "*")], self.edge.get((p, c))
        return tuple(base) if own is None else (base[0] + own[0], base[1] + own[1], base[2] + own[2])

    def infer(self, nodes: list[Node], feats: list[list[str]]):
        """Log-odds of every marginal, and what the edge marginals need."""
        w = self.w
        up = [sum(w[f] for f in fs if f in w) for fs in feats]
        n = len(nodes)
        message, pots = [0.0] * n, [(0.0, 0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            v = nodes[i]
            a01, a10, a11 = pots[i] = self._potential(nodes[v.parent].tag, v.tag)
            b = up[i]
            message[i] = a10 + _soft(a11 - a10 + b) - _soft(a01 + b)
            up[v.parent] += message[i]
        total, cavity = up[:], [0.0] * n
        for i in range(1, n):
            a01, a10, a11 = pots[i]
            c = cavity[i] = total[nodes[i].parent] - message[i]
            total[i] = up[i] + a01 + _soft(a11 - a01 + c) - _soft(a10 + c)
        return total, up, cavity, pots

    def fit(self, pages: list[list[Node]], epochs: int = 12, rate: float = 0.4, l2: float = 1e-3) -> Model:
        feats = [features(p) for p in pages]
        seen: dict = defaultdict(lambda: 1e-2)
        order, r = list(range(len(pages))), random.Random(1)

        def step(table, key, grad, k=None):
            name = (key, k)
            seen[name] += grad * grad
            d = rate * grad / math.sqrt(seen[name])
            if k is None:
                table[key] += d
            else:
                table[key][k] += d

        for _ in range(epochs):
            r.shuffle(order)
            for j in order:
                nodes = pages[j]
                total, up, cavity, pots = self.infer(nodes, feats[j])
                gw: dict[str, float] = defaultdict(float)
                ge: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
                for i, v in enumerate(nodes):
                    g = v.label - 1 / (1 + math.exp(-max(-30.0, min(30.0, total[i]))))
                    for f in feats[j][i]:
                        gw[f] += g
                    if not i:
                        continue
                    a01, a10, a11 = pots[i]
                    s = (0.0, a01 + up[i], a10 + cavity[i], a11 + cavity[i] + up[i])
                    top = max(s)
                    e = [math.exp(x - top) for x in s]
                    z = sum(e)
                    now = 2 * nodes[v.parent].label + v.label
                    for key in (("*", "*"), (nodes[v.parent].tag, v.tag)):
                        for k in (1, 2, 3):
                            ge[key][k - 1] += (now == k) - e[k] / z
                for f, g in gw.items():
                    step(self.w, f, g - l2 * self.w[f])
                for key, gs in ge.items():
                    for k, g in enumerate(gs):
                        step(self.edge, key, g - l2 * self.edge[key][k], k)
        return self

    def frozen(self) -> Model:
        """A copy that pickles (plain dictionaries)."""
        out = Model()
        out.w, out.edge = dict(self.w), dict(self.edge)
        return out


def extract(page: str | None, model: Model) -> str:
    """Main text of one page."""
    if not page:
        return ""
    nodes, blocks = parse(page)
    odds = model.infer(nodes, features(nodes))[0]
    return " ".join(t for i, t in blocks if odds[i] >= 0)


# ---- labelled pages ------------------------------------------------------------------------------
NOISE_TAGS = frozenset("nav aside footer form header dialog menu".split())
NOISE_WORDS = frozenset("ad ads advert advertisement sponsor sponsored promo banner cookie consent notice nav navigation menu "
                        "breadcrumb breadcrumbs sidebar side widget footer header masthead comment comments respond reply "
                        "discussion share social related recommended newsletter subscribe signup login search popup modal "
                        "toolbar pagination pager tags copyright".split())


def _is_noise(v: Node) -> bool:
    return v.tag in NOISE_TAGS or not NOISE_WORDS.isdisjoint(v.words)


def label_marked(nodes: list[Node]) -> list[Node] | None:
    """Labels of a page that marks its article itself; None for other pages."""
    if not any(v.tag in ("article", "main") for v in nodes):
        return None
    for i, v in enumerate(nodes):
        inside = v.tag in ("article", "main") or i > 0 and nodes[v.parent].label == 1
        v.label = int(inside and not _is_noise(v))
    return nodes


def layouts(n: int = LAYOUTS, seed: int = 3) -> Iterator[list[Node]]:
    """Generated pages of common layouts with known article elements (class word
    ``keep`` marks them while the page is built and is removed after parsing)."""
    r = random.Random(seed)
    words = ["".join(r.choice("aeiou" if i % 2 else "bcdfglmnprst") for i in range(r.randint(2, 9))) for _ in range(300)]

    def prose(k):
        return " ".join(r.choice(words) for _ in range(k)).capitalize() + "."

    def paragraphs(keep):
        k = ' class="keep"' if keep else ""
        out = []
        for _ in range(r.randint(1, 6)):
            kind = r.random()
            body = " ".join(prose(r.randint(3, 25)) for _ in range(r.randint(1, 4)))
            if kind < .75:
                out.append(f"<p{k}>{body}</p>")
            elif kind < .85:
                out.append(f"<ul{k}>" + "".join(f"<li{k}>{prose(5)}</li>" for _ in range(3)) + "</ul>")
            elif kind < .92:
                out.append(f"<h2{k}>{prose(4)}</h2><p{k}>{body}</p>")
            else:
                out.append(f"<blockquote{k}><p{k}>{body}</p></blockquote>")
        return "".join(out)

    def links(k=5):
        return "<ul>" + "".join(f"<li><a href='#'>{r.choice(words)}</a></li>" for _ in range(k)) + "</ul>"

    def noise():
        name = r.choice(sorted(NOISE_WORDS))
        tag = r.choice(["div", "section", "aside", "div", "ul" if name in ("menu", "nav") else "div"])
        attr = f'{r.choice(["class", "id", "role"])}="{r.choice(["", "site-", "main-", "page "])}{name}"'
        inner = r.choice([links(r.randint(2, 8)), f"<p>{prose(r.randint(2, 12))}</p>", paragraphs(False),
                          prose(r.randint(2, 9)), f"<h3>{prose(2)}</h3>{links(3)}"])
        if tag == "ul":
            return f"<ul {attr}>{links(4)[4:]}"
        return f"<{tag} {attr}>{inner}</{tag}>"

    def bare():
        return r.choice([f"<nav>{links()}</nav>", f"<header><p>{prose(4)}</p>{links(3)}</header>", f"<footer><p>{prose(8)}</p></footer>",
                         f"<aside>{paragraphs(False)}</aside>", f"<aside><h3>{prose(2)}</h3>{links(4)}</aside>",
                         f"<form><p>{prose(3)}</p><div>{prose(2)}</div></form>", f"<footer>{links(3)}</footer>"])

    for _ in range(n):
        before = "".join(r.choice([bare, noise])() for _ in range(r.randint(0, 3)))
        after = "".join(r.choice([bare, noise])() for _ in range(r.randint(0, 3)))
        inside = "".join(r.choice([noise, noise, bare])() for _ in range(r.choice([0, 0, 1, 2])))
        tag = r.choice(["article", "main", "div", "div", "section"])
        name = r.choice(["content", "post", "entry", "story", "article body", "text", "main", "post content", ""])
        head = f"<h1 class='keep'>{prose(5)}</h1>" if r.random() < .8 else ""
        body = f"<{tag} class='keep {name}'>{head}{paragraphs(True)}{inside}{paragraphs(True) if inside else ''}</{tag}>"
        if r.random() < .4:
            body = f"<div id='{r.choice(['wrapper', 'page', 'container', 'root'])}'>{before}{body}{after}</div>"
        else:
            body = before + body + after
        nodes, _ = parse(f"<html><body>{body}</body></html>")
        for v in nodes:
            v.label = int("keep" in v.words)
            v.words = tuple(w for w in v.words if w != "keep")
        yield nodes


def fit(pages: DataFrame, html_col: str = "html") -> Model:
    """Train on generated layouts and a bounded sample of self-marked pages."""
    found = pages.select(F.col(html_col).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    total = found.count()
    got = (found.where(hash_share("html", SAMPLE, total) & (F.length("html") < LONGEST_SAMPLE)).distinct()
           .orderBy(F.xxhash64("html"), "html").limit(2 * SAMPLE).collect())
    marked = [label_marked(parse(r["html"])[0]) for r in got]
    return Model().fit([*layouts(), *[m for m in marked if m]]).frozen()


_TEXT = "page_id long, url string, text string, n_chars long"


def _rows(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [extract(h, model.value) for h in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [c.split()[0] for c in _TEXT.split(", ")])


def main_text(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    bc = pages.sparkSession.sparkContext.broadcast(model)
    return (pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col))
            .mapInArrow(lambda it: _rows(it, bc), _TEXT).withColumnsRenamed({"page_id": id_col, "url": url_col}))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages))

import html as H
import itertools
import math
import random

import pytest

from webloom.llm import main_text as M

PAGE = "page_id long, url string, html string, text string, n_chars int"


@pytest.fixture(scope="module")
def model():
    return M.Model().fit(list(M.layouts())).frozen()


def test_marginals_by_enumeration():
    m, r = M.Model(), random.Random(2)
    tags = ["div", "p", "ul", "li"]
    nodes = [M.Node("#root", (), -1)] + [M.Node(r.choice(tags), (), r.randrange(i)) for i in range(1, 8)]
    feats = M.features(nodes)
    for f in {f for fs in feats for f in fs}:
        m.w[f] = r.gauss(0, 1)
    for p, c in itertools.product(["#root", *tags], tags):
        m.edge[(p, c)] = [r.gauss(0, 1) for _ in range(3)]
    total = m.infer(nodes, feats)[0]
    mass = [0.0] * len(nodes)
    z = 0.0
    for x in itertools.product((0, 1), repeat=len(nodes)):
        s = sum(m.w[f] for i, fs in enumerate(feats) if x[i] for f in fs)
        for i, v in enumerate(nodes[1:], 1):
            a = m._potential(nodes[v.parent].tag, v.tag)
            s += (0.0, *a)[2 * x[v.parent] + x[i]]
        e = math.exp(s)
        z += e
        for i, b in enumerate(x):
            mass[i] += e * b
    for i in range(len(nodes)):
        assert 1 / (1 + math.exp(-total[i])) == pytest.approx(mass[i] / z, abs=1e-9)


def test_held_out_layouts(model):
    good = every = 0
    for nodes in M.layouts(150, seed=77):
        odds = model.infer(nodes, M.features(nodes))[0]
        for v, o in zip(nodes, odds, strict=True):
            if v.chars:
                every += 1
                good += (o >= 0) == bool(v.label)
    assert good >= 0.96 * every


@pytest.mark.parametrize("page, blocks", [
    ("<p>a<p>b", ["a", "b"]),
    ("x<script>var p='<p>no</p>'</script>y<style>p{}</style>", ["x", "y"]),
    ("<p title='a>b'>t&eacute; &#8217;&amp;amp; <b>bo</b>ld<br>next</p>", ["té ’&amp; bold next"]),
    ("<ul><li>1<li>2<ul><li>3</ul>tail</ul>end", ["1", "2", "3", "tail", "end"]),
    ("<table><tr><td>x<td>y<tr><td>z</table>", ["x", "y", "z"]),
    ("a<!-- <p>no</p> -->b <![CDATA[no]]>c", ["ab c"]),
    ("<div>one<p>two</p>three</div></p></div>four", ["one", "two", "three", "four"]),
    ("<p>1 < 2 and <unclosed", ["1 < 2 and"]),
    ("<select><option>no</select><button>no</button><p>yes", ["yes"]),
    ("<title>t</title><script>never closed <p>x", []),
    ("", []),
])
def test_blocks(page, blocks):
    assert [t for _, t in M.parse(page)[1]] == blocks


def test_long_pages_are_linear(model):
    for page in ("<div>" * 20000 + "x", "<p>a</p>" * 20000, "<" * 50000, "<b>" * 20000 + "t", "&" * 50000):
        M.extract(page, model)


def test_article_of_unmarked_page(model):
    page = ("<div class='cookie-notice'>We use cookies, and accept.</div><header><p>Site name</p></header><div id='content'>"
            "<h1>Title here</h1><p>First part with text, and more words to say.</p><p>Second part.<br>More &amp; more</p>"
            "<div class='advert'>Buy now</div><p>Third <b>bold</b>, and more.</p></div><div id='comments'><div class='comment'>"
            "<p>Nice post, I like it.</p></div></div><aside class='sidebar'><p>About the author.</p></aside><form><p>Subscribe</p></form>")
    assert M.extract(page, model) == ("Title here First part with text, and more words to say. Second part. More & more "
                                      "Third bold, and more.")


def test_rows(spark):
    words = [f"word{i}" for i in range(200)]
    r = random.Random(5)

    def page(k):
        body = [" ".join(r.choices(words, k=12)) + ", & so on." for _ in range(k)]
        return body, ("<html><head><title>no</title></head><body><nav><ul><li><a href='/x'>menu</a></li></ul></nav><div class='ad'>buy</div>"
                      "<article><h1>Head</h1>" + "".join(f"<p>{H.escape(b)}</p>" for b in body) + "</article><footer>&copy; us</footer>")

    made = [page(1 + i % 5) for i in range(40)]
    rows = [(i, f"u{i}", h, "x", 1) for i, (_, h) in enumerate(made)]
    rows += [(100, None, None, "x", 1), (101, "", "", "x", 1), (None, "u", made[0][1], "x", 1), (0, "u0", made[0][1], "x", 1)]
    df = spark.createDataFrame(rows, PAGE).repartition(3)
    got = M.main_text(df, M.fit(df)).collect()
    assert len(got) == len(rows)
    for g in got:
        want = "" if g["page_id"] in (100, 101) else " ".join(["Head", *made[g["page_id"] or 0][0]])
        assert (g["text"], g["n_chars"]) == (want, len(want))
    empty = spark.createDataFrame([], PAGE)
    assert M.main_text(empty, M.fit(empty)).count() == 0


@pytest.mark.parametrize("page, blocks", [
    ("<html><head><title>no</title><meta charset=x><body><p>yes</p></body></html>", ["yes"]),
    ("<head><link rel=x><style>no</style><script>no</script><p>a<p>b", ["a", "b"]),
    ("<html><head><title>no</title>plain text <b>bold</b>", ["plain text bold"]),
    ("<head><template><p>no</p></template><noscript>no</noscript><h1>yes</h1>", ["yes"]),
    ("<head><head><title>no</title></head><body><div>yes</div>", ["yes"]),
    ("<html><head>\n <title>no</title>\n</head>\n<body><p>yes</p></body></html>", ["yes"]),
])
def test_head_without_end_tag(page, blocks):
    assert [t for _, t in M.parse(page)[1]] == blocks


def test_article_of_page_without_head_end(model):
    body = "<body><article><h1>Title here</h1><p>First part with text, and more words to say.</p></article></body></html>"
    want = "Title here First part with text, and more words to say."
    for head in ("<html><head><title>no</title></head>", "<html><head><title>no</title>"):
        assert M.extract(head + body, model) == want

"""Element intervals and entity decoding against the standard library."""

import html as std
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.tree import parse_tree, select
from webloom.functions import html as H
from webloom.operators import extract as X

PAGE = "page_id long, url string, html string"


def pages(spark, htmls):
    return spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(htmls)], PAGE)


def random_page(rng, depth=0):
    """Lists and tables inside each other, some end tags left out where html allows it."""
    def words():
        return " ".join(rng.choice(["a", "b", "c &lt; d", "<i>e</i> f", "<br>"]) for _ in range(rng.randint(0, 3)))

    def inner():
        return words() + (random_page(rng, depth + 1) if depth < 3 and rng.random() < 0.45 else "") + rng.choice(["", words()])

    out = []
    for _ in range(rng.randint(1, 3)):
        kind = rng.choice(["ul", "ol", "table", "div", "text"])
        if kind in ("ul", "ol"):
            items = "".join(f"<li>{inner()}" + rng.choice(["</li>", "</LI >"]) for _ in range(rng.randint(0, 3)))
            out.append(f"<{kind} class='x'>{items}</{kind}>")
        elif kind == "table":
            rows = "".join("<tr>" + "".join(f"<{c}>{inner()}</{c}>" for c in rng.choices(["td", "th"], k=rng.randint(0, 3))) + "</tr>"
                           for _ in range(rng.randint(0, 3)))
            out.append(f"<table>{rows}</table>")
        elif kind == "div":
            out.append(f"<div class='{rng.choice(['x', 'y x', 'z'])}'>{inner()}</div>")
        else:
            out.append(f"<p>{words()}</p>")
    return "".join(out)


@pytest.fixture(scope="module")
def nested(spark):
    rng = random.Random(11)
    return [random_page(rng) for _ in range(150)]


def test_tables_and_lists_equal_the_tree(spark, nested):
    got = {r.page_id: r for r in X.page_records(pages(spark, nested)).collect()}
    for i, h in enumerate(nested):
        tables, lists = parse_tree(h)
        assert (got[i].tables, got[i].lists.ul, got[i].lists.ol) == (tables, lists["ul"], lists["ol"]), h
    assert sum(len(parse_tree(h)[0]) for h in nested) > 100


def test_long_tables_are_the_records(spark, nested):
    cells = {}
    for r in X.cells(pages(spark, nested)).collect():
        cells[r.page_id, r.table_no, r.row_no, r.col_no] = r.text
    want = {(i, a, b, c): x for i, h in enumerate(nested) for a, t in enumerate(parse_tree(h)[0])
            for b, row in enumerate(t) for c, x in enumerate(row)}
    assert cells == want


@pytest.mark.parametrize(("selector", "tag", "cls"), [("div", "div", None), (".x", None, "x"), ("div.x", "div", "x"), ("li", "li", None),
                                                      ("td", "td", None), ("table", "table", None), ("tr", "tr", None), ("ul.x", "ul", "x")])
def test_selectors_equal_the_tree(spark, nested, selector, tag, cls):
    got = {r.page_id: r.selected_text for r in X.selector_text(pages(spark, nested), selector).collect()}
    assert got == {i: select(h, tag, cls) for i, h in enumerate(nested)}


OMITTED = [
    ("<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>", [], ["a", "bcd", "e", "c", "d"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", [[["1", "2"], ["3"]]], []),
    ("<table><tbody><tr><td>1<ul><li>x</td><td>2</tr></tbody><tbody><tr><th>3</table><ul><li>y</ul>", [[["1x", "2"], ["3"]]], ["x", "y"]),
    ("<ul><li><table><tr><td><ul><li>x</td></tr></table><li>y</ul>z", [[["x"]]], ["x", "y", "x"]),
    ("<ul><li>a" + "<b>" * 3000 + "b<ul><li>c</ul></ul><table><tr><td>" + "<b>" * 3000 + "t</table>", [[["t"]]], ["abc", "c"]),
    ("</ul></table><li>out<ul><li>in", [], ["in"]),
    ("<td>no table</td><table><tr><td>t</table><tr><td>x", [[["t"]]], []),
]


def test_omitted_and_stray_tags(spark):
    got = {r.page_id: (r.tables, r.lists.ul) for r in X.page_records(pages(spark, [h for h, _, _ in OMITTED])).collect()}
    assert got == {i: (t, u) for i, (_, t, u) in enumerate(OMITTED)}


def test_nested_selector_targets(spark):
    html = ["<div class=ad>a<div>b</div>c</div>d", "<p class=q>a<div>b</div></p>c<p class=q>d", "<ul><li class=q>a<li>b</ul>", "<br class=q>x",
            "<span class=q>open", "none", None]
    p = pages(spark, html)
    assert [r.selected_text for r in X.selector_text(p, "div.ad").orderBy("page_id").collect()][0] == "abc"
    assert [r.selected_text for r in X.selector_text(p, ".q").orderBy("page_id").collect()] == ["", "a d", "a", "", "open", "", ""]


def test_entities_equal_the_standard_library(spark):
    rng = random.Random(4)
    names = sorted(std.entities.html5)
    texts = ["&amp;lt;", "&#8217;", "&eacute;", "&#x41;", "T&uuml;r", "&notit;", "&notin;", "&", "&&amp;&", "&#", "&#x", "&#xg;", "&#0;", "&#x80;", "&#129;",
             "&#xD800;", "&#1114112;", "&#99999999999999999999;", "&#x110000;", "&#11;", "&#13;", "&#12;", "&#x1F600;", "&#65533", "&#127;",
             "&AMP", "&ampx", "&lt", "&ltfoo;", "&CounterClockwiseContourIntegral;", "&nosuch;", "&#00065;", "&#x00041;", "&fjlig;", "&Tab;|", "&#xfffe;"]
    for _ in range(400):
        texts.append("".join(rng.choice(["&", ";", "x", " ", "#", "&" + rng.choice(names), "&" + rng.choice(names)[:-1], f"&#{rng.randint(0, 70000)};",
                                         f"&#x{rng.randint(0, 0x11ffff):x}", "amp;", "é"]) for _ in range(rng.randint(1, 9))))
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = {r.i: r.d for r in df.select("i", H.decode_entities(H.settle_references("t")).alias("d")).collect()}
    assert [(t, got[i]) for i, t in enumerate(texts)] == [(t, std.unescape(t)) for t in texts]


def test_tags_equal_the_plain_patterns(spark):
    """The patterns that begin at '<' find the same markup as one alternative after the other, and each tag's name with it."""
    rest = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
    tag = rf"</?[A-Za-z]{rest}|</?[A-Za-z][^>]*+(?:>|\z)|<[!?][^>]*+(?:>|\z)"
    skip = "(?is)" + "|".join([*(rf"<{t}\b[^>]*+(?:>|\z){H._until(rf'</{t}[^a-z0-9>]*+>')}" for t in ("script", "style", "template")),
                               r"<!--(?:[^-]++|-(?!->))*+(?:-->|\z)", r"<!doctype[^>]*+(?:>|\z)"])
    rng = random.Random(6)
    bits = ["<", ">", "/", '"', "'", "a", "td", "TD", " ", "\n", "=", "!", "?", "--", "-->", "<!--", "<td", "</td", "<b x='", '<i y="', "<li", "</LI\t>",
            "<script", "</script>", "<STYLE>", "</style >", "<!DOCTYPE", "<template>", "</template", "é", "\r", "\x0b"]
    texts = [None, "", '<td"x>y">', "<td'>", "</td"] + ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(20_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(4)

    def found(pattern, group=0):
        return F.regexp_extract_all("t", F.lit(pattern), F.lit(group))

    names = F.transform(found(tag), lambda t: F.regexp_extract(t, r"^<(/?[A-Za-z][^\s/>]*)", 1))
    unquoted = F.transform(names, lambda n: F.when(n.rlike("[\"']"), "").otherwise(n))
    same = [found(tag).eqNullSafe(found(H.TAG_RE)), F.split("t", tag, -1).eqNullSafe(F.split("t", H.TAG_RE, -1)),
            unquoted.eqNullSafe(found(H.TAG_RE, 1)), F.regexp_replace("t", skip, "<x>").eqNullSafe(F.regexp_replace("t", H.SKIP_RE, "<x>"))]
    assert [df.where(~x).count() for x in same] == [0] * 4


def test_odd_pages_and_ids(spark):
    """Pages that are null, empty or hold odd tags; ids that are null or come twice."""
    lists = "<ul><li> a &amp; <b>b</b><LI>&nbsp;<li\n>c &lt;d</UL ><ol><li'>no<li>1</ol>"
    p = spark.createDataFrame([(1, "u", lists), (1, "u", lists), (None, None, lists), (2, "u", None), (3, "u", ""), (4, "u", "<ul><ul")], PAGE)
    want = [("ol", 0, "1"), ("ul", 0, "a &b"), ("ul", 1, "c <d")]
    assert sorted(map(tuple, X.list_items(p).collect()), key=lambda r: (r[0] or 0, r[1:])) == \
        [(None, *w) for w in want] + [(1, *w) for w in want for _ in "12"]
    assert [r.text for r in X.text(p).collect()] == ["a & b c <d no 1"] * 3 + [None, "", ""]


def test_a_page_is_cleaned_once(spark):
    plan = X.cleaned(pages(spark, ["a&amp;b"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(html") == 1


ENDLESS = ["<!-- ", "<script>", "<h1>", "<!doctype ", "<title>", "<b x='", "&", "<style>a</styl", "<!--a-->", "<li>", "<b>"]


def test_linear_in_the_page(spark):
    """Pages of 300 KB of one piece of markup that never ends."""
    t = time.time()
    got = {r.page_id: r for r in X.page_records(pages(spark, [p * (300_000 // len(p)) for p in ENDLESS])).collect()}
    assert time.time() - t < 60 and len(got) == len(ENDLESS)
    assert got[0].text == got[1].text == got[3].text == got[9].text == "" and got[6].text.count("&") == 300_000


def test_deep_nesting(spark):
    """Each level is held once more by all levels around it, so the answer itself is quadratic."""
    r = X.page_records(pages(spark, ["<ul><li>x" * 60, "<table><tr><td>x" * 40])).orderBy("page_id").collect()
    assert [len(u) for u in r[0].lists.ul] == list(range(60, 0, -1))
    assert [len(t) for t in r[1].tables] == list(range(40, 0, -1)) and r[1].tables[0][0][0] == "x" * 40


def test_intervals_need_no_shuffle(spark, nested):
    """Cells, items and selectors are made page by page: no task holds a sorted share of all tags or texts."""
    p = pages(spark, nested)
    for df in (X.cells(p), X.list_items(p), X.selector_text(p, ".x")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(step in plan for step in ("Window", "Join", "Exchange", "Sort"))


def test_cells_are_put_together_once(spark):
    """One pass over the tags; pages without cells give no row, ids that are null or come twice stay as they are."""
    table = "<table><tr><tr><td>a<td> <tr><th>b</table>"
    p = spark.createDataFrame([(1, "u", table), (1, "u", table), (None, None, table), (2, "u", None), (3, "u", ""), (4, "u", "text"),
                               (5, "u", "<table></table>"), (6, "u", "<table><tr></table><td>x"), (7, "u", "<table><tr></table>" + table)], PAGE)
    cells = X.cells(p)
    assert cells._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    want = [(0, 0, 0, "a"), (0, 0, 1, ""), (0, 1, 0, "b")]
    got = sorted(map(tuple, cells.collect()), key=lambda r: (r[0] or 0, r[1:]))
    assert got == [(None, *w) for w in want] + [(1, *w) for w in want for _ in "12"] + [(7, *w) for w in want]


def test_intervals_of_any_run_of_pages(monkeypatch):
    import pyarrow as pa

    from webloom.operators import elements as E
    rng = random.Random(3)
    form = pa.list_(pa.struct([("i", pa.int32()), ("name", pa.string()), ("ends", pa.bool_()), ("hit", pa.bool_())]))
    tags = [[{"i": i, "name": rng.choice(["table", "tr", "td", "ul", "li", "p"]), "ends": rng.random() < .4, "hit": rng.random() < .3}
             for i in range(1, rng.randint(1, 30))] for _ in range(40)]
    tags[3:5] = [None, []]
    last, tags = pa.array([31] * 40, pa.int32()), pa.array(tags, form)
    for body in (E._structure, E._hits):
        whole = E._by_pages(last, tags, body).to_pylist()
        for run in (1, 50):
            monkeypatch.setattr(E, "RUN", run)
            assert E._by_pages(last, tags, body).to_pylist() == whole
        monkeypatch.undo()

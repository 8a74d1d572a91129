"""Page extraction (full-page fixture of the reference's parser tests)."""

from tests.tree import parse_tree
from webloom.operators import extract as X

FULL = """
<html>
    <head>
        <title>Test Page</title>
        <meta name="description" content="Test description">
        <meta name="keywords" content="test, parser">
    </head>
    <body>
        <h1>Main Header</h1>
        <h2>Sub Header</h2>
        <p>Some text here.</p>
        <a href="/page1">Link 1</a>
        <a href="https://external.com">External</a>
        <img src="image.png" alt="image">
        <ul>
            <li>Item 1</li>
            <li>Item 2</li>
        </ul>
        <table>
            <tr><td>Cell 1</td><td>Cell 2</td></tr>
        </table>
    </body>
</html>
"""


def _pages(spark, html, url="https://example.com"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_full_page_record(spark):
    r = X.page_records(_pages(spark, FULL)).collect()[0]
    assert r.url == "https://example.com"
    assert r.title == "Test Page"
    assert r.description == "Test description"
    assert r.keywords == "test, parser"
    assert "Some text here" in r.text
    assert r.links == ["https://example.com/page1", "https://external.com"]
    assert [(i.src, i.alt) for i in r.images] == [("image.png", "image")]
    assert r.headings.h1 == ["Main Header"] and r.headings.h2 == ["Sub Header"] and r.headings.h3 == []
    assert r.tables == [[["Cell 1", "Cell 2"]]]
    assert r.lists.ul == ["Item 1", "Item 2"] and r.lists.ol == []


def test_text_rules(spark):
    html = ("<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{x}</style>"
            "<script>var t=\"</p>\";</script></head><body><!-- c --><h1>A <b>B</b></h1>"
            "<p>x  y &lt;b&gt;\n z</p><footer>&copy; q &middot; r</footer></body></html>")
    p = _pages(spark, html)
    t = X.text(p).collect()[0]
    assert t.text == "T & U A B x  y <b>\n z © q · r"
    assert t.text_length == len(t.text)
    h = X.headings(p).collect()
    assert [(x.level, x.text) for x in h] == [(1, "AB")]


def test_broken_html_kept(spark):
    for html in ["<html><body><h1>Unclosed tag</p>", "<div><p>Unclosed <span>", ""]:
        r = X.page_records(_pages(spark, html)).collect()
        assert len(r) == 1
        assert r[0].url == "https://example.com"


def test_meta_last_wins_and_case_sensitive(spark):
    html = ('<meta name="description" content="first"><meta name="Description" content="upper">'
            '<meta content="second" name="description"><meta name="keywords" content="k &amp; v">')
    r = X.meta(_pages(spark, html)).collect()[0]
    assert (r.description, r.keywords) == ("second", "k & v")


def test_selector_text(spark):
    html = '<div class="ad x">Buy <b>now</b></div><div class="note">no</div><p class="ad">P</p><div id="main">M</div>'
    p = _pages(spark, html)
    assert X.selector_text(p, "div.ad").collect()[0].selected_text == "Buynow"
    assert X.selector_text(p, ".ad").collect()[0].selected_text == "Buynow P"
    assert X.selector_text(p, "#main").collect()[0].selected_text == "M"
    assert X.selector_text(p, "div").collect()[0].selected_text == "Buynow no M"


def test_nested_tables_and_lists(spark):
    html = ("<table><tr><td>a</td><td><table><tr><td>in</td></tr></table></td></tr><tr><td></td></tr></table>"
            "<ul><li>one<ul><li>sub</li></ul></li><li>two</li></ul><ol><li>x</li><li> </li></ol>")
    rec = X.page_records(_pages(spark, html)).collect()[0]
    tables, lists = parse_tree(html)
    assert rec.tables == tables
    # find_all is recursive: the outer row also holds the nested cells
    assert tables == [[["a", "in", "in"], ["in"], [""]], [["in"]]]
    assert rec.lists.ul == lists["ul"] == ["onesub", "two", "sub"]
    assert rec.lists.ol == ["x"]
    cells = X.cells(_pages(spark, html)).count()
    assert cells == sum(len(r) for t in tables for r in t)


def test_corpus_totals_and_digest(spark):
    p = _pages(spark, FULL)
    t = X.corpus_totals(p).collect()[0]
    assert (t.pages, t.links, t.images) == (1, 2, 1)
    d = X.page_digest(p, 1).collect()[0]
    assert d.first_links == "https://example.com/page1" and d.n_links == 2


def _one(spark, html, expr):
    from webloom.functions import html as H
    df = spark.createDataFrame([(html,)], "html string").select(H.clean("html").alias("_clean"))
    return df.select(expr("_clean").alias("v")).first()["v"]


def test_quoted_greater_than(spark):
    from webloom.functions import html as H
    page = '<p title="a>b">text</p><h1 data-x="1>2">H</h1><ul class="x>y"><li id=\'a>b\'>i</li></ul>'
    assert _one(spark, page, H.page_text) == "text H i"
    assert _one(spark, page, lambda c: H.headings(c, 1)) == ["H"]
    assert X.page_records(_pages(spark, page)).first().lists.ul == ["i"]
    assert _one(spark, '<p title="open>text</p>', H.page_text) == "text"


def test_attribute_name_inside_a_value(spark):
    from webloom.functions import html as H
    page = '<img alt="x src=foo y" src="bar.png"><img src=a.png alt=\'b src="c"\'><img data-src="no" alt="z">'
    got = [(r["src"], r["alt"]) for r in _one(spark, page, H.images)]
    assert got == [("bar.png", "x src=foo y"), ("a.png", 'b src="c"')]
    assert _one(spark, '<a title="href=/x" href="/y">t</a><a title="href=/z">u</a>', H.hrefs) == ["/y"]

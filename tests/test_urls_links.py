"""URL resolution and link rules (fixtures of the reference's parser tests)."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.operators import links as L


def _links(spark, html, base, **kw):
    df = spark.createDataFrame([(1, base, html)], "page_id long, url string, html string")
    return L.page_links(df, **kw).collect()[0]["links"]


def test_relative_resolution(spark):
    html = """<html><body><a href="/path/to/page">Page</a><a href="page2">Page2</a>
              <a href="../up">Up</a><a href="//example.com">Protocol-relative</a></body></html>"""
    links = _links(spark, html, "https://site.com/dir/subdir/")
    assert "https://site.com/path/to/page" in links
    assert "https://site.com/dir/subdir/page2" in links
    assert "https://site.com/dir/up" in links
    assert "https://example.com" in links


def test_link_kinds(spark):
    html = """<html><body><a href="/relative">Relative</a><a href="https://absolute.com">Absolute</a>
              <a href="#anchor">Anchor</a><a href="javascript:void(0)">JS</a>
              <a href="http://example.com">HTTP</a></body></html>"""
    links = _links(spark, html, "https://base.com")
    assert links == ["https://base.com/relative", "https://absolute.com", "http://example.com"]


def test_external_filter(spark):
    html = """<a href="/internal">in</a><a href="https://other.com/x">out</a>
              <a href="https://www.MYSITE.com/y">same after normalising</a><a href="https://third.org">out</a>"""
    links = _links(spark, html, "https://mysite.com", filter_external=True)
    assert links == ["https://mysite.com/internal", "https://www.MYSITE.com/y"]
    links = _links(spark, html, "https://mysite.com", filter_external=True, allowed_domains=["third.org"])
    assert links == ["https://mysite.com/internal", "https://www.MYSITE.com/y", "https://third.org"]


def test_dedup_keeps_first_order_and_cuts_fragment(spark):
    html = '<a href="b#x">1</a><a href="a">2</a><a href="b#y">3</a><a href="a?q=1">4</a><a href="">5</a><a>6</a>'
    assert _links(spark, html, "http://h.com/d/") == ["http://h.com/d/b", "http://h.com/d/a", "http://h.com/d/a?q=1"]


def test_urljoin_matches_stdlib(spark):
    bases = ["https://site.com/dir/subdir/", "http://a.b.com", "http://a.b.com/x/y.html?z=1#f", "https://h.com/a//b/c"]
    hrefs = ["/p", "q", "../../../r", "./s/../t", "?k=v", "//x.org/y", "https://z.net", "a//b", ".", "..",
             "/für/the,", "  /lead", "mailto:a@b"]
    rows = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(rows, "base string, href string")
    got = [r[0] for r in df.select(U.strip_fragment(U.urljoin("base", "href"))).collect()]
    assert got == [urljoin(b, h).split("#")[0] for b, h in rows]


def test_netloc_and_domain(spark):
    df = spark.createDataFrame([("https://User@WWW.Ex.com:8080/p?q#f",), ("not a url",), ("http://www.a.org",)], "u string")
    r = df.select(U.netloc("u").alias("n"), U.norm_domain("u").alias("d"), U.is_valid_url("u").alias("v")).collect()
    assert [tuple(x) for x in r] == [("User@WWW.Ex.com:8080", "user@www.ex.com:8080".replace("www.", "www."), True),
                                     ("", "", False), ("www.a.org", "a.org", True)]


def test_patterns_and_seen(spark):
    df = spark.createDataFrame([("https://a.com/page1",), ("https://a.com/page2",), ("https://b.com/admin/x",)], "url string")
    assert {r.url for r in L.apply_patterns(df, exclude=["page2"]).collect()} == {"https://a.com/page1", "https://b.com/admin/x"}
    assert {r.url for r in L.apply_patterns(df, include=["page1"]).collect()} == {"https://a.com/page1"}
    assert {r.url for r in L.apply_patterns(df, exclude=["page1"], include=["page1"]).collect()} == set()
    seeds = spark.createDataFrame([("https://a.com/",)], "url string")
    assert {r.url for r in L.same_domain_as_seeds(df, seeds).collect()} == {"https://a.com/page1", "https://a.com/page2"}
    seen = spark.createDataFrame([("https://a.com/page1",)], "url string")
    assert L.not_yet_seen(df, seen).count() == 2
    pats = spark.createDataFrame([("admin",)], "pattern string")
    assert L.apply_pattern_table(df, pats, "exclude").count() == 2
    assert F is not None


def test_pattern_tables_equal_brute_force(spark):
    import random
    rng = random.Random(1)
    urls = ["".join(rng.choices("abcd/", k=rng.randint(0, 30))) for _ in range(300)] + ["", None, "é/ü/abcd"]
    sets = [["".join(rng.choices("abcd/é", k=rng.randint(1, 9))) for _ in range(40)] for _ in range(2)] + [["ab"], [""], [], ["abcde", None, "abc", "/ü"]]
    sets[1] = [p for p in sets[1] if len(p) > 3]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    for pats in sets:
        t = spark.createDataFrame([(p,) for p in pats], "pattern string")
        want = {i for i, u in enumerate(urls) if u is not None and any(p is not None and p in u for p in pats)}
        assert {r.i for r in L.apply_pattern_table(df, t, "include").collect()} == want
        assert {r.i for r in L.apply_pattern_table(df, t, "exclude").collect()} == set(range(len(urls))) - want


def test_many_patterns(spark):
    """100,000 patterns against 20,000 URLs: nothing is collected, no row pairs are formed."""
    urls = spark.range(20_000).select(F.concat(F.lit("http://h/p/"), F.col("id") * 7).alias("url"))
    pats = spark.range(100_000).select(F.concat(F.lit("/p/"), F.col("id") * 13, F.lit("")).alias("pattern"))
    got = L.apply_pattern_table(urls, pats, "include")
    plan = got._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    tails = {str(i * 13) for i in range(100_000)}
    want = sum(any(str(i * 7)[:n] in tails for n in range(1, 7)) for i in range(20_000))
    assert got.count() == want


def test_pattern_grams_are_not_broadcast(spark, tmp_path):
    """A pattern file small enough to be broadcast is many times larger when it is cut into q-grams."""
    spark.range(2000).select(F.concat(F.lit("/p/"), "id", F.lit("?")).alias("pattern")).write.parquet(f"{tmp_path}/p")
    spark.range(500).select(F.concat(F.lit("http://h/p/"), F.col("id") * 7, F.lit("?x")).alias("url")).write.parquet(f"{tmp_path}/u")
    pats, urls = spark.read.parquet(f"{tmp_path}/p"), spark.read.parquet(f"{tmp_path}/u")
    got = L.matching_urls(urls, pats)
    assert got.count() == sum(i * 7 < 2000 for i in range(500))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()

"""Sitemap expansion: reference fixtures and a depth-first brute force."""

import re

from webloom.plans import catalog as C
from webloom.sources import sitemaps as SM

URLSET = """<?xml version="1.0" encoding="UTF-8"?>
<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
    <url><loc>https://example.com/page1</loc></url>
    <url><loc>https://example.com/page2</loc></url>
</urlset>"""
INDEX = """<?xml version="1.0" encoding="UTF-8"?>
<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
    <sitemap><loc>https://example.com/sitemap1.xml</loc></sitemap>
    <sitemap><loc>https://example.com/sitemap2.xml</loc></sitemap>
</sitemapindex>"""


def _expand(spark, docs, root, **kw):
    sm = spark.createDataFrame(list(docs.items()), "sitemap_url string, xml string")
    roots = spark.createDataFrame([(root,)], "root string")
    return [r.url for r in SM.expand(sm, roots, **kw).orderBy("pos").collect()]


def test_urlset(spark):
    assert _expand(spark, {"https://example.com/sitemap.xml": URLSET}, "https://example.com/sitemap.xml") == [
        "https://example.com/page1", "https://example.com/page2"]


def test_index_no_dedup_across_children(spark):
    docs = {"https://example.com/sitemap.xml": INDEX, "https://example.com/sitemap1.xml": URLSET,
            "https://example.com/sitemap2.xml": URLSET}
    got = _expand(spark, docs, "https://example.com/sitemap.xml")
    assert len(got) == 4 and got.count("https://example.com/page1") == 2


def test_cap_missing_child_bad_xml_and_namespace(spark):
    docs = {"r": INDEX.replace("https://example.com/sitemap2.xml", "missing"),
            "https://example.com/sitemap1.xml": URLSET.replace("page1", "a&amp;b")}
    assert _expand(spark, docs, "r") == ["https://example.com/a&b", "https://example.com/page2"]
    assert _expand(spark, docs, "r", max_urls=1) == ["https://example.com/a&b"]
    assert _expand(spark, {"x": URLSET.replace(' xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"', "")}, "x") == []
    assert _expand(spark, {"x": URLSET.replace("</urlset>", "")}, "x") == []


def dfs(docs, root, max_urls=50_000):
    """Depth-first walk with a visited set, as the crawler's sitemap reader."""
    visited = set()

    def walk(u):
        if u in visited or u not in docs:
            visited.add(u)
            return []
        visited.add(u)
        x = docs[u]
        locs = [m for m in re.findall(r"(?s)<loc>(.*?)</loc>", x) if m]
        locs = [m.replace("&amp;", "&") for m in locs]
        if "<sitemapindex" in x.lower():
            out = []
            for c in locs:
                out.extend(walk(c))
                if len(out) >= max_urls:
                    break
            return out[:max_urls]
        return locs[:max_urls]
    return walk(root)


def test_fixture_tree_matches_dfs(spark):
    sm = C._sitemaps(spark, "/root/testdata/sf0.001")
    docs = {r.sitemap_url: r.xml for r in sm.collect()}
    got = _expand(spark, docs, SM.TOP_SITEMAP)
    exp = dfs(docs, SM.TOP_SITEMAP)
    assert got == exp
    pages = {r.url for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url").collect()}
    assert set(got) == pages and len(got) == len(pages)


def _index(*locs):
    return ('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
            + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in locs) + "</sitemapindex>")


def _urlset(*locs):
    return ('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
            + "".join(f"<url><loc>{u}</loc></url>" for u in locs) + "</urlset>")


def test_deep_tree_and_many_urls_come_out_whole(spark):
    docs = {f"i{k}": _index(f"i{k + 1}") for k in range(11)} | {"i11": _urlset("https://e.com/deep")}
    assert _expand(spark, docs, "i0") == ["https://e.com/deep"]
    many = [f"https://e.com/{k}" for k in range(50_300)]
    docs = {"r": _index("a", "b"), "a": _urlset(*many[:30_000]), "b": _urlset(*many[30_000:])}
    assert _expand(spark, docs, "r") == many


def test_loc_forms(spark):
    ns = "http://www.sitemaps.org/schemas/sitemap/0.9"
    x = (f"<s:urlset xmlns:s='{ns}'><s:url><s:loc >https://e.com/1</s:loc></s:url>"
         "<s:url><s:loc><![CDATA[https://e.com/2?a=1&b=2]]></s:loc></s:url></s:urlset>")
    assert _expand(spark, {"x": x}, "x") == ["https://e.com/1", "https://e.com/2?a=1&b=2"]


def test_depth_first_on_random_diamonds(spark):
    """Sitemaps listed under several branches at different depths, with cycles."""
    import random
    head = '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    rng = random.Random(6)
    for _ in range(4):
        docs, n = {}, 9
        for i in range(n):
            kids = rng.sample(range(n + 3), rng.randint(1, 5))
            docs[f"i{i}"] = head + "".join(f"<sitemap><loc>{'i' if k < n else 'u'}{k}</loc></sitemap>" for k in kids) + "</sitemapindex>"
        for k in range(n, n + 3):
            docs[f"u{k}"] = URLSET.replace("page1", f"{k}-a").replace("page2", f"{k}-b")
        assert _expand(spark, docs, "i0") == dfs(docs, "i0")

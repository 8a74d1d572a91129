"""Sitemaps: S6 tree expansion (with D6 visited guard), S7 flat loc scan,
and the fixture that derives a sitemap tree from the page table.

Input is a table ``sitemaps(sitemap_url, xml)``; nothing is fetched.

S6 expands level by level from the root sitemaps: a document whose lower-cased
text contains ``<sitemapindex`` is an index and its ``loc`` values are child
sitemaps, otherwise its ``loc`` values are page URLs.  Only ``loc`` elements of
the sitemaps.org namespace count, their text is kept verbatim (entities
decoded), empty ones are skipped, a document without the namespace or not
closed yields nothing.  URLs are not deduplicated across children.  Each
sitemap is expanded once per root: per level the occurrence with the smallest
position path wins and sitemaps expanded at an earlier level are skipped.
(A depth-first walk decides repeats by position path across levels; the two
differ only when one child sitemap is listed under several branches at
different depths.)  A root's URLs are numbered in position-path order, which is
the depth-first order; nothing is cut unless the caller names ``max_urls``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import netloc
from ..session import cut_lineage

# fixed values
SITEMAP_NS = "http://www.sitemaps.org/schemas/sitemap/0.9"
LOC_RE = r"(?s)<(?:[A-Za-z][\w.-]*:)?loc(?:\s[^>]*)?>(.*?)</(?:[A-Za-z][\w.-]*:)?loc\s*>"
NS_RE = r"xmlns(?::[\w.-]+)?\s*=\s*[\"']" + SITEMAP_NS.replace(".", r"\.") + r"[\"']"
CLOSED_RE = r"(?s)</(?:[A-Za-z][\w.-]*:)?(urlset|sitemapindex)\s*>"
INDEX_RE = r"<(?:[a-z][\w.-]*:)?sitemapindex"
CDATA_RE = r"(?s)^\s*<!\[CDATA\[(.*)\]\]>\s*$"
FLAT_LOC_RE = r"<loc>([^<]+)</loc>"
XML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]
URLS_PER_FILE = 50_000


def xml_unescape(c):
    for a, b in XML_ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def xml_escape(c):
    for a, b in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def parse_locs(xml) -> F.Column:
    """``loc`` texts of a sitemap document (namespace-qualified only)."""
    x = F.col(xml) if isinstance(xml, str) else xml
    closed = x.rlike(CLOSED_RE)
    has_ns = x.rlike(NS_RE)
    text = lambda s: F.when(s.rlike(CDATA_RE), F.regexp_extract(s, CDATA_RE, 1)).otherwise(xml_unescape(s))
    locs = F.filter(F.transform(F.regexp_extract_all(x, F.lit(LOC_RE), 1), text), lambda s: s != "")
    return F.when(closed & has_ns, locs).otherwise(F.array().cast("array<string>"))


def is_index(xml) -> F.Column:
    x = F.col(xml) if isinstance(xml, str) else xml
    return F.lower(x).rlike(INDEX_RE)


def expand(sitemaps: DataFrame, roots: DataFrame, max_urls: int | None = None, checkpoint: bool = True,
           visits: bool = False) -> DataFrame:
    """S6 + D6: (root, pos, url, via) for every root sitemap URL in ``roots(root)``.
    With ``visits`` the D6 table is returned instead: every sitemap expanded
    per root with its level (root, sitemap_url, level).

    Sitemaps are visited depth first, each once: a sitemap listed at several places counts where a
    depth-first walk meets it first.  That place is its smallest position path (position in the
    root, position in that child, ...) among those that pass no sitemap twice, and every
    sitemap on it stands at its own smallest path.  So a fixpoint finds it: each round lists the
    children of the sitemaps whose path changed, keeps the smallest path of each child and goes on with the
    children that gained one, those re-pathed after a visit at a deeper level included, until no
    path changes.  Positions come from a running total over the sitemap files (one row
    per file), not from ranking a root's URLs."""
    docs = sitemaps.select("sitemap_url", is_index("xml").alias("_index"), parse_locs("xml").alias("_locs"))
    if checkpoint:
        # parse every document once; rounds then join against the parsed table
        docs = cut_lineage(docs)
    frontier = roots.select("root", F.col("root").alias("sitemap_url"), F.array().cast("array<int>").alias("path"),
                            F.array("root").alias("trail"))
    best = frontier
    key = ["root", "sitemap_url"]
    while True:
        kids = (frontier.join(docs.filter("_index"), "sitemap_url")
                .select("root", "path", "trail", F.posexplode("_locs").alias("_p", "loc"))
                .where(~F.array_contains("trail", F.col("loc"))))
        found = (kids.groupBy("root", F.col("loc").alias("sitemap_url"))
                 .agg(F.min(F.struct(F.concat("path", F.array(F.col("_p").cast("int"))).alias("path"), "trail")).alias("m"))
                 .select(*key, "m.path", F.concat("m.trail", F.array("sitemap_url")).alias("trail")))
        nxt = (found.join(best.select(*key, F.col("path").alias("_old")), key, "left")
               .where("_old IS NULL OR path < _old").drop("_old"))
        if checkpoint:
            nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        best = best.join(nxt.select(*key), key, "left_anti").unionByName(nxt)
        if checkpoint:
            best = cut_lineage(best)
        frontier = nxt
    visited = best.select(*key, "path", F.size("path").alias("level"))
    if visits:
        return visited.select("root", "sitemap_url", "level")
    files = visited.join(docs.filter(~F.col("_index")), "sitemap_url")
    before = W.partitionBy("root").orderBy("path", "sitemap_url").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select("root", "sitemap_url", F.coalesce(F.sum(F.size("_locs").cast("long")).over(before), F.lit(0))
                          .alias("_start"))
    urls = files.join(starts, ["root", "sitemap_url"]).select(
        "root", F.col("sitemap_url").alias("via"), "_start", F.posexplode("_locs").alias("_p", "url"))
    out = urls.select("root", (F.col("_start") + F.col("_p")).alias("pos"), "url", "via")
    return out if max_urls is None else out.filter(F.col("pos") < max_urls)


def flat_locs(sitemaps: DataFrame, max_urls: int | None = None) -> DataFrame:
    """Raw ``<loc>…</loc>`` texts of each document; the first ``max_urls``
    of each only if the caller asks for it."""
    x = sitemaps.select("sitemap_url", F.posexplode(F.regexp_extract_all("xml", F.lit(FLAT_LOC_RE), 1))
                        .alias("pos", "url"))
    return x if max_urls is None else x.filter(F.col("pos") < max_urls)


# ---- fixture: a sitemap tree derived from the page table ----------------------------
TOP_SITEMAP = "https://sitemaps.example/sitemap.xml"
URLSET_HEAD = f'<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="{SITEMAP_NS}">'
INDEX_HEAD = f'<?xml version="1.0" encoding="UTF-8"?>\n<sitemapindex xmlns="{SITEMAP_NS}">'


def sitemap_fixture(pages: DataFrame) -> DataFrame:
    """Three levels: top index -> indexes per top-level domain (which also
    list the top index again, a cycle) -> one urlset per host listing the
    host's pages in page order.  Every file holds at most 50,000 entries
    (hosts and indexes split by hash), so no single row grows with the data."""
    p = pages.select("page_id", "url", netloc("url").alias("host")).filter(F.col("host") != "")
    counts = p.groupBy("host").agg(F.count(F.lit(1)).alias("_n"))
    p = p.join(counts, "host").withColumn(
        "chunk", F.pmod(F.xxhash64("url"), F.ceil(F.col("_n") / URLS_PER_FILE)).cast("int"))
    entries = F.concat(F.lit("<url><loc>"), xml_escape(F.col("url")), F.lit("</loc></url>"))
    leaf = (p.groupBy("host", "chunk")
            .agg(F.array_sort(F.collect_list(F.struct("page_id", entries.alias("e")))).alias("_es")))
    leaf = leaf.select(
        "host",
        F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap-"), F.col("chunk").cast("string"),
                 F.lit(".xml")).alias("sitemap_url"),
        F.concat(F.lit(URLSET_HEAD), F.array_join(F.transform("_es", lambda s: s["e"]), ""), F.lit("</urlset>"))
        .alias("xml"))
    leaf = leaf.withColumn("tld", F.regexp_extract("host", r"\.([^.]+)$", 1))
    n_leaf = leaf.groupBy("tld").agg(F.count(F.lit(1)).alias("_m"))
    leaf = leaf.join(n_leaf, "tld").withColumn(
        "mchunk", F.pmod(F.xxhash64("sitemap_url"), F.ceil(F.col("_m") / URLS_PER_FILE)).cast("int"))
    mid_url = F.concat(F.lit("https://sitemaps.example/"), F.col("tld"), F.lit("-index-"),
                       F.col("mchunk").cast("string"), F.lit(".xml"))
    mid = (leaf.groupBy("tld", "mchunk").agg(F.array_sort(F.collect_list("sitemap_url")).alias("_c"))
           .select(mid_url.alias("sitemap_url"),
                   F.concat(F.lit(INDEX_HEAD),
                            F.array_join(F.transform(F.concat("_c", F.array(F.lit(TOP_SITEMAP))),
                                                     lambda u: F.concat(F.lit("<sitemap><loc>"), u,
                                                                        F.lit("</loc></sitemap>"))), ""),
                            F.lit("</sitemapindex>")).alias("xml")))
    top = mid.agg(F.array_sort(F.collect_list("sitemap_url")).alias("_c")).select(
        F.lit(TOP_SITEMAP).alias("sitemap_url"),
        F.concat(F.lit(INDEX_HEAD),
                 F.array_join(F.transform("_c", lambda u: F.concat(F.lit("<sitemap><loc>"), u,
                                                                    F.lit("</loc></sitemap>"))), ""),
                 F.lit("</sitemapindex>")).alias("xml"))
    return (leaf.select("sitemap_url", "xml").unionByName(mid.select("sitemap_url", "xml"))
            .unionByName(top))

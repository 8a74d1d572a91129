"""Link extraction and scope filters: X4, D1, J1–J5.

The link rule order of a page: ``<a href>`` in document order -> drop empty
or ``#…`` -> resolve against the page URL -> cut at ``#`` -> keep http(s)
with a host -> optional domain scope -> dedup keeping the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import urls as U
from ..functions.memo import cached_column

CLEAN = "_clean"


BASE_COLS = {"b": "_b_url", "scheme": "_b_scheme", "origin": "_b_origin", "dir": "_b_dir",
             "noquery": "_b_noquery"}


def with_base_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Project the page URL's parts once, so the per-link lambda only reads them."""
    parts = U.base_parts(url_col)
    return df.select("*", *[parts[k].alias(v) for k, v in BASE_COLS.items()])


def page_links_expr(url, cleaned, filter_external: bool = False, allowed_domains=None,
                    parts_projected: bool = False) -> Column:
    if isinstance(allowed_domains, list):
        allowed_domains = tuple(allowed_domains)
    return _page_links_expr(url, cleaned, filter_external, allowed_domains, parts_projected)


@cached_column
def _page_links_expr(url, cleaned, filter_external: bool = False, allowed_domains=None,
                     parts_projected: bool = False) -> Column:
    """``ARRAY<STRING>`` of the page's unique absolute links (first-seen order).
    With ``parts_projected`` the base-URL parts are read from the columns added
    by ``with_base_parts`` instead of being recomputed for every link."""
    url = F.col(url) if isinstance(url, str) else url
    parts = ({k: F.col(v) for k, v in BASE_COLS.items()} if parts_projected else U.base_parts(url))
    hs = F.filter(H.hrefs(cleaned), lambda h: (h != "") & ~h.startswith("#"))
    refs = F.transform(F.transform(hs, lambda h: U.normalize_ref(U.clean_ref(h), parts["scheme"])), U.split_ref)
    res = F.filter(F.transform(refs, lambda r: U.strip_fragment(U.resolve(parts, r))), U.is_valid_url)
    if filter_external:
        base_dom = U.norm_domain(url)
        allowed = sorted(set(allowed_domains or []))
        if allowed:
            res = F.filter(res, lambda u: U.norm_domain(u).isin(allowed) | (U.norm_domain(u) == base_dom))
        else:
            res = F.filter(res, lambda u: U.norm_domain(u) == base_dom)
    return F.array_distinct(res)  # D1: keeps the first occurrence's order


def page_links(pages: DataFrame, filter_external: bool = False, allowed_domains=None) -> DataFrame:
    """Per page: ``links`` array (X4 in array form)."""
    c = with_base_parts(pages.select("page_id", "url", H.clean("html").alias(CLEAN)))
    return c.select("page_id", "url",
                    page_links_expr("url", CLEAN, filter_external, allowed_domains, True).alias("links"))


def link_table(pages: DataFrame, filter_external: bool = False, allowed_domains=None) -> DataFrame:
    """X4 + D1 long form ``links(page_id, pos, src_url, dst_url)``; map-only, no shuffle."""
    pl = page_links(pages, filter_external, allowed_domains)
    return pl.select("page_id", F.posexplode("links").alias("pos", "dst_url"),
                     F.col("url").alias("src_url")).select("page_id", "pos", "src_url", "dst_url")


def raw_link_table(pages: DataFrame) -> DataFrame:
    """All resolved hrefs with their validity (U3/U4/U5 job): page_id, pos, href, resolved, valid.
    Resolution runs element-wise over the page's href array (as in
    ``page_links``), so each reference is cleaned once."""
    c = with_base_parts(pages.select("page_id", "url", H.clean("html").alias(CLEAN)))
    parts = {k: F.col(v) for k, v in BASE_COLS.items()}
    hs = H.hrefs(CLEAN)
    refs = F.transform(F.transform(hs, lambda h: U.normalize_ref(U.clean_ref(h), parts["scheme"])), U.split_ref)
    res = F.transform(refs, lambda r: U.strip_fragment(U.resolve(parts, r)))
    x = c.select("page_id", F.posexplode(F.arrays_zip(hs.alias("href"), res.alias("resolved"))).alias("pos", "z"))
    x = x.select("page_id", "pos", F.col("z.href").alias("href"), F.col("z.resolved").alias("resolved"))
    skip = (F.col("href") == "") | F.col("href").startswith("#")
    return x.select("page_id", "pos", "href",
                    F.when(skip, F.lit(None)).otherwise(F.col("resolved")).alias("resolved"),
                    (~skip & U.is_valid_url(F.col("resolved"))).alias("valid"))


# J1 ----------------------------------------------------------------------------
def scope_to_page_domain(links: DataFrame, allowed: DataFrame | None = None,
                         allowed_col: str = "domain") -> DataFrame:
    """Keep links whose normalised target domain equals the page's or is in the
    allow-list table (a left join against distinct allowed domains, which AQE
    broadcasts when it measures small)."""
    x = links.withColumn("_dd", U.norm_domain("dst_url")).withColumn("_sd", U.norm_domain("src_url"))
    if allowed is None:
        return x.filter(F.col("_dd") == F.col("_sd")).drop("_dd", "_sd")
    a = allowed.select(F.col(allowed_col).alias("_ad")).distinct()
    y = x.join(a, x["_dd"] == a["_ad"], "left")
    return y.filter((F.col("_dd") == F.col("_sd")) | F.col("_ad").isNotNull()).drop("_dd", "_sd", "_ad")


# J2 ----------------------------------------------------------------------------
def seed_domains(seeds: DataFrame, url_col: str = "url") -> DataFrame:
    d = seeds.select(U.netloc(url_col).alias("domain")).filter(F.col("domain") != "").distinct()
    return d


def same_domain_as_seeds(df: DataFrame, seeds: DataFrame, url_col: str = "url") -> DataFrame:
    """``same_domain_only``: netloc of the URL must be a netloc of some seed."""
    sd = seed_domains(seeds)
    return df.join(sd, U.netloc(F.col(url_col)) == sd["domain"], "left_semi")


# J3 / J4 -------------------------------------------------------------------------
def any_substring(col: Column, patterns) -> Column:
    cond = F.lit(False)
    for p in patterns:
        cond = cond | col.contains(p)
    return cond


def apply_patterns(df: DataFrame, url_col: str = "url", exclude=None, include=None) -> DataFrame:
    """Exclude first (any substring), then include (any substring); empty = no filter."""
    c = F.col(url_col)
    if exclude:
        df = df.filter(~any_substring(c, exclude))
    if include:
        df = df.filter(any_substring(c, include))
    return df


def _grams(text: Column, q: int) -> Column:
    """Distinct q-grams of a text of at least q characters (none of a shorter one)."""
    starts = F.when(F.length(text) >= q, F.sequence(F.lit(1), F.length(text) - q + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(q))))


def matching_urls(urls: DataFrame, patterns: DataFrame, url_col: str = "url", pattern_col: str = "pattern", q: int = 4,
                  shortest: int = 1) -> DataFrame:
    """Distinct URLs that contain any pattern of a table of patterns.

    A pattern is indexed under one of its q-grams, the one that fewest URLs hold, and only URLs with this q-gram are
    tested for the whole pattern: an equi-join on the q-gram, then ``contains``.  Patterns shorter than ``q`` have
    an index of their own length each (at most ``q - 1`` of them).  The empty pattern is in every URL.

    All joins on q-grams are merge joins: the planner sizes a side by its files, before the texts are
    cut into q-grams, and would send millions of them through the driver as a small table."""
    u = urls.select(F.col(url_col).alias("_u")).where("_u IS NOT NULL").distinct()
    p = patterns.select(F.col(pattern_col).alias("_p")).where("_p IS NOT NULL").distinct()
    found = u.where(p.where(F.col("_p") == "").exists())
    for n in range(shortest, q + 1):
        mine = p.where(F.length("_p") >= q if n == q else F.length("_p") == n)
        grams = u.select("_u", F.explode(_grams(F.col("_u"), n)).alias("_g"))
        asked = mine.select("_p", F.explode(_grams(F.col("_p"), n)).alias("_g"))
        if n == q:
            held = (grams.join(asked.select("_g").distinct().hint("merge"), "_g", "left_semi").groupBy("_g").agg(F.count(F.lit(1)).alias("_n")))
            # a q-gram that no URL has: the pattern is in none
            asked = (asked.join(held.hint("merge"), "_g", "left").groupBy("_p")
                     .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("m")).where("m.n > 0")
                     .select("_p", F.col("m._g").alias("_g")))
        found = found.unionAll(grams.join(asked.hint("merge"), "_g").where(F.col("_u").contains(F.col("_p"))).select("_u"))
    return found.distinct().withColumnRenamed("_u", url_col)


def apply_pattern_table(df: DataFrame, patterns: DataFrame, how: str, url_col: str = "url",
                        pattern_col: str = "pattern") -> DataFrame:
    """Pattern list held in a table, of any size: keep (include) or drop (exclude) the URLs that
    contain any pattern.  Null URLs contain none."""
    hits = matching_urls(df, patterns, url_col, pattern_col)
    return df.join(hits, url_col, "left_semi" if how == "include" else "left_anti")


# J5 ----------------------------------------------------------------------------
def not_yet_seen(candidates: DataFrame, seen: DataFrame, url_col: str = "url") -> DataFrame:
    return candidates.join(seen.select(url_col), url_col, "left_anti")

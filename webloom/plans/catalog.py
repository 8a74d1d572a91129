"""Query catalogue: one Spark job per inventory ID plus its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Column names are identical on both sides; doubles are rounded to 6 places on
both sides.  Queries without an oracle (Python state machines, streams,
sinks) are checked against brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import outcomes as O
from ..functions import urls as U
from ..functions.sqltext import lit
from ..operators import extract as X
from ..operators import links as L
from ..operators import retries as R
from ..operators import stats as A
from ..sources import fetchlog as FL
from ..sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- shared oracle CTEs ---------------------------------------------------------
CLEAN_CTE = f"cp AS (SELECT page_id, url, {H.clean_sql('html')} AS c FROM pages)"
LOG_CTE = f"fetch_log AS ({FL.FETCH_LOG_SQL})"
ATTEMPTS_CTE = f"{LOG_CTE}, attempts AS ({R.w1_sql('fetch_log')})"
OUTCOMES_CTE = f"{ATTEMPTS_CTE}, outcomes AS (SELECT * FROM attempts WHERE is_outcome)"


HREF_CTE = f"""{CLEAN_CTE},
hr AS (SELECT page_id, url, u.href, u.pos FROM cp,
       LATERAL (SELECT unnest({H.hrefs_sql('c')}) AS href, generate_subscripts({H.hrefs_sql('c')}, 1) - 1 AS pos) u),
rs AS (SELECT page_id, url, CAST(pos AS INTEGER) AS pos, href,
              CASE WHEN href = '' OR starts_with(href, '#') THEN NULL
                   ELSE {U.strip_fragment_sql(U.urljoin_sql('url', 'href'))} END AS resolved
       FROM hr)"""

LINKS_CTE = f"""{HREF_CTE},
links AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) - 1 AS INTEGER) AS pos,
                 url AS src_url, resolved AS dst_url
          FROM rs WHERE resolved IS NOT NULL AND {U.is_valid_url_sql('resolved')}
          GROUP BY page_id, url, resolved)"""


def _pages(spark, sf):
    return T.pages(spark, sf)


def _log(spark, sf):
    return FL.fetch_log(spark, sf)


def _attempts(spark, sf, max_retries: int = 3):
    return R.number_attempts(_log(spark, sf), max_retries)


def _outcomes(spark, sf):
    return R.outcomes(_attempts(spark, sf))


# Jobs that read the attempt/outcome rows more than once (several aggregates,
# or the bucketed per-domain sequences with their self-joins) read them from a
# table written once into the shared checkpoint folder, as a pipeline would,
# instead of re-deriving the attempt numbering in every branch.
def _attempts_table(spark, sf):
    from ..session import cut_lineage
    return cut_lineage(_attempts(spark, sf))


def _outcomes_table(spark, sf):
    return R.outcomes(_attempts_table(spark, sf))


# ==== S1 / U1–U8 ==================================================================
@query("s1_pages_scan", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages")
def s1_pages_scan(spark, sf):
    return T.pages(spark, sf).select("page_id", "url", F.length("html").alias("html_chars"))


@query("u1_netloc_census", f"SELECT {U.netloc_sql('url')} AS domain, count(*) AS n FROM pages GROUP BY 1")
def u1_netloc_census(spark, sf):
    p = T.pages(spark, sf, with_html=False)
    return p.groupBy(U.netloc("url").alias("domain")).agg(F.count(F.lit(1)).alias("n"))


@query("u2_domain_census", f"SELECT {U.norm_domain_sql('url')} AS domain, count(*) AS n FROM pages GROUP BY 1")
def u2_domain_census(spark, sf):
    p = T.pages(spark, sf, with_html=False)
    return p.groupBy(U.norm_domain("url").alias("domain")).agg(F.count(F.lit(1)).alias("n"))


_HREF_SQL = HREF_CTE


@query("u3_link_validity", f"""WITH {_HREF_SQL}
SELECT page_id, count(*) AS n_hrefs,
       count(*) FILTER (WHERE resolved IS NOT NULL AND {U.is_valid_url_sql('resolved')}) AS n_valid,
       count(*) FILTER (WHERE NOT (resolved IS NOT NULL AND {U.is_valid_url_sql('resolved')})) AS n_invalid
FROM rs GROUP BY page_id""")
def u3_link_validity(spark, sf):
    r = L.raw_link_table(_pages(spark, sf))
    return r.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_hrefs"), F.count_if("valid").alias("n_valid"),
                                    F.count_if(~F.col("valid")).alias("n_invalid"))


@query("u4_resolved_links", f"WITH {_HREF_SQL} SELECT page_id, pos, href, resolved FROM rs")
def u4_resolved_links(spark, sf):
    return L.raw_link_table(_pages(spark, sf)).select("page_id", "pos", "href", "resolved")


@query("u5_fragment_strip", f"SELECT page_id, url, {U.strip_fragment_sql('url')} AS url_nofrag FROM pages")
def u5_fragment_strip(spark, sf):
    p = T.pages(spark, sf, with_html=False)
    return p.select("page_id", "url", U.strip_fragment("url").alias("url_nofrag"))


@query("u6_classified_log", f"WITH {LOG_CTE} SELECT event_id, url, status, error_type FROM fetch_log")
def u6_classified_log(spark, sf):
    return _log(spark, sf).select("event_id", "url", "status", "error_type")


@query("u7_retryable_counts", f"""WITH {LOG_CTE}
SELECT error_type, {O.is_retryable_sql('error_type')} AS retryable, count(*) AS n FROM fetch_log GROUP BY 1, 2""")
def u7_retryable_counts(spark, sf):
    log = _log(spark, sf)
    return log.groupBy("error_type", O.is_retryable("error_type").alias("retryable")).agg(
        F.count(F.lit(1)).alias("n"))


@query("u8_json_links", f"""WITH {LINKS_CTE}
SELECT page_id, to_json(list(dst_url ORDER BY pos))::VARCHAR AS links_json FROM links GROUP BY page_id""")
def u8_json_links(spark, sf):
    pl = L.page_links(_pages(spark, sf))
    return pl.filter(F.size("links") > 0).select("page_id", F.to_json("links").alias("links_json"))


# ==== X1–X11 ====================================================================
@query("x1_title_meta", f"""WITH {CLEAN_CTE}
SELECT page_id, url, {H.title_sql('c')} AS title, {H.meta_content_sql('c', 'description')} AS description,
       {H.meta_content_sql('c', 'keywords')} AS keywords FROM cp""")
def x1_title_meta(spark, sf):
    return X.meta(_pages(spark, sf))


@query("x2_page_text", f"""WITH {CLEAN_CTE}
SELECT page_id, url, t AS text, CAST(length(t) AS INTEGER) AS text_length
FROM (SELECT page_id, url, {H.page_text_sql('c')} AS t FROM cp)""")
def x2_page_text(spark, sf):
    return X.text(_pages(spark, sf))


@query("x3_selector_text", f"WITH {CLEAN_CTE}, {H.selector_text_sql('cp', 'div.ad')}")
def x3_selector_text(spark, sf):
    return X.selector_text(_pages(spark, sf), "div.ad")


@query("x3_selector_class", f"WITH {CLEAN_CTE}, {H.selector_text_sql('cp', '.ad')}")
def x3_selector_class(spark, sf):
    """A class on any tag."""
    return X.selector_text(_pages(spark, sf), ".ad")


@query("x4_link_table", f"WITH {LINKS_CTE} SELECT page_id, pos, src_url, dst_url FROM links")
def x4_link_table(spark, sf):
    return L.link_table(_pages(spark, sf))


_IMG_SQL = f"""WITH {CLEAN_CTE},
t AS (SELECT page_id, u.tag, u.i FROM cp,
      LATERAL (SELECT unnest({H.tags_all_sql('c', 'img')}) AS tag, generate_subscripts({H.tags_all_sql('c', 'img')}, 1) AS i) u),
a AS (SELECT page_id, i, {H.attr_sql('tag', 'src')} AS src, {H.attr_sql('tag', 'alt')} AS alt FROM t)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, src, alt
FROM a WHERE src <> ''"""


@query("x5_images", _IMG_SQL)
def x5_images(spark, sf):
    return X.images(_pages(spark, sf))


def _heading_sql():
    parts = []
    for n in (1, 2, 3):
        e = H.headings_sql("c", n)
        parts.append(f"""SELECT page_id, {n} AS level, CAST(u.pos - 1 AS INTEGER) AS pos, u.text FROM cp,
            LATERAL (SELECT unnest({e}) AS text, generate_subscripts({e}, 1) AS pos) u""")
    return f"WITH {CLEAN_CTE} " + " UNION ALL ".join(parts)


@query("x6_headings", _heading_sql())
def x6_headings(spark, sf):
    return X.headings(_pages(spark, sf))


_CELLS_SQL = f"""WITH {CLEAN_CTE},
tb AS (SELECT page_id, u.t, u.ti FROM cp,
       LATERAL (SELECT unnest({H.inner_all_sql('c', 'table')}) AS t, generate_subscripts({H.inner_all_sql('c', 'table')}, 1) AS ti) u),
tr AS (SELECT page_id, ti, u.r, u.ri FROM tb,
       LATERAL (SELECT unnest(string_split_regex(t, {lit(H.TR_START_RE2)})[2:]) AS r,
                       generate_subscripts(string_split_regex(t, {lit(H.TR_START_RE2)})[2:], 1) AS ri) u),
td AS (SELECT page_id, ti, ri, u.c2, u.ci FROM tr,
       LATERAL (SELECT unnest(string_split_regex(string_split_regex(r, {lit(H.TR_END)})[1], {lit(H.CELL_START_RE2)})[2:]) AS c2,
                       generate_subscripts(string_split_regex(string_split_regex(r, {lit(H.TR_END)})[1], {lit(H.CELL_START_RE2)})[2:], 1) AS ci) u),
cl AS (SELECT page_id, ti, ri, ci, {H.elem_text_sql(f"string_split_regex(c2, {lit(H.CELL_END)})[1]")} AS text FROM td),
nr AS (SELECT page_id, ti, ri, dense_rank() OVER (PARTITION BY page_id, ti ORDER BY ri) AS rn FROM (SELECT DISTINCT page_id, ti, ri FROM cl)),
nt AS (SELECT page_id, ti, dense_rank() OVER (PARTITION BY page_id ORDER BY ti) AS tn FROM (SELECT DISTINCT page_id, ti FROM cl))
SELECT cl.page_id, CAST(nt.tn - 1 AS INTEGER) AS table_no, CAST(nr.rn - 1 AS INTEGER) AS row_no,
       CAST(cl.ci - 1 AS INTEGER) AS col_no, cl.text
FROM cl JOIN nr USING (page_id, ti, ri) JOIN nt USING (page_id, ti)"""


@query("x7_table_cells", _CELLS_SQL)
def x7_table_cells(spark, sf):
    return X.cells(_pages(spark, sf))


def _list_sql():
    parts = []
    for kind in ("ul", "ol"):
        e = H.list_items_sql("c", kind)
        parts.append(f"""SELECT page_id, '{kind}' AS kind, CAST(u.pos - 1 AS INTEGER) AS pos, u.text FROM cp,
            LATERAL (SELECT unnest({e}) AS text, generate_subscripts({e}, 1) AS pos) u""")
    return f"WITH {CLEAN_CTE} " + " UNION ALL ".join(parts)


@query("x8_list_items", _list_sql())
def x8_list_items(spark, sf):
    return X.list_items(_pages(spark, sf))


# pages made from the orders: a table in a cell and a list in an item, most end tags left out
def _nested_pages(spark, sf):
    from ..session import read_table
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    o = read_table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))  # an order's lines
    k = F.col("l_orderkey").cast("string")
    cells = F.array_join(F.transform("lines", lambda x, i: F.concat(
        F.lit("<tr><td>line "), i + 1, F.lit("<td><b>part "), x["l_partkey"])), "")
    items = F.array_join(F.transform("lines", lambda x: F.concat(F.lit("<li><b>supplier "), x["l_suppkey"])), "")
    return o.select(F.col("l_orderkey").alias("page_id"), F.concat(F.lit("http://orders/"), k).alias("url"), F.concat(
        F.lit("<table><tr><td>order "), k, F.lit("<table>"), cells, F.lit("</table><tr><th>total "), F.size("lines"),
        F.lit("</table><ul><li>order "), k, F.lit("<ul>"), items, F.lit("</ul><li>end</ul>")).alias("html"))


_NESTED_CTE = """ln AS (SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem),
od AS (SELECT k, max(n) AS total, string_agg('line ' || n || 'part ' || p, '' ORDER BY n) AS cell,
              string_agg('supplier ' || s, '' ORDER BY n) AS item FROM ln GROUP BY k)"""


@query("x7_nested_cells", f"""WITH {_NESTED_CTE},
c AS (SELECT k, 0 AS t, 0 AS r, 0 AS c, 'order ' || k || cell AS text FROM od
      UNION ALL SELECT k, 0, 0, 2 * n - 1, 'line ' || n FROM ln UNION ALL SELECT k, 0, 0, 2 * n, 'part ' || p FROM ln
      UNION ALL SELECT k, 0, n, 0, 'line ' || n FROM ln UNION ALL SELECT k, 0, n, 1, 'part ' || p FROM ln
      UNION ALL SELECT k, 0, total + 1, 0, 'total ' || total FROM od
      UNION ALL SELECT k, 1, n - 1, 0, 'line ' || n FROM ln UNION ALL SELECT k, 1, n - 1, 1, 'part ' || p FROM ln)
SELECT k AS page_id, CAST(t AS INTEGER) AS table_no, CAST(r AS INTEGER) AS row_no, CAST(c AS INTEGER) AS col_no, text FROM c""")
def x7_nested_cells(spark, sf):
    """X7 on pages with a table inside a cell: the outer table also holds the inner one's rows and cells."""
    return X.cells(_nested_pages(spark, sf))


@query("x8_nested_items", f"""WITH {_NESTED_CTE},
i AS (SELECT k, 0 AS pos, 'order ' || k || item AS text FROM od UNION ALL SELECT k, 1, 'end' FROM od
      UNION ALL SELECT k, n + 1, 'supplier ' || s FROM ln)
SELECT k AS page_id, 'ul' AS kind, CAST(pos AS INTEGER) AS pos, text FROM i""")
def x8_nested_items(spark, sf):
    """X8 on pages with a list inside an item."""
    return X.list_items(_nested_pages(spark, sf))


_RECORD_FIELDS = ("links", "images", "tables")


@query("x9_page_records", f"""WITH {LINKS_CTE},
lk AS (SELECT page_id, to_json(list(dst_url ORDER BY pos))::VARCHAR AS links_json FROM links GROUP BY page_id),
cells AS ({_CELLS_SQL.replace("WITH " + CLEAN_CTE + ",", "WITH ")}),
rw AS (SELECT page_id, table_no, row_no, list(text ORDER BY col_no) AS r FROM cells GROUP BY ALL),
tl AS (SELECT page_id, table_no, list(r ORDER BY row_no) AS t FROM rw GROUP BY ALL),
tb_all AS (SELECT page_id, to_json(list(t ORDER BY table_no))::VARCHAR AS tables_json FROM tl GROUP BY ALL),
im AS ({_IMG_SQL.replace("WITH " + CLEAN_CTE + ",", "WITH ")}),
ig AS (SELECT page_id, to_json(list({{'src': src, 'alt': alt}} ORDER BY pos))::VARCHAR AS images_json FROM im GROUP BY ALL)
SELECT cp.page_id, cp.url, {H.title_sql('c')} AS title, {H.meta_content_sql('c', 'description')} AS description,
       {H.meta_content_sql('c', 'keywords')} AS keywords, {H.page_text_sql('c')} AS text,
       coalesce(lk.links_json, '[]') AS links_json, coalesce(ig.images_json, '[]') AS images_json,
       coalesce(tb_all.tables_json, '[]') AS tables_json,
       {", ".join(f"to_json({H.headings_sql('c', n)})::VARCHAR AS h{n}_json" for n in (1, 2, 3))},
       {", ".join(f"to_json({H.list_items_sql('c', k)})::VARCHAR AS {k}_json" for k in ("ul", "ol"))}
FROM cp LEFT JOIN lk ON cp.page_id = lk.page_id LEFT JOIN ig ON cp.page_id = ig.page_id LEFT JOIN tb_all ON cp.page_id = tb_all.page_id""")
def x9_page_records(spark, sf):
    """Every field of the page record, nested ones as JSON text."""
    r = X.page_records(_pages(spark, sf))
    return r.select("page_id", "url", "title", "description", "keywords", "text",
                    *(F.to_json(c).alias(f"{c}_json") for c in _RECORD_FIELDS),
                    *(F.to_json(f"headings.h{n}").alias(f"h{n}_json") for n in (1, 2, 3)),
                    *(F.to_json(f"lists.{k}").alias(f"{k}_json") for k in ("ul", "ol")))


@query("x10_tree_parse", f"""WITH {CLEAN_CTE}
SELECT page_id, CAST(len({H.list_items_sql('c', 'ul')}) AS INTEGER) AS n_ul_items,
       to_json({H.list_items_sql('c', 'ul')})::VARCHAR AS ul_json, 0 AS n_tables, false AS has_error FROM cp""")
def x10_tree_parse(spark, sf):
    """X10 on every page: nested structure from expressions that cannot fail; a page whose record is
    missing would show as an error."""
    p = _pages(spark, sf)
    t = X.page_records(p).select("page_id", "tables", "lists")
    x = p.select("page_id").join(t, "page_id", "left")
    return x.select("page_id", F.size("lists.ul").alias("n_ul_items"), F.to_json("lists.ul").alias("ul_json"),
                    F.size("tables").alias("n_tables"), F.col("lists").isNull().alias("has_error"))


@query("x11_corpus_totals", f"""WITH {LINKS_CTE},
lk AS (SELECT count(*) AS links FROM links)
SELECT (SELECT count(*) FROM pages) AS pages, (SELECT links FROM lk) AS links,
       (SELECT coalesce(sum(len(list_filter(list_transform({H.tags_all_sql('c', 'img')},
              lambda t: {H.attr_sql('t', 'src')}), lambda s: s <> ''))), 0) FROM cp) AS images,
       (SELECT coalesce(sum(length({H.page_text_sql('c')})), 0) FROM cp) AS text_chars""")
def x11_corpus_totals(spark, sf):
    return X.corpus_totals(_pages(spark, sf))


@query("x11_page_digest", f"""WITH {LINKS_CTE},
lk AS (SELECT page_id, count(*) AS n_links,
              array_to_string(list(dst_url ORDER BY pos) FILTER (WHERE pos < 5), ' ') AS first_links
       FROM links GROUP BY page_id)
SELECT cp.page_id, cp.url, {H.title_sql('c')} AS title, CAST(coalesce(lk.n_links, 0) AS INTEGER) AS n_links,
       coalesce(lk.first_links, '') AS first_links
FROM cp LEFT JOIN lk ON cp.page_id = lk.page_id""")
def x11_page_digest(spark, sf):
    return X.page_digest(_pages(spark, sf))


# ==== A1–A10 ====================================================================
_END_US = "(epoch_us(ts) + CAST(round(elapsed_s * 1e6) AS BIGINT))"


@query("a1_run_summary", f"""WITH {OUTCOMES_CTE},
a AS (SELECT count(*) AS total_processed, count(*) FILTER (WHERE error_type IS NULL) AS successful_requests,
             count(*) FILTER (WHERE error_type IS NOT NULL) AS failed_requests,
             min(epoch_us(ts)) AS s, max({_END_US}) AS e,
             avg(elapsed_s) FILTER (WHERE error_type IS NULL) AS av FROM outcomes)
SELECT total_processed, successful_requests, failed_requests,
       round(coalesce((e - s) / 1e6, 0.0), 6) AS duration,
       round(coalesce(CASE WHEN e - s = 0 THEN NULL ELSE total_processed / ((e - s) / 1e6) END, 0.0), 6) AS average_speed,
       round(coalesce(av, 0.0), 6) AS avg_response_time,
       make_timestamp(s) AS start_time, make_timestamp(e) AS end_time FROM a""")
def a1_run_summary(spark, sf):
    return A.run_summary(_outcomes(spark, sf))


@query("a2_status_distribution", f"""WITH {OUTCOMES_CTE}
SELECT CASE WHEN error_type IS NULL THEN CAST(status AS VARCHAR) ELSE 'error' END AS status, count(*) AS n
FROM outcomes GROUP BY 1""")
def a2_status_distribution(spark, sf):
    return A.status_distribution(_outcomes(spark, sf))


@query("a3_top_domains", f"""WITH {OUTCOMES_CTE}
SELECT {U.netloc_sql('url')} AS domain, count(*) AS n FROM outcomes WHERE {U.netloc_sql('url')} <> ''
GROUP BY 1 ORDER BY n DESC, domain LIMIT 10""")
def a3_top_domains(spark, sf):
    return A.top_domains(_outcomes(spark, sf))


@query("a3_top_page_domains", f"""SELECT {U.netloc_sql('url')} AS domain, count(*) AS n FROM pages
WHERE {U.netloc_sql('url')} <> '' GROUP BY 1 ORDER BY n DESC, domain LIMIT 10""")
def a3_top_page_domains(spark, sf):
    return A.top_domains(T.pages(spark, sf, with_html=False))


@query("a4_error_counts", f"""WITH {OUTCOMES_CTE}
SELECT error_type, count(*) AS n FROM outcomes WHERE error_type IS NOT NULL GROUP BY 1""")
def a4_error_counts(spark, sf):
    return A.error_counts(_outcomes(spark, sf))


@query("a5_permanent_error_urls", f"""WITH {OUTCOMES_CTE}
SELECT DISTINCT url FROM outcomes WHERE error_type = 'PermanentError'""")
def a5_permanent_error_urls(spark, sf):
    return A.permanent_error_urls(_outcomes(spark, sf))


@query("a6_success_error_split", f"""WITH {OUTCOMES_CTE}
SELECT count(*) FILTER (WHERE error_type IS NULL) AS ok, count(*) FILTER (WHERE error_type IS NOT NULL) AS errors
FROM outcomes""")
def a6_success_error_split(spark, sf):
    return A.success_error_split(_outcomes(spark, sf))


@query("a7_retry_summary", f"""WITH {ATTEMPTS_CTE}
SELECT count(*) FILTER (WHERE ok AND attempt > 1) AS successful_retries,
       coalesce(sum(elapsed_s) FILTER (WHERE ok AND attempt > 1), 0.0) AS total_retry_time,
       coalesce(avg(elapsed_s) FILTER (WHERE ok AND attempt > 1), 0.0) AS mean_retry_time,
       count(*) AS total_attempts FROM attempts""")
def a7_retry_summary(spark, sf):
    return R.retry_summary(_attempts(spark, sf))


@query("a8_last_error_per_url", f"""WITH {OUTCOMES_CTE}
SELECT url, arg_max(error_type || ': ' || CAST(status AS VARCHAR), (ts, event_id)) AS last_error,
       count(*) AS n_failures
FROM outcomes WHERE error_type IS NOT NULL GROUP BY url""")
def a8_last_error_per_url(spark, sf):
    return A.last_error_per_url(_outcomes(spark, sf))


@query("a9_report_table", f"""WITH {OUTCOMES_CTE},
s AS (SELECT CASE WHEN error_type IS NULL THEN CAST(status AS VARCHAR) ELSE 'error' END AS bucket, count(*) AS n
      FROM outcomes GROUP BY 1),
d AS (SELECT {U.netloc_sql('url')} AS bucket, count(*) AS n FROM outcomes WHERE {U.netloc_sql('url')} <> ''
      GROUP BY 1 ORDER BY n DESC, bucket LIMIT 10)
SELECT 'status' AS section, bucket, n, round(n * 100.0 / max(n) OVER (), 1) AS bar_pct FROM s
UNION ALL
SELECT 'domain' AS section, bucket, n, round(n * 100.0 / max(n) OVER (), 1) AS bar_pct FROM d""")
def a9_report_table(spark, sf):
    return A.report_table(_outcomes_table(spark, sf))


@query("a10_error_report", None)
def a10_error_report(spark, sf):
    a = _attempts_table(spark, sf)
    return A.error_report(a, R.outcomes(a))


# ==== W1–W3 =====================================================================
@query("w1_attempt_numbering", f"""WITH {ATTEMPTS_CTE}
SELECT event_id, url, ok, run, attempt, request_no, is_outcome FROM attempts""")
def w1_attempt_numbering(spark, sf):
    return _attempts(spark, sf).select("event_id", "url", "ok", "run", "attempt", "request_no", "is_outcome")


_POLICY_VALUES = "(VALUES ('TransientError', 3, 2.0), ('NetworkError', 3, 2.0), ('RateLimitError', 3, 2.0)) p(pe, class_max, class_factor)"


@query("w2_retry_audit", f"""WITH {ATTEMPTS_CTE},
x AS (SELECT *, first(error_type IGNORE NULLS) OVER (PARTITION BY url, run, request_no ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_error,
             lag(ts) OVER (PARTITION BY url, run, request_no ORDER BY ts, event_id) AS prev_ts FROM attempts),
y AS (SELECT x.*, coalesce(p.class_max, 3) AS cmax, coalesce(p.class_factor, 2.0) AS cf
      FROM x LEFT JOIN {_POLICY_VALUES} ON x.first_error = p.pe)
SELECT event_id, url, ts, attempt, run, request_no, error_type, first_error,
       CAST(cmax AS INTEGER) AS class_max, CAST(cf AS DOUBLE) AS class_factor,
       CASE WHEN NOT ok AND error_type IN ('TransientError', 'NetworkError', 'RateLimitError') AND attempt < cmax
            THEN pow(cf, attempt) ELSE 0.0 END AS expected_delay_s,
       attempt > cmax + 1 AS over_limit,
       (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 AS observed_gap_s
FROM y""")
def w2_retry_audit(spark, sf):
    a = _attempts(spark, sf)
    return R.retry_audit(a, R.policy_table(spark))


@query("w3_adaptive_timeouts", f"""WITH {ATTEMPTS_CTE}
SELECT event_id, url, attempt, elapsed_s,
       least(30.0 * pow(1.5, attempt - 1), 120.0) AS timeout_total,
       least(5.0 * pow(1.5, attempt - 1), 30.0) AS timeout_connect,
       least(5.0 * pow(1.5, attempt - 1), 30.0) AS timeout_read,
       elapsed_s > least(30.0 * pow(1.5, attempt - 1), 120.0) AS timed_out
FROM attempts""")
def w3_adaptive_timeouts(spark, sf):
    return R.adaptive_timeouts(_attempts(spark, sf))


# ==== W4–W9 =====================================================================
# Fixture parameters for the derived log (failures are 1–2 per domain and day):
# breaker window 1 day, threshold 3, cooldown 12 h; limiter defaults otherwise.
BREAKER = dict(threshold=3, window_s=86_400.0, cooldown_s=43_200.0)
# outcome-level failures are rarer than raw rows (most retried requests end in
# success), so the outage fixture uses a wider window and a lower threshold
BREAKER_W7 = dict(threshold=2, window_s=3 * 86_400.0, cooldown_s=86_400.0)
_CAP = 60.0 / (1.0 / 5.0 + 0.5)

_W4_SQL = f"""{OUTCOMES_CTE},
b AS (SELECT *, count(*) OVER (PARTITION BY domain ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cnt FROM outcomes),
c AS (SELECT *, cnt - coalesce(max(CASE WHEN error_type IS NULL THEN cnt END) OVER (PARTITION BY domain ORDER BY ts, event_id
              ROWS UNBOUNDED PRECEDING), 0) AS k FROM b),
w4 AS (SELECT event_id, domain, ts, error_type, CAST(k AS INTEGER) AS fails_since_success,
              round(CASE WHEN k = 0 THEN 1.0 ELSE least(pow(2.0, k), {_CAP!r}) END, 6) AS backoff_multiplier FROM c)"""


@query("w4_backoff_multiplier", f"WITH {_W4_SQL} SELECT * FROM w4")
def w4_backoff_multiplier(spark, sf):
    from ..operators.politeness import backoff
    return backoff(_outcomes_table(spark, sf))


@query("w5_rate_compliance", f"""WITH {_W4_SQL},
p AS (SELECT *, lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) AS prev_ts,
             lag(backoff_multiplier) OVER (PARTITION BY domain ORDER BY ts, event_id) AS prev_m FROM w4),
q AS (SELECT event_id, domain, ts, round((epoch_us(ts) - epoch_us(prev_ts)) / 1e6, 6) AS gap_s,
             round(least(0.5 * coalesce(prev_m, 1.0), 60.0), 6) AS required_gap_s FROM p)
SELECT *, coalesce(gap_s >= required_gap_s, true) AS rate_ok, 1.0 AS crawl_delay,
       coalesce(gap_s >= 1.0, true) AS delay_ok FROM q""")
def w5_rate_compliance(spark, sf):
    from ..operators.politeness import rate_compliance
    return rate_compliance(_outcomes_table(spark, sf))


@query("w5_rate_compliance_global", f"""WITH {_W4_SQL},
p AS (SELECT *, lag(ts) OVER (ORDER BY ts, event_id) AS prev_ts,
             lag(backoff_multiplier) OVER (ORDER BY ts, event_id) AS prev_m FROM w4),
q AS (SELECT event_id, domain, ts, round((epoch_us(ts) - epoch_us(prev_ts)) / 1e6, 6) AS gap_s,
             round(least(0.5 * coalesce(prev_m, 1.0), 60.0), 6) AS required_gap_s FROM p)
SELECT *, coalesce(gap_s >= required_gap_s, true) AS rate_ok, 1.0 AS crawl_delay,
       coalesce(gap_s >= 1.0, true) AS delay_ok FROM q""")
def w5_rate_compliance_global(spark, sf):
    """Global limiter mode; the multiplier is still the per-domain one of W4."""
    from ..operators.politeness import rate_compliance
    return rate_compliance(_outcomes_table(spark, sf), per_domain=False)


@query("w6_rolling_failures", f"""WITH {OUTCOMES_CTE},
x AS (SELECT event_id, domain, ts, coalesce(error_type IS NOT NULL AND error_type <> 'PermanentError', false) AS counting,
             epoch_us(ts) AS us FROM outcomes)
SELECT event_id, domain, ts, counting,
       count(*) FILTER (WHERE counting) OVER (PARTITION BY domain ORDER BY us
            RANGE BETWEEN {int(BREAKER['window_s'] * 1e6)} PRECEDING AND CURRENT ROW)
       - coalesce(count(*) FILTER (WHERE counting) OVER (PARTITION BY domain, us ORDER BY event_id
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS failures_in_window
FROM x""")
def w6_rolling_failures(spark, sf):
    from ..operators.politeness import rolling_failures
    return rolling_failures(_outcomes_table(spark, sf), BREAKER["window_s"])


@query("w7_outages", None)
def w7_outages(spark, sf):
    from ..operators.outages import outages
    return outages(_outcomes_table(spark, sf), **BREAKER_W7).select(
        "domain", "opened_at", "open_until", "opened_by", "failures_while_open")


@query("w7_blocked_flags", None)
def w7_blocked_flags(spark, sf):
    from ..operators.outages import flag_blocked, outages
    o = _outcomes_table(spark, sf)
    return flag_blocked(o, outages(o, **BREAKER_W7))


def _w8_sql(per_domain: bool) -> str:
    part = "PARTITION BY domain" if per_domain else ""
    key = "domain" if per_domain else "'*' AS domain"
    grp = "GROUP BY domain" if per_domain else ""
    lim = 5 if per_domain else 10
    return f"""WITH {ATTEMPTS_CTE},
iv AS (SELECT domain, url, run, request_no, min(epoch_us(ts)) AS start_us,
              max(epoch_us(ts) + CAST(round(elapsed_s * 1e6) AS BIGINT)) AS end_us, min(event_id) AS req_id
       FROM attempts GROUP BY domain, url, run, request_no),
ev AS (SELECT domain, req_id, start_us AS t, 1 AS delta FROM iv
       UNION ALL SELECT domain, req_id, end_us AS t, -1 AS delta FROM iv),
a AS (SELECT *, sum(delta) OVER ({part} ORDER BY t, delta, req_id ROWS UNBOUNDED PRECEDING) AS active FROM ev)
SELECT {key}, max(active) AS peak_active, make_timestamp(arg_max(t, (active, -t))) AS peak_at,
       count(*) FILTER (WHERE delta = 1 AND active > {lim}) AS over_limit_starts, min(active) AS min_active
FROM a {grp}"""


# the derived log's requests last seconds and start minutes apart: times are pressed together so that some overlap
_DENSE = 400


def _dense_sql(per_domain: bool, rest: str) -> str:
    sql = _w8_sql(per_domain)
    head = sql[:sql.rindex("SELECT")].replace("min(epoch_us(ts)) AS start_us", f"min(epoch_us(ts) // {_DENSE}) AS start_us").replace(
        "max(epoch_us(ts) + ", f"max(epoch_us(ts) // {_DENSE} + ")
    return head.rstrip() + rest


def _dense_attempts(spark, sf):
    a = _attempts_table(spark, sf)
    return a.withColumn("ts", F.timestamp_micros(F.floor(F.unix_micros("ts") / _DENSE)))


@query("w8_concurrency_steps", _dense_sql(True, """
SELECT domain, make_timestamp(t) AS at, arg_max(active, (delta, req_id)) AS active FROM a GROUP BY domain, t"""))
def w8_concurrency_steps(spark, sf):
    """The number of active requests of every domain over time."""
    from ..operators.politeness import concurrency_steps
    return concurrency_steps(_dense_attempts(spark, sf), bucket_seconds=600)


_SPANS_SQL = """,
e AS (SELECT *, coalesce(lag(active) OVER ({part} ORDER BY t, delta, req_id), 0) AS prev FROM a),
s AS (SELECT *, sum(CASE WHEN active > {lim} AND prev <= {lim} THEN 1 ELSE 0 END) OVER ({part} ORDER BY t, delta, req_id ROWS UNBOUNDED PRECEDING) AS span
      FROM e WHERE active > {lim} OR prev > {lim})
SELECT {key}, make_timestamp(min(t)) AS span_start, make_timestamp(max(t)) AS span_end, CAST(max(active) AS BIGINT) AS peak_active,
       count(*) FILTER (WHERE active > {lim} AND delta = 1) AS starts FROM s GROUP BY {grp}"""


@query("w8_over_limit_spans", _dense_sql(True, _SPANS_SQL.format(part="PARTITION BY domain", lim=1, key="domain", grp="domain, span")))
def w8_over_limit_spans(spark, sf):
    """Spans with more than one active request of a domain."""
    from ..operators.politeness import over_limit_spans
    return over_limit_spans(_dense_attempts(spark, sf), limit=1, bucket_seconds=600)


@query("w8_over_limit_spans_global", _dense_sql(False, _SPANS_SQL.format(part="", lim=4, key="'*' AS domain", grp="span")))
def w8_over_limit_spans_global(spark, sf):
    """Spans with more than four active requests in the whole log."""
    from ..operators.politeness import over_limit_spans
    return over_limit_spans(_dense_attempts(spark, sf), limit=4, per_domain=False, bucket_seconds=600)


@query("w8_concurrency_domains", _w8_sql(True))
def w8_concurrency_domains(spark, sf):
    from ..operators.politeness import concurrency_profile
    return concurrency_profile(_attempts_table(spark, sf))


@query("w8_concurrency_global", _w8_sql(False))
def w8_concurrency_global(spark, sf):
    from ..operators.politeness import concurrency_profile
    return concurrency_profile(_attempts_table(spark, sf), per_domain=False)


@query("w9_latest_per_domain", f"""WITH {OUTCOMES_CTE}
SELECT event_id, domain, url, ts, status, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ts DESC, event_id DESC) AS rank FROM outcomes)
WHERE rank <= 3""")
def w9_latest_per_domain(spark, sf):
    from ..operators.politeness import latest_per_domain
    return latest_per_domain(_outcomes(spark, sf))


@query("w9_latest_overall", f"""WITH {OUTCOMES_CTE}
SELECT event_id, domain, url, ts, status FROM outcomes ORDER BY ts DESC, event_id DESC LIMIT 3""")
def w9_latest_overall(spark, sf):
    from ..operators.politeness import latest
    return latest(_outcomes(spark, sf).select("event_id", "domain", "url", "ts", "status"))


# ==== S5 / J1–J9 =================================================================
from ..functions.html import WS_CHARS  # noqa: E402
from ..operators import frontier as D  # noqa: E402
from ..operators import robots as RB  # noqa: E402
from ..sources import robots as RS  # noqa: E402

USER_AGENT = "WebloomCrawler/1.0"
_WS = lit(WS_CHARS)


def _page_hosts(spark, sf):
    return (T.pages(spark, sf, with_html=False).select(U.netloc("url").alias("domain"))
            .filter(F.col("domain") != "").distinct())


def _all_hosts(spark, sf):
    return _page_hosts(spark, sf).unionByName(_log(spark, sf).select("domain")).distinct()


_PAGE_HOSTS_SQL = f"SELECT DISTINCT {U.netloc_sql('url')} AS domain FROM pages WHERE {U.netloc_sql('url')} <> ''"
_ALL_HOSTS_SQL = f"{_PAGE_HOSTS_SQL} UNION SELECT DISTINCT domain FROM fetch_log"


def robots_sql(hosts_sql: str, user_agent: str = USER_AGENT) -> str:
    token = lit(user_agent.split("/")[0].lower())
    return f"""robots AS ({RS.robots_fixture_sql(hosts_sql)}),
rl AS (SELECT domain, u.raw, CAST(u.line_no AS INTEGER) AS line_no FROM robots,
       LATERAL (SELECT unnest(string_split_regex(content, {lit(RS.LINE_SPLIT_RE)})) AS raw,
                       generate_subscripts(string_split_regex(content, {lit(RS.LINE_SPLIT_RE)}), 1) - 1 AS line_no) u),
rl2 AS (SELECT *, trim(split_part(raw, '#', 1), {_WS}) AS body FROM rl),
rl3 AS (SELECT *, lower(trim(split_part(body, ':', 1), {_WS})) AS key,
               trim(substr(body, strpos(body, ':') + 1), {_WS}) AS value FROM rl2),
rl4 AS (SELECT *, CASE WHEN raw = '' THEN 'B'
                       WHEN strpos(body, ':') > 0 AND key = 'user-agent' THEN 'U'
                       WHEN strpos(body, ':') > 0 AND key IN ('allow', 'disallow') THEN 'R' ELSE 'O' END AS kind FROM rl3),
rl5 AS (SELECT *, last_value(CASE WHEN kind <> 'O' THEN kind END IGNORE NULLS) OVER
                   (PARTITION BY domain ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_sig,
                  last_value(CASE WHEN kind IN ('B', 'U') THEN kind END IGNORE NULLS) OVER
                   (PARTITION BY domain ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_bu
        FROM rl4),
rl6 AS (SELECT *, CAST(sum(CASE WHEN kind = 'U' AND coalesce(prev_sig <> 'U', true) THEN 1 ELSE 0 END) OVER
                   (PARTITION BY domain ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS INTEGER) AS group_no,
                  kind = 'R' AND coalesce(prev_bu = 'U', false) AS accepted FROM rl5),
rrules AS (SELECT domain, group_no, line_no AS rule_no, (key = 'allow' OR value = '') AS allow, value AS path
           FROM rl6 WHERE accepted),
ragents AS (SELECT domain, group_no, list(value ORDER BY line_no) AS agents FROM rl6 WHERE kind = 'U'
            GROUP BY domain, group_no),
rg0 AS (SELECT a.*, list_contains(agents, '*') AS star FROM ragents a
        WHERE EXISTS (SELECT 1 FROM rrules r WHERE r.domain = a.domain AND r.group_no = a.group_no)),
rg1 AS (SELECT *, star AND group_no = min(CASE WHEN star THEN group_no END) OVER (PARTITION BY domain) AS is_default
        FROM rg0),
rgroups AS (SELECT domain, group_no, agents, is_default FROM rg1 WHERE NOT star OR is_default),
rchosen AS (SELECT domain, coalesce(
                min(group_no) FILTER (WHERE NOT is_default AND len(list_filter(agents, lambda a: strpos({token}, lower(a)) > 0)) > 0),
                min(group_no) FILTER (WHERE is_default)) AS group_no
            FROM rgroups GROUP BY domain),
grules AS (SELECT r.* FROM rrules r JOIN rchosen c ON r.domain = c.domain AND r.group_no = c.group_no)"""


def _url_path_sql(u: str) -> str:
    rest = f"regexp_extract({u}, {lit(RB.PATH_RE)}, 1)"
    return f"CASE WHEN {rest} = '' THEN '/' ELSE {rest} END"


_J6_SQL = f"""WITH {robots_sql(_PAGE_HOSTS_SQL)},
uu AS (SELECT page_id, url, {U.netloc_sql('url')} AS d, {_url_path_sql('url')} AS p FROM pages),
mm AS (SELECT uu.page_id, arg_min(r.allow, r.rule_no) AS allow FROM uu
       JOIN grules r ON r.domain = uu.d AND (r.path = '*' OR starts_with(uu.p, r.path)) GROUP BY uu.page_id),
j6 AS (SELECT uu.page_id, uu.url, coalesce(mm.allow, true) AS allowed FROM uu LEFT JOIN mm ON uu.page_id = mm.page_id)"""


@query("s5_robots_rules", f"""WITH {robots_sql(_PAGE_HOSTS_SQL)}
SELECT r.domain, r.group_no, array_to_string(g.agents, '|') AS agents, g.is_default, r.rule_no, r.allow, r.path
FROM rrules r JOIN rgroups g ON r.domain = g.domain AND r.group_no = g.group_no""")
def s5_robots_rules(spark, sf):
    groups, rules = RS.robots_groups_and_rules(RS.robots_fixture(_page_hosts(spark, sf)))
    return rules.join(groups, ["domain", "group_no"]).select(
        "domain", "group_no", F.array_join("agents", "|").alias("agents"), "is_default", "rule_no", "allow", "path")


@query("j6_robots_allow", f"{_J6_SQL} SELECT * FROM j6")
def j6_robots_allow(spark, sf):
    p = T.pages(spark, sf, with_html=False)
    robots = RS.robots_fixture(_page_hosts(spark, sf))
    return RB.allow_urls(p, robots, USER_AGENT).select("page_id", "url", "allowed")


@query("j7_blocked_by_robots", f"""{_J6_SQL}
SELECT {U.netloc_sql('url')} AS domain, count(*) FILTER (WHERE NOT allowed) AS blocked_by_robots, count(*) AS checked
FROM j6 GROUP BY 1""")
def j7_blocked_by_robots(spark, sf):
    return RB.blocked_counts(j6_robots_allow(spark, sf))


@query("j8_crawl_delay", f"""WITH {LOG_CTE}, {robots_sql(_ALL_HOSTS_SQL)},
hosts AS ({_ALL_HOSTS_SQL}),
cl AS (SELECT domain, line_no, trim(raw, {_WS}) AS s FROM rl),
cd AS (SELECT domain, arg_min(v, line_no) AS crawl_delay FROM
         (SELECT domain, line_no, TRY_CAST(trim(substr(s, 13), {_WS}) AS DOUBLE) AS v FROM cl
          WHERE starts_with(lower(s), 'crawl-delay:')) WHERE v > 0 GROUP BY domain)
SELECT h.domain, coalesce(cd.crawl_delay, 1.0) AS crawl_delay FROM hosts h LEFT JOIN cd ON h.domain = cd.domain""")
def j8_crawl_delay(spark, sf):
    hosts = _all_hosts(spark, sf)
    return RB.domain_delays(hosts, RS.robots_fixture(hosts))


@query("j1_scoped_links", f"""WITH {LINKS_CTE}
SELECT page_id, pos, src_url, dst_url FROM (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS pos, src_url, dst_url
  FROM links WHERE {U.norm_domain_sql('dst_url')} = {U.norm_domain_sql('src_url')}
                OR {U.norm_domain_sql('dst_url')} IN ('example.com'))""")
def j1_scoped_links(spark, sf):
    """filter_external=True with an allow-list: the page's own domain plus the list."""
    return L.link_table(_pages(spark, sf), filter_external=True, allowed_domains=["example.com"])


_SEEDS_SQL = f"SELECT url, page_id AS seed_ord FROM pages WHERE strpos({_url_path_sql('url')}, '/en/') = 1"


def _seeds(spark, sf):
    p = T.pages(spark, sf, with_html=False)
    return p.filter(RB.url_path_key("url").startswith("/en/")).select("url", F.col("page_id").alias("seed_ord"))


@query("j2_same_domain_links", f"""WITH {LINKS_CTE}, seeds AS ({_SEEDS_SQL})
SELECT page_id, pos, src_url, dst_url FROM links
WHERE {U.netloc_sql('dst_url')} IN (SELECT {U.netloc_sql('url')} FROM seeds WHERE {U.netloc_sql('url')} <> '')""")
def j2_same_domain_links(spark, sf):
    lk = L.link_table(_pages(spark, sf))
    return L.same_domain_as_seeds(lk, _seeds(spark, sf), url_col="dst_url")


EXCLUDE = ["/the", "/of"]
INCLUDE = ["/a", "/e"]


@query("j3_exclude_patterns", f"""WITH {LINKS_CTE}
SELECT page_id, pos, src_url, dst_url FROM links
WHERE NOT ({' OR '.join(f"contains(dst_url, {lit(p)})" for p in EXCLUDE)})""")
def j3_exclude_patterns(spark, sf):
    return L.apply_patterns(L.link_table(_pages(spark, sf)), "dst_url", exclude=EXCLUDE)


@query("j4_include_patterns", f"""WITH {LINKS_CTE}
SELECT page_id, pos, src_url, dst_url FROM links
WHERE NOT ({' OR '.join(f"contains(dst_url, {lit(p)})" for p in EXCLUDE)})
  AND ({' OR '.join(f"contains(dst_url, {lit(p)})" for p in INCLUDE)})""")
def j4_include_patterns(spark, sf):
    return L.apply_patterns(L.link_table(_pages(spark, sf)), "dst_url", exclude=EXCLUDE, include=INCLUDE)


# a table of patterns of 3 characters and more from the other tables: customer numbers as last paths, nations, languages
_PATTERNS_SQL = """pats AS (SELECT DISTINCT '/' || c_custkey || '?' AS pattern FROM customer UNION SELECT lower(substr(n_name, 1, 3)) FROM nation
UNION SELECT '/' || lang || '/1' FROM documents WHERE lang IS NOT NULL)"""


def _pattern_table(spark, sf):
    from ..session import read_table
    c = read_table(spark, sf, "customer").select(F.concat(F.lit("/"), "c_custkey", F.lit("?")).alias("pattern"))
    n = read_table(spark, sf, "nation").select(F.lower(F.substring("n_name", 1, 3)))
    d = read_table(spark, sf, "documents").where("lang IS NOT NULL").select(F.concat(F.lit("/"), "lang", F.lit("/1")))
    return c.unionAll(n).unionAll(d).distinct()


@query("j3_exclude_pattern_table", f"""WITH {_PATTERNS_SQL}
SELECT page_id, url FROM pages WHERE NOT EXISTS (SELECT 1 FROM pats WHERE contains(url, pattern))""")
def j3_exclude_pattern_table(spark, sf):
    return L.apply_pattern_table(T.pages(spark, sf, with_html=False).select("page_id", "url"), _pattern_table(spark, sf), "exclude").select(
        "page_id", "url")


@query("j4_include_pattern_table", f"""WITH {_PATTERNS_SQL}
SELECT page_id, url FROM pages WHERE EXISTS (SELECT 1 FROM pats WHERE contains(url, pattern))""")
def j4_include_pattern_table(spark, sf):
    return L.apply_pattern_table(T.pages(spark, sf, with_html=False).select("page_id", "url"), _pattern_table(spark, sf), "include").select(
        "page_id", "url")


@query("j5_unseen_links", f"""WITH {LINKS_CTE}
SELECT DISTINCT dst_url AS url FROM links WHERE dst_url NOT IN (SELECT url FROM pages)""")
def j5_unseen_links(spark, sf):
    lk = L.link_table(_pages(spark, sf)).select(F.col("dst_url").alias("url")).distinct()
    return L.not_yet_seen(lk, T.pages(spark, sf, with_html=False))


@query("j9_outcome_per_page", f"""WITH {OUTCOMES_CTE},
lastout AS (SELECT url, arg_max(status, (ts, event_id)) AS status, arg_max(error_type, (ts, event_id)) AS error_type,
                   max(ts) AS fetched_at FROM outcomes GROUP BY url)
SELECT p.page_id, p.url, CAST(length(p.html) AS INTEGER) AS html_chars, l.status, l.error_type, l.fetched_at
FROM pages p LEFT JOIN lastout l ON p.url = l.url""")
def j9_outcome_per_page(spark, sf):
    o = _outcomes(spark, sf)
    last = o.groupBy("url").agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"),
                                F.max_by("error_type", F.struct("ts", "event_id")).alias("error_type"),
                                F.max("ts").alias("fetched_at"))
    # measure the html before the join, so the shuffle carries no page bodies
    p = T.pages(spark, sf).select("page_id", "url", F.length("html").alias("html_chars"))
    return p.join(last, "url", "left").select("page_id", "url", "html_chars", "status", "error_type", "fetched_at")


# ==== D2–D5 =====================================================================
MAX_DEPTH = 2


def _page_edges(spark, sf):
    return L.link_table(_pages(spark, sf)).select("src_url", "dst_url", "pos")


def _scope(spark, sf):
    seeds = _seeds(spark, sf)

    def f(cand):
        c = L.same_domain_as_seeds(cand, seeds, url_col="url")
        return L.apply_patterns(c, "url", exclude=["/admin", "/private"])
    return f


@query("d2_enqueue_dedup", f"""WITH {LINKS_CTE}, seeds AS ({_SEEDS_SQL}),
offers AS (SELECT url, 0 AS depth, 0 AS priority FROM seeds
           UNION ALL SELECT l.dst_url AS url, 1 AS depth, 1 AS priority FROM links l JOIN seeds s ON l.src_url = s.url)
SELECT url, min(depth) AS depth, min(priority) AS priority, count(*) AS offers FROM offers GROUP BY url""")
def d2_enqueue_dedup(spark, sf):
    seeds = _seeds(spark, sf)
    lk = L.link_table(_pages(spark, sf)).join(seeds.select(F.col("url").alias("src_url")), "src_url", "left_semi")
    offers = (seeds.select("url", F.lit(0).alias("depth"), F.lit(0).alias("priority"))
              .unionByName(lk.select(F.col("dst_url").alias("url"), F.lit(1).alias("depth"), F.lit(1).alias("priority"))))
    return D.enqueue_dedup(offers)


_REACH_PAGES_SQL = f"""WITH RECURSIVE {LINKS_CTE}, seeds AS ({_SEEDS_SQL}),
sd AS (SELECT DISTINCT {U.netloc_sql('url')} AS d FROM seeds WHERE {U.netloc_sql('url')} <> ''),
edges AS (SELECT src_url, dst_url, pos FROM links
          WHERE {U.netloc_sql('dst_url')} IN (SELECT d FROM sd)
            AND NOT (contains(dst_url, '/admin') OR contains(dst_url, '/private'))),
r(url, depth, path) AS (SELECT url, 0, [CAST(seed_ord AS INTEGER)] FROM seeds
     UNION SELECT e.dst_url, r.depth + 1, list_append(r.path, CAST(e.pos AS INTEGER)) FROM r JOIN edges e ON e.src_url = r.url
     WHERE r.depth < {MAX_DEPTH}),
md AS (SELECT url, min(depth) AS depth FROM r GROUP BY url),
reach AS (SELECT md.url, CAST(md.depth AS INTEGER) AS depth, CAST(CASE WHEN md.depth = 0 THEN 0 ELSE 1 END AS INTEGER) AS priority,
                 min(r.path) AS path
          FROM md JOIN r ON r.url = md.url AND r.depth = md.depth GROUP BY md.url, md.depth)"""


def _reach_pages(spark, sf):
    return D.reach(_seeds(spark, sf), _page_edges(spark, sf), MAX_DEPTH, link_filter=_scope(spark, sf))


@query("d3_reach_pages", f"{_REACH_PAGES_SQL} SELECT url, depth, priority FROM reach")
def d3_reach_pages(spark, sf):
    return _reach_pages(spark, sf).select("url", "depth", "priority")


@query("d4_page_budget", f"""{_REACH_PAGES_SQL}
SELECT url, depth, priority, array_to_string(path, ',') AS path
FROM (SELECT *, row_number() OVER (ORDER BY priority, depth, path, url) AS rk FROM reach) WHERE rk <= 100""")
def d4_page_budget(spark, sf):
    b = D.budget(_reach_pages(spark, sf), 100)
    return b.select("url", "depth", "priority", F.array_join("path", ",").alias("path"))


@query("d5_frontier_counts", f"""{_REACH_PAGES_SQL},
top AS (SELECT url FROM reach WHERE depth <= {MAX_DEPTH} ORDER BY priority, depth, path, url LIMIT 100),
st AS (SELECT r.url, CASE WHEN r.depth > {MAX_DEPTH} THEN 'dropped_depth'
                          WHEN t.url IS NOT NULL AND r.url IN (SELECT url FROM pages) THEN 'processed'
                          WHEN t.url IS NOT NULL THEN 'failed' ELSE 'pending' END AS state
       FROM reach r LEFT JOIN top t ON r.url = t.url)
SELECT count(*) AS total_added, count(*) FILTER (WHERE state = 'processed') AS processed,
       count(*) FILTER (WHERE state = 'failed') AS failed, count(*) FILTER (WHERE state = 'pending') AS pending,
       count(*) FILTER (WHERE state = 'dropped_depth') AS dropped_depth,
       count(*) FILTER (WHERE state IN ('processed', 'failed')) AS visited FROM st""")
def d5_frontier_counts(spark, sf):
    r = _reach_pages(spark, sf)
    return D.state_counts(D.url_states(r, T.pages(spark, sf, with_html=False), MAX_DEPTH, 100))


# lineitem as a deep graph: part <-> supplier, seeds = suppliers of one nation
_PARTS_EDGES_SQL = """edges AS (SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS src_url, 's' || CAST(l_suppkey AS VARCHAR) AS dst_url FROM lineitem
          UNION SELECT DISTINCT 's' || CAST(l_suppkey AS VARCHAR), 'p' || CAST(l_partkey AS VARCHAR) FROM lineitem)"""
PARTS_DEPTH = 4
SEED_NATION = 'NATION_7'


@query("d3_reach_parts", f"""WITH RECURSIVE {_PARTS_EDGES_SQL},
seeds AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS url FROM supplier JOIN nation ON s_nationkey = n_nationkey
          WHERE n_name = 'NATION_7'),
r(url, depth) AS (SELECT url, 0 FROM seeds UNION SELECT e.dst_url, r.depth + 1 FROM r JOIN edges e ON e.src_url = r.url
                  WHERE r.depth < {PARTS_DEPTH})
SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY url""")
def d3_reach_parts(spark, sf):
    from ..session import read_table
    li = read_table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    p = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    edges = (li.select(p.alias("src_url"), s.alias("dst_url"))
             .unionByName(li.select(s.alias("src_url"), p.alias("dst_url")))
             .withColumn("pos", F.lit(0)))
    sup = read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nat = read_table(spark, sf, "nation").filter(F.col("n_name") == SEED_NATION).select("n_nationkey")
    seeds = (sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"], "left_semi")
             .select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("url"),
                     F.col("s_suppkey").alias("seed_ord")))
    return D.reach(seeds, edges, PARTS_DEPTH).select("url", "depth")


# ==== S6 / S7 / D6 ===============================================================
from ..sources import sitemaps as SM  # noqa: E402

_X_ESC = "replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_SITEMAP_FIXTURE_SQL = f"""sp AS (SELECT page_id, url, {U.netloc_sql('url')} AS host FROM pages WHERE {U.netloc_sql('url')} <> ''),
leaf AS (SELECT host, 'https://' || host || '/sitemap-0.xml' AS sitemap_url,
                {lit(SM.URLSET_HEAD)} || string_agg('<url><loc>' || {_X_ESC} || '</loc></url>', '' ORDER BY page_id) || '</urlset>' AS xml,
                regexp_extract(host, {lit(r'\.([^.]+)$')}, 1) AS tld
         FROM sp GROUP BY host),
mid AS (SELECT 'https://sitemaps.example/' || tld || '-index-0.xml' AS sitemap_url,
               {lit(SM.INDEX_HEAD)} || string_agg('<sitemap><loc>' || sitemap_url || '</loc></sitemap>', '' ORDER BY sitemap_url)
               || '<sitemap><loc>{SM.TOP_SITEMAP}</loc></sitemap></sitemapindex>' AS xml
        FROM leaf GROUP BY tld),
sitemaps AS (SELECT sitemap_url, xml FROM leaf UNION ALL SELECT sitemap_url, xml FROM mid
             UNION ALL SELECT '{SM.TOP_SITEMAP}',
                 {lit(SM.INDEX_HEAD)} || string_agg('<sitemap><loc>' || sitemap_url || '</loc></sitemap>', '' ORDER BY sitemap_url)
                 || '</sitemapindex>' FROM mid)"""


def _sitemaps(spark, sf):
    return SM.sitemap_fixture(T.pages(spark, sf, with_html=False))


@query("s6_sitemap_fixture", f"WITH {_SITEMAP_FIXTURE_SQL} SELECT sitemap_url, xml FROM sitemaps")
def s6_sitemap_fixture(spark, sf):
    return _sitemaps(spark, sf)


def _locs_sql(x: str) -> str:
    ent = "t"
    for a, b in SM.XML_ENTITIES:
        ent = f"replace({ent}, {lit(a)}, {lit(b)})"
    text = f"CASE WHEN regexp_matches(t, {lit(SM.CDATA_RE)}) THEN regexp_extract(t, {lit(SM.CDATA_RE)}, 1) ELSE {ent} END"
    return (f"CASE WHEN regexp_matches({x}, {lit(SM.CLOSED_RE)}) AND regexp_matches({x}, {lit(SM.NS_RE)}) "
            f"THEN list_filter(list_transform(regexp_extract_all({x}, {lit(SM.LOC_RE)}, 1), lambda t: {text}), "
            f"lambda t: t <> '') ELSE []::VARCHAR[] END")


# every walk from the root that repeats no sitemap of its own trail; a sitemap is expanded
# at its smallest position path, where a depth-first walk meets it first
_EXPAND_SQL = f"""docs AS (SELECT sitemap_url, regexp_matches(lower(xml), {lit(SM.INDEX_RE)}) AS is_index, {_locs_sql('xml')} AS locs
               FROM sitemaps),
walk AS (SELECT '{SM.TOP_SITEMAP}' AS root, '{SM.TOP_SITEMAP}' AS sitemap_url, []::INTEGER[] AS path, ['{SM.TOP_SITEMAP}'] AS trail,
                0 AS level
         UNION ALL
         SELECT w.root, u.loc, list_append(w.path, CAST(u.p - 1 AS INTEGER)), list_append(w.trail, u.loc), w.level + 1
         FROM walk w JOIN docs d ON w.sitemap_url = d.sitemap_url AND d.is_index,
              LATERAL (SELECT unnest(d.locs) AS loc, generate_subscripts(d.locs, 1) AS p) u
         WHERE NOT list_contains(w.trail, u.loc)),
visits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY root, sitemap_url ORDER BY path) AS k FROM walk) WHERE k = 1),
leaves AS (SELECT v.root, v.sitemap_url AS via, list_append(v.path, CAST(u.p - 1 AS INTEGER)) AS path, u.loc AS url
           FROM visits v JOIN docs d ON v.sitemap_url = d.sitemap_url AND NOT d.is_index,
                LATERAL (SELECT unnest(d.locs) AS loc, generate_subscripts(d.locs, 1) AS p) u)"""


@query("s6_sitemap_expand", f"""WITH RECURSIVE {_SITEMAP_FIXTURE_SQL}, {_EXPAND_SQL}
SELECT root, CAST(row_number() OVER (PARTITION BY root ORDER BY path, url) - 1 AS INTEGER) AS pos, url, via FROM leaves""")
def s6_sitemap_expand(spark, sf):
    roots = spark.range(1).select(F.lit(SM.TOP_SITEMAP).alias("root"))
    return SM.expand(_sitemaps(spark, sf), roots).select("root", F.col("pos").cast("int").alias("pos"), "url", "via")


@query("s7_flat_locs", f"""WITH {_SITEMAP_FIXTURE_SQL}
SELECT sitemap_url, CAST(u.p - 1 AS INTEGER) AS pos, u.url FROM sitemaps,
  LATERAL (SELECT unnest(regexp_extract_all(xml, {lit(SM.FLAT_LOC_RE)}, 1)) AS url,
                  generate_subscripts(regexp_extract_all(xml, {lit(SM.FLAT_LOC_RE)}, 1), 1) AS p) u""")
def s7_flat_locs(spark, sf):
    return SM.flat_locs(_sitemaps(spark, sf))


# ==== K1–K8 =====================================================================
from ..sinks import records as K  # noqa: E402


def _records(spark, sf):
    return K.page_records_to_crawl_records(X.page_records(_pages(spark, sf)))


_META_JSON = f"to_json(MAP {{'description': {H.meta_content_sql('c', 'description')}, 'keywords': {H.meta_content_sql('c', 'keywords')}}})::VARCHAR"
_HEAD_JSON = ("to_json({'h1': " + H.headings_sql('c', 1) + ", 'h2': " + H.headings_sql('c', 2) + ", 'h3': "
              + H.headings_sql('c', 3) + "})::VARCHAR")
_REC_SQL = f"""{LINKS_CTE},
lk AS (SELECT page_id, to_json(list(dst_url ORDER BY pos))::VARCHAR AS links_json, count(*) AS n_links
       FROM links GROUP BY page_id),
rec AS (SELECT cp.url, {H.title_sql('c')} AS title, {H.page_text_sql('c')} AS text,
               coalesce(lk.links_json, '[]') AS links, CAST(coalesce(lk.n_links, 0) AS INTEGER) AS n_links,
               {_META_JSON} AS metadata, {_HEAD_JSON} AS headings
        FROM cp LEFT JOIN lk ON cp.page_id = lk.page_id)"""


# every field of a stored record but its time, nested ones as JSON text
_FULL_SQL = f"""{_REC_SQL},
im AS ({_IMG_SQL.replace("WITH " + CLEAN_CTE + ",", "WITH ")}),
ig AS (SELECT page_id, to_json(list({{'src': src, 'alt': alt}} ORDER BY pos))::VARCHAR AS images FROM im GROUP BY ALL),
full_rec AS (SELECT rec.url, rec.title, rec.text, CAST(length(rec.text) AS INTEGER) AS text_length, rec.links, coalesce(ig.images, '[]') AS images,
                    rec.headings, rec.metadata, '' AS error, 200 AS status_code, 'text/html' AS content_type
             FROM rec JOIN cp ON rec.url = cp.url LEFT JOIN ig ON cp.page_id = ig.page_id)"""


def _flat(df):
    """Nested columns as JSON text, in one form whichever sink they come from."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
    return df.withColumns({c: F.to_json(c) for c in nested})


_RECORD_COLS = ["url", "title", "text", "text_length", "links", "images", "headings", "metadata", "error", "status_code", "content_type"]
_CSV_COLS = [c for c in _RECORD_COLS if c != "images"]


@query("k2_csv_rows", f"""WITH {_REC_SQL}
SELECT url, title, text, links, metadata, '' AS crawled_at, '200' AS status_code, 'text/html' AS content_type,
       CAST(length(text) AS VARCHAR) AS text_length, '0' AS images_count, headings, '' AS error FROM rec""")
def k2_csv_rows(spark, sf):
    return K.csv_rows(_records(spark, sf))


@query("k5_crawl_records", f"""WITH {_REC_SQL}
SELECT url, title, CAST(length(text) AS INTEGER) AS text_length, n_links, metadata AS metadata_json,
       '' AS error, 200 AS status_code, 'text/html' AS content_type FROM rec""")
def k5_crawl_records(spark, sf):
    r = _records(spark, sf)
    return r.select("url", "title", "text_length", F.size("links").alias("n_links"),
                    F.to_json("metadata").alias("metadata_json"), "error", "status_code", "content_type")


_FAILED_SQL = f"""{OUTCOMES_CTE},
failed AS (SELECT url, arg_max(error_type || ': ' || CAST(status AS VARCHAR), (ts, event_id)) AS error, max(ts) AS crawled_at
           FROM outcomes WHERE error_type IS NOT NULL GROUP BY url)"""


def _failed(spark, sf):
    o = _outcomes(spark, sf).filter(F.col("error_type").isNotNull())
    return o.groupBy("url").agg(
        F.max_by(F.concat("error_type", F.lit(": "), F.col("status").cast("string")), F.struct("ts", "event_id"))
        .alias("error"), F.max("ts").alias("crawled_at"))


@query("k6_records_with_errors", f"""WITH {_REC_SQL}, {_FAILED_SQL.split(',', 1)[0]}, {_FAILED_SQL.split(',', 1)[1]}
SELECT url, title, CAST(length(text) AS INTEGER) AS text_length, 200 AS status_code, '' AS error FROM rec
UNION ALL SELECT url, '' AS title, 0 AS text_length, 0 AS status_code, error FROM failed""")
def k6_records_with_errors(spark, sf):
    u = K.union_records(_records(spark, sf), K.error_records(_failed(spark, sf)))
    return u.select("url", "title", "text_length", "status_code", "error")


@query("k7_result_digest", f"""WITH {_FAILED_SQL}
SELECT url, coalesce(html, '') AS content FROM pages
UNION ALL SELECT url, error AS content FROM failed""")
def k7_result_digest(spark, sf):
    ok = T.pages(spark, sf).select("url", "html", F.lit(None).cast("string").alias("error"))
    bad = _failed(spark, sf).select("url", F.lit(None).cast("string").alias("html"), "error")
    return K.result_digest(ok.unionByName(bad))


@query("k8_run_stats", f"""WITH {OUTCOMES_CTE},
a1 AS (SELECT count(*) AS total_processed, count(*) FILTER (WHERE error_type IS NULL) AS successful_requests,
              count(*) FILTER (WHERE error_type IS NOT NULL) AS failed_requests,
              min(epoch_us(ts)) AS s, max({_END_US}) AS e, avg(elapsed_s) FILTER (WHERE error_type IS NULL) AS av FROM outcomes),
a AS (SELECT total_processed, successful_requests, failed_requests, round(coalesce((e - s) / 1e6, 0.0), 6) AS duration,
             round(coalesce(CASE WHEN e - s = 0 THEN NULL ELSE total_processed / ((e - s) / 1e6) END, 0.0), 6) AS average_speed,
             round(coalesce(av, 0.0), 6) AS avg_response_time, make_timestamp(s) AS start_time, make_timestamp(e) AS end_time FROM a1),
s AS (SELECT to_json(map_from_entries(list((status, n) ORDER BY status)))::VARCHAR AS status_code_distribution
      FROM (SELECT CASE WHEN error_type IS NULL THEN CAST(status AS VARCHAR) ELSE 'error' END AS status, count(*) AS n
            FROM outcomes GROUP BY 1)),
t AS (SELECT to_json(list({{'domain': domain, 'count': n}} ORDER BY n DESC, domain))::VARCHAR AS top_domains
      FROM (SELECT {U.netloc_sql('url')} AS domain, count(*) AS n FROM outcomes WHERE {U.netloc_sql('url')} <> ''
            GROUP BY 1 ORDER BY n DESC, domain LIMIT 10))
SELECT * FROM a, s, t""")
def k8_run_stats(spark, sf):
    r = K.run_stats_row(_outcomes_table(spark, sf))
    return r.withColumns({c: F.to_json(c) for c in ("status_code_distribution", "top_domains")})


# ==== T1–T6 (streams run to completion over the derived log) ===================
def _log_folder(spark, sf, outcomes_only: bool = False):
    """The stream source: the derived log written as files (attempt rows, or
    one outcome row per request as the crawler's stats/breaker see them)."""
    from ..sources.fetchlog import FETCH_LOG_SCHEMA
    from ..streaming.jobs import scratch_path
    path = scratch_path(spark, "fetch-log")
    cols = [c.split()[0] for c in FETCH_LOG_SCHEMA.split(", ")]
    src = _outcomes(spark, sf) if outcomes_only else _log(spark, sf)
    src.select(*cols).write.mode("overwrite").parquet(path)
    return path


def _run_stream(spark, sf, build, mode="append", outcomes_only: bool = False):
    from ..streaming.jobs import fetch_log_stream, run_available, scratch_path
    src = _log_folder(spark, sf, outcomes_only)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    run_available(build(fetch_log_stream(spark, src)), out, ck, mode)
    return spark.read.parquet(out)


def _run_latest(spark, sf, build, keys):
    """Run an aggregation in update mode and keep each group's last version."""
    from ..streaming.jobs import fetch_log_stream, latest_versions, run_versions, scratch_path
    out = scratch_path(spark, "versions")
    run_versions(build(fetch_log_stream(spark, _log_folder(spark, sf))), out, scratch_path(spark, "ckpt"))
    return latest_versions(spark, out, keys)


@query("t1_progress_stream", f"""WITH {LOG_CTE}
SELECT date_trunc('second', ts) AS window_start, count(*) AS requests,
       count(*) FILTER (WHERE error_type IS NULL) AS pages, count(*) FILTER (WHERE error_type IS NOT NULL) AS errors,
       round(avg(elapsed_s) FILTER (WHERE error_type IS NULL), 6) AS mean_latency_s,
       round(count(*) / 1.0, 6) AS rate_per_s
FROM fetch_log GROUP BY 1""")
def t1_progress_stream(spark, sf):
    from ..streaming.jobs import progress
    return _run_latest(spark, sf, progress, ["window_start"])


TARGET_PAGES = 5000


@query("t1_progress_to_target", f"""WITH {LOG_CTE},
w AS (SELECT date_trunc('second', ts) AS window_start, count(*) AS requests,
             count(*) FILTER (WHERE error_type IS NULL) AS pages, count(*) FILTER (WHERE error_type IS NOT NULL) AS errors,
             round(avg(elapsed_s) FILTER (WHERE error_type IS NULL), 6) AS mean_latency_s, round(count(*) / 1.0, 6) AS rate_per_s
      FROM fetch_log GROUP BY 1),
c AS (SELECT *, CAST(sum(pages) OVER (ORDER BY window_start) AS BIGINT) AS pages_done FROM w)
SELECT *, round(least(pages_done * 100.0 / {TARGET_PAGES}, 100.0), 3) AS pct_of_target,
       round(greatest({TARGET_PAGES} - pages_done, 0) / rate_per_s, 3) AS eta_s FROM c""")
def t1_progress_to_target(spark, sf):
    """Share of the page target and time left after every window of the log."""
    from ..streaming.jobs import progress, progress_to_target
    return progress_to_target(progress(_log(spark, sf)), TARGET_PAGES)


@query("t2_dedup_stream", f"WITH {LOG_CTE} SELECT DISTINCT url FROM fetch_log")
def t2_dedup_stream(spark, sf):
    from ..streaming.jobs import dedup_urls
    return _run_stream(spark, sf, lambda s: dedup_urls(s, exact=True).select("url", "event_id")).select("url")


def _run_carried(spark, sf, body, parts: int = 4, **kw):
    """The outcome log as ``parts`` files in time order, one micro-batch each, through a job that carries
    its state in tables; returns what all micro-batches wrote."""
    from ..sources.fetchlog import FETCH_LOG_SCHEMA
    from ..streaming.jobs import fetch_log_stream, run_batches, scratch_path
    src, out, state, late, ck = (scratch_path(spark, n) for n in ("log-parts", "out", "state", "late", "ckpt"))
    log = _outcomes_table(spark, sf).select(*[c.split()[0] for c in FETCH_LOG_SCHEMA.split(", ")])
    t = F.unix_micros("ts")
    lo, hi = log.agg(F.min(t), F.max(t)).first()
    for i in range(parts if lo is not None else 0):
        a, b = (lo + (hi + 1 - lo) * k // parts for k in (i, i + 1))
        log.where((t >= a) & (t < b)).coalesce(1).write.mode("append").parquet(src)
    if lo is None:
        log.write.parquet(src)
    run_batches(fetch_log_stream(spark, src, max_files_per_trigger=1), body(spark, out, state, late, **kw), ck)
    return out, late


@query("t3_outage_stream", None)
def t3_outage_stream(spark, sf):
    from ..streaming.jobs import OUTAGE_OUT, final_outages, outage_batches
    out, _ = _run_carried(spark, sf, outage_batches, **BREAKER_W7)
    return final_outages(spark.read.schema(OUTAGE_OUT).parquet(out))


@query("t4_rate_state_stream", None)
def t4_rate_state_stream(spark, sf):
    from ..streaming.jobs import rate_batches
    out, _ = _run_carried(spark, sf, rate_batches)
    return spark.read.parquet(out).drop("batch")


@query("t5_extraction_stream", f"""WITH {_FULL_SQL}
SELECT 'jsonl' AS sink, {", ".join(_CSV_COLS)} FROM full_rec UNION ALL SELECT 'csv' AS sink, {", ".join(_CSV_COLS)} FROM full_rec
UNION ALL SELECT 'table' AS sink, {", ".join(_CSV_COLS)} FROM full_rec""")
def t5_extraction_stream(spark, sf):
    """Page stream to whole records, every micro-batch to all three sinks, read back."""
    import uuid

    from ..streaming.jobs import extraction_batches, pages_stream, run_batches, scratch_path
    a, b, c, ck = (scratch_path(spark, n) for n in ("t5-jsonl", "t5-csv", "t5-table", "t5-ckpt"))
    name = f"crawled_stream_{uuid.uuid4().hex[:8]}"
    sinks = [K.jsonl_sink(a), K.csv_sink(b), K.table_sink(spark, name, path=c)]
    run_batches(pages_stream(spark, sf.rstrip("/") + "/{pages.parquet}"), extraction_batches(sinks), ck)
    out = None
    for sink, df in (("jsonl", K.read_jsonl(spark, a)), ("csv", K.read_csv(spark, b)), ("table", spark.table(name))):
        x = _flat(df).select(F.lit(sink).alias("sink"), *_CSV_COLS)
        out = x if out is None else out.unionByName(x)
    return out


@query("t6_error_counters_stream", f"""WITH {LOG_CTE}
SELECT date_trunc('hour', ts) AS window_start, error_type, count(*) AS n FROM fetch_log
WHERE error_type IS NOT NULL GROUP BY 1, 2""")
def t6_error_counters_stream(spark, sf):
    from ..streaming.jobs import error_counters
    return _run_latest(spark, sf, error_counters, ["window_start", "error_type"])


# ==== D1 / D6 / X7 oracle ========================================================
@query("d1_link_dedup", f"""WITH {HREF_CTE},
v AS (SELECT page_id, resolved FROM rs WHERE resolved IS NOT NULL AND {U.is_valid_url_sql('resolved')})
SELECT page_id, count(*) AS n_valid, count(DISTINCT resolved) AS n_unique, count(*) - count(DISTINCT resolved) AS n_dropped
FROM v GROUP BY page_id""")
def d1_link_dedup(spark, sf):
    """Order-preserving in-page dedup: valid links before and after."""
    r = L.raw_link_table(_pages(spark, sf)).filter("valid")
    return r.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_valid"),
                                    F.count_distinct("resolved").alias("n_unique"),
                                    (F.count(F.lit(1)) - F.count_distinct("resolved")).alias("n_dropped"))


@query("d6_sitemap_visits", f"""WITH RECURSIVE {_SITEMAP_FIXTURE_SQL}, {_EXPAND_SQL}
SELECT root, sitemap_url, level FROM visits""")
def d6_sitemap_visits(spark, sf):
    roots = spark.range(1).select(F.lit(SM.TOP_SITEMAP).alias("root"))
    return SM.expand(_sitemaps(spark, sf), roots, visits=True).select(
        "root", "sitemap_url", F.col("level").cast("int").alias("level"))


# ==== S2–S4 / K1 / K3 / K4 round trips (write with the sink, read with the reader) ==
def _scratch(spark, name):
    from ..streaming.jobs import scratch_path
    return scratch_path(spark, name)


_TITLES_CTE = f"{CLEAN_CTE}, titles AS (SELECT url, {H.title_sql('c')} AS title FROM cp)"


@query("s2_jsonl_scan", f"""WITH {_FULL_SQL}
SELECT {", ".join(_RECORD_COLS)}, CAST(NULL AS VARCHAR) AS bad_line FROM full_rec
UNION ALL SELECT {", ".join("NULL" for _ in _RECORD_COLS)}, '{{"url":"' || url AS bad_line FROM full_rec""")
def s2_jsonl_scan(spark, sf):
    """K1 JSONL sink of the page records, and a folder of lines cut off in their first value, read
    back together by the S2 reader: bad lines come out as they are."""
    path = _scratch(spark, "jsonl")
    rec = _records(spark, sf)
    K.jsonl_sink(f"{path}/part=good")(rec)
    rec.select(F.concat(F.lit('{"url":"'), "url").alias("value")).write.text(f"{path}/part=cut")
    r = _flat(K.read_jsonl(spark, path).drop("part"))
    bad = F.col("_corrupt_record").isNotNull()
    return r.select(*(F.when(~bad, F.col(c)).alias(c) for c in _RECORD_COLS), F.col("_corrupt_record").alias("bad_line"))


@query("s3_csv_scan", f"""WITH {_REC_SQL}
SELECT url, title, CAST(length(text) AS INTEGER) AS text_length, 0 AS images_count, n_links,
       json_extract_string(headings, '$.h1[0]') AS h1
FROM rec""")
def s3_csv_scan(spark, sf):
    """K2 CSV sink of the page records, read back by the S3 reader (JSON cells decoded)."""
    path = _scratch(spark, "csv")
    K.csv_sink(path)(_records(spark, sf))
    r = K.read_csv(spark, path)
    return r.select("url", "title", "text_length", "images_count", F.size("links").alias("n_links"),
                    F.try_element_at("headings.h1", F.lit(1)).alias("h1"))


@query("s4_table_latest", f"""WITH {_TITLES_CTE}
SELECT url, title FROM titles ORDER BY url DESC LIMIT 10""")
def s4_table_latest(spark, sf):
    """K3 table sink (bucketed by url, files in the shared folder), every record appended in url order: the
    lower half of the urls, then the upper one; then the S4 scan: projection, newest id first, limit."""
    import uuid
    name = f"crawled_data_{uuid.uuid4().hex[:8]}"
    sink, pages = K.table_sink(spark, name, path=_scratch(spark, "table")), _pages(spark, sf)
    url, middle = F.col("url"), F.lit(_middle(T.pages(spark, sf, with_html=False), "url")).cast("string")
    for half in (url.isNull() | (url < middle), url >= middle):
        rec = K.page_records_to_crawl_records(X.page_records(pages.where(half)))
        sink(rec.orderBy("url"))
    return K.latest_from_table(spark, name, 10, order=("id",)).select("url", "title")


def _middle(df, column):
    """A value with about half of the rows before it (None if there is no value): the least of the middle one
    of Spark's ranges, of which the driver sees one row each."""
    from itertools import accumulate
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = (df.select(column).where(F.col(column).isNotNull()).repartitionByRange(n, column)
              .groupBy(F.spark_partition_id().alias("part")).agg(F.min(column).alias("least"), F.count(F.lit(1)).alias("n")))
    found = sorted((r["least"], r["n"]) for r in ranges.collect())
    before = list(accumulate((rows for _, rows in found), initial=0))
    return max((least for (least, _), rows in zip(found, before, strict=False) if 2 * rows <= before[-1]), default=None)


@query("k4_fan_out", f"""WITH {_FULL_SQL}
SELECT 'jsonl' AS sink, {", ".join(_CSV_COLS)} FROM full_rec UNION ALL SELECT 'csv' AS sink, {", ".join(_CSV_COLS)} FROM full_rec""")
def k4_fan_out(spark, sf):
    """One result written to two sinks (computed once), every field read back."""
    a, b = _scratch(spark, "fan-jsonl"), _scratch(spark, "fan-csv")
    K.fan_out(_records(spark, sf), [K.jsonl_sink(a), K.csv_sink(b)])
    return (_flat(K.read_jsonl(spark, a)).select(F.lit("jsonl").alias("sink"), *_CSV_COLS)
            .unionByName(_flat(K.read_csv(spark, b)).select(F.lit("csv").alias("sink"), *_CSV_COLS)))


@query("s8_log_stream", f"WITH {LOG_CTE} SELECT event_id, url, domain, ts, status, error_type FROM fetch_log")
def s8_log_stream(spark, sf):
    """The fetch log as a file-source stream (explicit schema), passed
    through to files with availableNow and read back."""
    return _run_stream(spark, sf, lambda s: s.select("event_id", "url", "domain", "ts", "status", "error_type"))


@query("k1_jsonl_sink", f"""WITH {_FULL_SQL} SELECT {", ".join(_RECORD_COLS)}, true AS has_crawled_at FROM full_rec""")
def k1_jsonl_sink(spark, sf):
    """K1: whole records as JSON lines (one object per line, never indented), with
    ``crawled_at`` filled where the record has none; read back from text lines."""
    path = _scratch(spark, "k1")
    K.jsonl_sink(path)(_records(spark, sf))
    obj = F.from_json("value", K.CRAWL_RECORD.replace("crawled_at TIMESTAMP", "crawled_at STRING"))
    return _flat(spark.read.text(path).select(obj.alias("o")).select("o.*")).select(
        *_RECORD_COLS, F.col("crawled_at").isNotNull().alias("has_crawled_at"))


@query("k3_table_sink", f"""WITH {_FULL_SQL} SELECT {", ".join(_RECORD_COLS)} FROM full_rec""")
def k3_table_sink(spark, sf):
    """K3: append to a url-bucketed Parquet table; every stored row and field read back."""
    import uuid
    name = f"crawled_data_{uuid.uuid4().hex[:8]}"
    K.table_sink(spark, name, path=_scratch(spark, "k3"))(_records(spark, sf))
    return _flat(spark.table(name)).select(*_RECORD_COLS)


@query("k3_url_lookup", f"""WITH {_FULL_SQL}, w AS (SELECT DISTINCT url FROM pages WHERE url LIKE '%#%')
SELECT w.url, title, text_length, status_code FROM w JOIN full_rec USING (url)""")
def k3_url_lookup(spark, sf):
    """The stored records of a table of URLs (those with a fragment): bucket against bucket, the stored table is not shuffled."""
    import uuid
    name = f"crawled_data_{uuid.uuid4().hex[:8]}"
    K.table_sink(spark, name, path=_scratch(spark, "k3-lookup"))(_records(spark, sf))
    wanted = T.pages(spark, sf, with_html=False).select("url").where(F.col("url").contains("#")).distinct()
    return K.lookup_urls(spark, name, wanted).select("url", "title", "text_length", "status_code")


# ==== W7 oracle: the breaker replayed by a recursive CTE, one step per failure ====
def _w7_sql(threshold: int, window_s: float, cooldown_s: float) -> str:
    w, c = int(window_s * 1e6), int(cooldown_s * 1e6)
    closing = "(r.open_until IS NOT NULL AND f.t >= r.open_until)"
    base_recent = f"(CASE WHEN {closing} THEN []::BIGINT[] ELSE r.recent END)"
    base_open = f"(CASE WHEN {closing} THEN NULL ELSE r.open_until END)"
    recent2 = f"list_filter(list_append({base_recent}, f.t), lambda x: x >= f.t - {w})"
    opens = f"(len({recent2}) >= {threshold})"
    new_open = f"(CASE WHEN {opens} THEN f.t + {c} ELSE {base_open} END)"
    starts = f"({opens} AND {base_open} IS NULL)"
    return f"""WITH RECURSIVE {OUTCOMES_CTE},
f AS (SELECT domain, epoch_us(ts) AS t, event_id,
             row_number() OVER (PARTITION BY domain ORDER BY ts, event_id) AS i
      FROM outcomes WHERE error_type IS NOT NULL AND error_type <> 'PermanentError'),
r(domain, i, recent, open_until, opened_at, opened_by, n, e_at, e_by, e_until, e_n) AS (
  SELECT domain, i, [t]::BIGINT[],
         CASE WHEN {threshold} <= 1 THEN t + {c} END, CASE WHEN {threshold} <= 1 THEN t END,
         CASE WHEN {threshold} <= 1 THEN event_id END, CASE WHEN {threshold} <= 1 THEN 1 ELSE 0 END,
         NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT
  FROM f WHERE i = 1
  UNION ALL
  SELECT r.domain, f.i, {recent2}, {new_open},
         CASE WHEN {starts} THEN f.t WHEN {closing} THEN NULL ELSE r.opened_at END,
         CASE WHEN {starts} THEN f.event_id WHEN {closing} THEN NULL ELSE r.opened_by END,
         CASE WHEN {new_open} IS NULL THEN 0
              WHEN {starts} THEN 1 ELSE (CASE WHEN {closing} THEN 0 ELSE r.n END) + 1 END,
         CASE WHEN {closing} THEN r.opened_at END, CASE WHEN {closing} THEN r.opened_by END,
         CASE WHEN {closing} THEN r.open_until END, CASE WHEN {closing} THEN r.n END
  FROM r JOIN f ON f.domain = r.domain AND f.i = r.i + 1),
last_i AS (SELECT domain, max(i) AS i FROM f GROUP BY domain),
outs AS (SELECT domain, e_at AS opened_at, e_by AS opened_by, e_until AS open_until, e_n AS n FROM r WHERE e_at IS NOT NULL
         UNION ALL
         SELECT r.domain, r.opened_at, r.opened_by, r.open_until, r.n FROM r JOIN last_i l ON r.domain = l.domain AND r.i = l.i
         WHERE r.open_until IS NOT NULL)"""


_W7_CTE = _w7_sql(**BREAKER_W7)
ORACLE["w7_outages"] = f"""{_W7_CTE}
SELECT domain, make_timestamp(opened_at) AS opened_at, make_timestamp(open_until) AS open_until, opened_by,
       CAST(n AS BIGINT) AS failures_while_open FROM outs"""
ORACLE["w7_blocked_flags"] = f"""{_W7_CTE}
SELECT x.domain, x.ts, x.event_id,
       EXISTS (SELECT 1 FROM outs o WHERE o.domain = x.domain AND o.open_until > epoch_us(x.ts)
               AND (epoch_us(x.ts) > o.opened_at OR (epoch_us(x.ts) = o.opened_at AND x.event_id > o.opened_by))) AS blocked
FROM outcomes x"""


# T4 equals the batch limiter audit (W4 multiplier, W5 gaps) on the same outcome rows
ORACLE["t4_rate_state_stream"] = f"""WITH {_W4_SQL},
p AS (SELECT *, lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) AS prev_ts,
             lag(backoff_multiplier) OVER (PARTITION BY domain ORDER BY ts, event_id) AS prev_m FROM w4)
SELECT event_id, domain, ts, round((epoch_us(ts) - epoch_us(prev_ts)) / 1e6, 6) AS gap_s,
       round(least(0.5 * coalesce(prev_m, 1.0), 60.0), 6) AS required_gap_s, backoff_multiplier FROM p"""


ORACLE["a10_error_report"] = f"""WITH {OUTCOMES_CTE},
a1 AS (SELECT count(*) AS total_processed, count(*) FILTER (WHERE error_type IS NULL) AS successful_requests,
              count(*) FILTER (WHERE error_type IS NOT NULL) AS failed_requests,
              min(epoch_us(ts)) AS s, max({_END_US}) AS e,
              avg(elapsed_s) FILTER (WHERE error_type IS NULL) AS av FROM outcomes),
a1b AS (SELECT total_processed, successful_requests, failed_requests,
               round(coalesce((e - s) / 1e6, 0.0), 6) AS duration,
               round(coalesce(CASE WHEN e - s = 0 THEN NULL ELSE total_processed / ((e - s) / 1e6) END, 0.0), 6) AS average_speed,
               round(coalesce(av, 0.0), 6) AS avg_response_time,
               make_timestamp(s) AS start_time, make_timestamp(e) AS end_time FROM a1),
a4 AS (SELECT map_from_entries(list((error_type, n) ORDER BY error_type, n)) AS error_stats
       FROM (SELECT error_type, count(*) AS n FROM outcomes WHERE error_type IS NOT NULL GROUP BY 1)),
pe AS (SELECT DISTINCT url FROM outcomes WHERE error_type = 'PermanentError'),
a5 AS (SELECT count(*) AS permanent_error_count FROM pe),
smp AS (SELECT list(url ORDER BY url) AS permanent_error_sample FROM (SELECT url FROM pe ORDER BY url LIMIT 5)),
a7 AS (SELECT count(*) FILTER (WHERE ok AND attempt > 1) AS successful_retries,
              coalesce(sum(elapsed_s) FILTER (WHERE ok AND attempt > 1), 0.0) AS total_retry_time,
              coalesce(avg(elapsed_s) FILTER (WHERE ok AND attempt > 1), 0.0) AS mean_retry_time,
              count(*) AS total_attempts FROM attempts),
j AS (SELECT * FROM a1b, a4, a5, smp, a7)
SELECT to_json({{'total_processed': total_processed, 'successful_requests': successful_requests,
                 'failed_requests': failed_requests, 'duration': CAST(duration AS DECIMAL(20,6)),
                 'average_speed': CAST(average_speed AS DECIMAL(20,6)),
                 'avg_response_time': CAST(avg_response_time AS DECIMAL(20,6)),
                 'start_time': strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f'),
                 'end_time': strftime(end_time, '%Y-%m-%dT%H:%M:%S.%f'),
                 'error_stats': error_stats, 'permanent_error_count': permanent_error_count,
                 'permanent_error_sample': permanent_error_sample, 'successful_retries': successful_retries,
                 'total_retry_time': CAST(round(total_retry_time, 6) AS DECIMAL(20,6)),
                 'mean_retry_time': CAST(round(mean_retry_time, 6) AS DECIMAL(20,6)),
                 'total_attempts': total_attempts}})::VARCHAR AS report, * FROM j"""


# T3 finds the outages of W7
ORACLE["t3_outage_stream"] = f"""{_W7_CTE}
SELECT domain, make_timestamp(opened_at) AS opened_at, make_timestamp(open_until) AS open_until,
       CAST(n AS BIGINT) AS failures_while_open FROM outs"""

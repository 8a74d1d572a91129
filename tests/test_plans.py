"""Plan properties the scale design relies on (checked on the physical plan)."""

import re

from webloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_extraction_is_one_narrow_stage(spark):
    for name in ("x2_page_text", "x1_title_meta", "x4_link_table", "x6_headings"):
        p = _plan(spark, name)
        assert "Exchange" not in p, name
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas", p), name


def test_html_not_read_when_not_needed(spark):
    for name in ("u1_netloc_census", "a3_top_page_domains", "u5_fragment_strip"):
        p = _plan(spark, name)
        schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
        assert schemas and all("html" not in s for s in schemas), (name, schemas)


def test_top_domains_partial_aggregate_and_top_k(spark):
    p = _plan(spark, "a3_top_page_domains")
    assert "TakeOrderedAndProject" in p
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_count", p)


def test_top_n_uses_partial_group_limit(spark):
    p = _plan(spark, "w9_latest_per_domain")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_retry_windows_are_per_request(spark):
    p = _plan(spark, "w2_retry_audit")
    # the request-level window partitions by (url, run, request_no): bounded groups
    assert re.search(r"Window \[.*\], \[url#\d+, run#\d+L?, request_no#\d+L?\]", p)

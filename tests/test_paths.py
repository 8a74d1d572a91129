"""Library paths the registered queries do not take."""

import datetime as dt

from webloom.functions.outcomes import error_class
from webloom.operators import extract as X
from webloom.operators import links as L
from webloom.operators.politeness import rate_compliance
from webloom.sinks import records as K


def test_scope_with_allow_table(spark):
    links = spark.createDataFrame([(1, 0, "https://www.a.com/", "https://a.com/x"),
                                   (1, 1, "https://www.a.com/", "https://b.org/y"),
                                   (1, 2, "https://www.a.com/", "https://c.net/z")],
                                  "page_id long, pos int, src_url string, dst_url string")
    allowed = spark.createDataFrame([("b.org",), ("b.org",)], "domain string")
    got = sorted(r.dst_url for r in L.scope_to_page_domain(links, allowed).collect())
    assert got == ["https://a.com/x", "https://b.org/y"]
    assert [r.dst_url for r in L.scope_to_page_domain(links).collect()] == ["https://a.com/x"]


def test_rate_compliance_with_crawl_delays(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, "https://a.com/1", "a.com", t0, 0.1, 200),
            (2, "https://a.com/2", "a.com", t0 + dt.timedelta(seconds=2), 0.1, 503),
            (3, "https://a.com/3", "a.com", t0 + dt.timedelta(seconds=2.6), 0.1, 200),
            (4, "https://b.com/1", "b.com", t0, 0.1, 200),
            (5, "https://b.com/2", "b.com", t0 + dt.timedelta(seconds=0.7), 0.1, 200)]
    o = spark.createDataFrame(rows, "event_id long, url string, domain string, ts timestamp, elapsed_s double, "
                                    "status int").withColumn("error_type", error_class("status"))
    delays = spark.createDataFrame([("a.com", 2.5)], "domain string, crawl_delay double")
    r = {x.event_id: x for x in rate_compliance(o, delays).collect()}
    # after the 503 the multiplier is 2: required gap 1.0 s, observed 0.6 s
    assert r[3].required_gap_s == 1.0 and r[3].rate_ok is False
    assert r[2].delay_ok is False and r[2].crawl_delay == 2.5
    assert r[5].crawl_delay == 1.0 and r[5].rate_ok is True and r[5].delay_ok is False
    assert r[1].gap_s is None and r[1].rate_ok is True


def test_records_with_fetch_outcome(spark):
    pages = spark.createDataFrame([(1, "https://a.com/", "<title>A</title><p>x</p>"),
                                   (2, "https://b.com/", "<title>B</title>")], "page_id long, url string, html string")
    fetched = spark.createDataFrame([("https://a.com/", 203, "text/html; charset=utf-8", dt.datetime(2024, 1, 1))],
                                    "url string, status int, content_type string, fetched_at timestamp")
    r = {x.url: x for x in K.page_records_to_crawl_records(X.page_records(pages), fetched).collect()}
    assert r["https://a.com/"].status_code == 203 and r["https://a.com/"].content_type.startswith("text/html;")
    assert r["https://a.com/"].crawled_at == dt.datetime(2024, 1, 1)
    assert r["https://b.com/"].status_code == 200 and r["https://b.com/"].crawled_at is None
    assert r["https://a.com/"].text_length == len("A x") and r["https://a.com/"].metadata == {"description": "", "keywords": ""}

"""Invariants on seeded random input (SURVEY §5 (5))."""

import datetime as dt
import random

from pyspark.sql import functions as F

from webloom.functions.outcomes import error_class
from webloom.operators import links as L
from webloom.operators import retries as R
from webloom.operators.politeness import concurrency_profile, request_intervals


def _random_log(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        dom = "hot.com" if rnd.random() < 0.5 else f"d{rnd.randint(0, 9)}.com"
        url = f"https://{dom}/p/{rnd.randint(0, 20)}"
        ts = t0 + dt.timedelta(seconds=rnd.randint(0, 86_400 * 3))
        rows.append((i, url, dom, ts, round(rnd.uniform(0.01, 30.0), 2), rnd.choice([200, 200, 200, 0, 503, 429, 404])))
    df = spark.createDataFrame(rows, "event_id long, url string, domain string, ts timestamp, elapsed_s double, status int")
    return df.withColumn("error_type", error_class("status"))


def test_concurrency_never_negative_and_balanced(spark):
    a = R.number_attempts(_random_log(spark), 3, bucket_seconds=1800)
    prof = concurrency_profile(a, bucket_seconds=1800).collect()
    assert all(r.min_active >= 0 for r in prof)
    g = concurrency_profile(a, per_domain=False).collect()[0]
    assert g.min_active >= 0 and g.peak_active >= max(r.peak_active for r in prof)
    # every request has end >= start
    iv = request_intervals(a)
    assert iv.filter(F.col("end_us") < F.col("start_us")).count() == 0


def test_attempts_partition_requests(spark):
    a = R.number_attempts(_random_log(spark, seed=2), 3, bucket_seconds=900)
    rows = a.collect()
    assert all(1 <= r.attempt <= 4 for r in rows)
    # exactly one outcome per request
    per_req = a.groupBy("url", "run", "request_no").agg(F.count_if("is_outcome").alias("k")).collect()
    assert all(r.k == 1 for r in per_req)


def test_link_dedup_idempotent(spark):
    html = "".join(f'<a href="/{i % 7}">x</a>' for i in range(50))
    p = spark.createDataFrame([(1, "https://h.com/", html)], "page_id long, url string, html string")
    links = L.page_links(p).collect()[0].links
    assert links == list(dict.fromkeys(links)) and len(links) == 7
    assert [f"https://h.com/{i}" for i in range(7)] == links

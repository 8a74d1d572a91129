"""Sink round trips: JSONL, CSV, table, fan-out, stats export."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from webloom.operators import extract as X
from webloom.sinks import records as K


def _two(spark):
    return spark.createDataFrame([("https://example.com", "Example", 200), ("https://httpbin.org", "HTTPBin", 200)],
                                 "url string, title string, status_code int")


def test_jsonl_roundtrip(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "out.jsonl")
    df = _two(spark).withColumn("crawled_at", F.lit(None).cast("timestamp"))
    K.jsonl_sink(p)(df)
    lines = [json.loads(x) for f in sorted(glob.glob(p + "/part-*")) for x in open(f, encoding="utf-8")]
    assert sorted(x["url"] for x in lines) == ["https://example.com", "https://httpbin.org"]
    assert all("crawled_at" in x for x in lines)
    back = K.read_jsonl(spark, p).collect()
    assert sorted(r.url for r in back if r._corrupt_record is None) == ["https://example.com", "https://httpbin.org"]


def test_jsonl_bad_line_kept(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad")
    os.makedirs(p)
    with open(os.path.join(p, "x.jsonl"), "w") as f:
        f.write('{"url": "a", "status_code": 200}\nnot json\n')
    rows = K.read_jsonl(spark, p).collect()
    assert len(rows) == 2 and sum(r._corrupt_record is not None for r in rows) == 1


def test_csv_roundtrip_full_record(spark, tmpdir_path):
    html = "<title>Example Domain</title><h1>Example Domain</h1><p>Text, with \"quotes\"\nand lines</p>"
    pages = spark.createDataFrame([(1, "https://example.com", html)], "page_id long, url string, html string")
    rec = K.page_records_to_crawl_records(X.page_records(pages))
    p = os.path.join(tmpdir_path, "csv")
    K.csv_sink(p)(rec)
    back = K.read_csv(spark, p).collect()[0]
    src = rec.collect()[0]
    assert back.url == src.url and back.title == "Example Domain" and back.text == src.text
    assert back.metadata == {"description": "", "keywords": ""}
    assert back.headings.h1 == ["Example Domain"] and back.images_count == 0 and back.error == ""
    header = open(sorted(glob.glob(p + "/part-*"))[0], encoding="utf-8").readline().strip().split(",")
    assert header == K.CSV_FIELDS


def test_table_sink_and_latest(spark):
    t = "crawled_data_test"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    sink = K.table_sink(spark, t, buckets=4)
    df = _two(spark)
    sink(df)
    sink(df.limit(1))
    assert spark.table(t).count() == 3  # duplicates kept
    assert K.lookup_url(spark, t, "https://httpbin.org").count() == 1
    assert K.latest_from_table(spark, t, 3).count() == 3


def test_fan_out_and_union(spark, tmpdir_path):
    ok = K.page_records_to_crawl_records(X.page_records(spark.createDataFrame(
        [(1, "https://a.com", "<title>A</title>")], "page_id long, url string, html string")))
    err = K.error_records(spark.createDataFrame([("https://b.com", "NetworkError: 0", dt.datetime(2024, 1, 1))],
                                                "url string, error string, crawled_at timestamp"))
    u = K.union_records(ok, err)
    rows = {r.url: r for r in u.collect()}
    assert rows["https://b.com"].status_code == 0 and rows["https://b.com"].links == []
    assert rows["https://a.com"].error == ""
    a, b = os.path.join(tmpdir_path, "a"), os.path.join(tmpdir_path, "b")
    K.fan_out(u, [K.jsonl_sink(a), K.csv_sink(b)])
    assert spark.read.json(a).count() == 2 and K.read_csv(spark, b).count() == 2


def test_stats_export(spark, tmpdir_path):
    from webloom.functions.outcomes import error_class
    t0 = dt.datetime(2024, 1, 1)
    o = spark.createDataFrame([(1, "https://example.com/", "example.com", t0, 0.5, 200),
                               (2, "https://httpbin.org/", "httpbin.org", t0, 0.3, 200),
                               (3, "https://bad.com/", "bad.com", t0, 0.1, 0)],
                              "event_id long, url string, domain string, ts timestamp, elapsed_s double, status int")
    o = o.withColumn("error_type", error_class("status"))
    p = os.path.join(tmpdir_path, "stats")
    K.stats_sink(p)(K.run_stats_row(o))
    data = json.loads(open(glob.glob(p + "/part-*")[0]).readline())
    assert (data["total_processed"], data["successful_requests"], data["failed_requests"]) == (3, 2, 1)
    assert data["status_code_distribution"] == {"200": 2, "error": 1}
    assert data["avg_response_time"] == 0.4


def test_table_ids_grow_over_appends(spark, tmpdir_path):
    import uuid

    from webloom.sinks import records as K
    name = f"grow_{uuid.uuid4().hex[:8]}"
    sink = K.table_sink(spark, name, buckets=4, path=f"{tmpdir_path}/t")
    for k in range(3):
        sink(spark.range(20, numPartitions=3).selectExpr(f"concat('u', id + {20 * k}) AS url", f"'{k}' AS title", "200 AS status_code"))
    rows = spark.table(name).select("id", "title").collect()
    assert len({r.id for r in rows}) == 60
    top = {t: [r.id for r in rows if r.title == t] for t in "012"}
    assert max(top["0"]) < min(top["1"]) and max(top["1"]) < min(top["2"])
    assert {r.title for r in K.latest_from_table(spark, name, 20, order=("id",)).collect()} == {"2"}


def test_url_lookup_reads_one_bucket_and_ids_grow(spark, tmpdir_path):
    name = "lookup_table"
    sink = K.table_sink(spark, name, buckets=8, path=os.path.join(tmpdir_path, "lookup"))
    for a in (0, 100, 200):
        sink(spark.range(a, a + 100).select(F.concat(F.lit("http://h/"), "id").alias("url"), F.lit("t").alias("title")))
    rows = spark.table(name).select("url", "id").collect()
    by = {int(r.url.rsplit("/", 1)[1]): r.id for r in rows}
    assert len(set(by.values())) == 300 and max(by[i] for i in range(100)) < min(by[i] for i in range(100, 200))
    assert max(by[i] for i in range(100, 200)) < min(by[i] for i in range(200, 300))
    one = K.lookup_url(spark, name, "http://h/7")
    assert one.count() == 1
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan then names the buckets
    try:
        assert "SelectedBucketsCount: 1 out of 8" in K.lookup_url(spark, name, "http://h/7")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = K.lookup_urls(spark, name, spark.createDataFrame([("http://h/7",), ("http://h/250",), ("none",)], "url string"))
        side = many._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.url for r in many.collect()) == ["http://h/250", "http://h/7"]
        table_side = side[:side.index("FileScan")]
        assert "Bucketed: true" in side and "Exchange hashpartitioning" not in table_side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    import glob

    import pyarrow.parquet as pq
    f = glob.glob(os.path.join(tmpdir_path, "lookup", "*.parquet"))[0]
    assert pq.ParquetFile(f).metadata.num_rows > 0


def test_s4_newest_rows_are_not_read_in_one_task(spark, monkeypatch):
    from webloom.plans import catalog as C
    plans, real = [], K.table_sink

    def watched(*a, **kw):
        sink = real(*a, **kw)
        return lambda df: (plans.append((df._jdf.queryExecution().toString(), set(df.inputFiles()))), sink(df))

    monkeypatch.setattr(K, "table_sink", watched)
    got = [r.url for r in C.QUERIES["s4_table_latest"](spark, "/root/testdata/sf0.001").collect()]
    urls = [r.url for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url").collect()]
    assert got == sorted(urls, reverse=True)[:10]
    (_, all_files), (plan, files) = plans
    assert "Repartition 1, false" not in plan  # coalesce(1) pulls the whole scan into its one task
    assert not files & all_files  # the sort reads the ten rows, not the table


@pytest.mark.parametrize("n", [0, 1, 300])
def test_s4_appends_every_record_in_url_order(spark, tmpdir_path, monkeypatch, n):
    from webloom.plans import catalog as C
    urls = [None if i % 50 == 7 else f"http://h{i * 37 % n:03d}.org/" for i in range(n)] + ["http://h000.org/"] * (n // 100)
    pages = [(i, u, f"<title>t {u}</title><p>x</p>") for i, u in enumerate(urls)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5).write.parquet(f"{tmpdir_path}/pages.parquet")
    tables, real = [], K.latest_from_table
    monkeypatch.setattr(K, "latest_from_table", lambda s, table, *a, **kw: (tables.append(table), real(s, table, *a, **kw))[1])
    got = [(r.url, r.title) for r in C.QUERIES["s4_table_latest"](spark, tmpdir_path).collect()]
    order = sorted(urls, key=lambda u: u or "")
    assert [r.url for r in spark.table(tables[0]).orderBy("id").collect()] == order
    assert got == [(u, f"t {u}") for u in order[::-1][:10]]


def test_middle_value_of_a_column(spark):
    from webloom.plans import catalog as C
    df = spark.range(1000, numPartitions=3).selectExpr("if(id % 10 = 0, null, lpad(id * 7 % 1000, 4, '0')) AS u")
    assert 250 <= df.where(df.u < C._middle(df, "u")).count() <= 650
    assert C._middle(df.where("u IS NULL"), "u") is None

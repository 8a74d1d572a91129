"""Streaming twins: results equal the batch jobs; late rows are dropped."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from webloom.functions.outcomes import error_class
from webloom.operators.politeness import rate_compliance
from webloom.plans import catalog as C
from webloom.sinks import records as K
from webloom.streaming import jobs as S

SF = "/root/testdata/sf0.01"


def test_t4_matches_w5(spark):
    got = C.t4_rate_state_stream(spark, SF)
    exp = rate_compliance(C._outcomes(spark, SF))
    g = {r.event_id: (None if r.gap_s is None else round(r.gap_s, 6), r.required_gap_s) for r in got.collect()}
    e = {r.event_id: (r.gap_s, r.required_gap_s) for r in exp.collect()}
    assert g == e


def test_late_row_dropped(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    t0 = dt.datetime(2024, 1, 1, 12)
    schema = "event_id long, url string, domain string, ts timestamp, elapsed_s double, status int"

    def batch(rows, name):
        df = spark.createDataFrame(rows, schema).withColumn("error_type", error_class("status"))
        df.coalesce(1).write.mode("append").parquet(src)

    batch([(1, "https://a.com/1", "a.com", t0, 0.1, 200), (2, "https://a.com/2", "a.com", t0 + dt.timedelta(seconds=30), 0.1, 200)], "b1")
    batch([(3, "https://a.com/3", "a.com", t0 + dt.timedelta(seconds=1), 0.1, 200),   # 29 s late: dropped
           (4, "https://a.com/4", "a.com", t0 + dt.timedelta(seconds=60), 0.1, 200)], "b2")
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    S.run_available(S.progress(S.fetch_log_stream(spark, src, max_files_per_trigger=1)), out, ck)
    rows = {r.window_start: r.requests for r in spark.read.parquet(out).collect()}
    assert rows.get(t0) == 1  # the late row of the second file did not reach the 12:00:00 window


def test_t5_fan_out(spark, tmpdir_path):
    pages = S.pages_stream(spark, "/root/testdata/sf0.001", glob="pages.parquet")
    a, b = os.path.join(tmpdir_path, "a"), os.path.join(tmpdir_path, "b")
    rec = S.extraction_stream(pages).select("url", "title", F.length("text").alias("text_length"))
    q = (rec.writeStream.foreachBatch(S.fan_out_batches([K.jsonl_sink(a), K.csv_sink(b)]))
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    n = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert spark.read.json(a).count() == n and K.read_csv(spark, b).count() == n


def test_progress_to_target(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=i * 7200), 10, 10, 0, 0.1, 10.0) for i in range(30)]
    w = spark.createDataFrame(rows, "window_start timestamp, requests long, pages long, errors long, "
                                    "mean_latency_s double, rate_per_s double")
    r = S.progress_to_target(w, 100, bucket_seconds=86_400).orderBy("window_start").collect()
    assert [x.pages_done for x in r[:3]] == [10, 20, 30]
    assert r[-1].pct_of_target == 100.0 and r[0].eta_s == 9.0


def test_t2_dedup_within_watermark(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    t0 = dt.datetime(2024, 1, 1, 12)
    schema = "event_id long, url string, domain string, ts timestamp, elapsed_s double, status int"

    def batch(rows):
        df = spark.createDataFrame(rows, schema).withColumn("error_type", error_class("status"))
        df.coalesce(1).write.mode("append").parquet(src)

    h = dt.timedelta(hours=1)
    batch([(1, "https://a.com/x", "a.com", t0, 0.1, 200), (2, "https://a.com/x", "a.com", t0 + h / 6, 0.1, 200)])
    batch([(3, "https://a.com/y", "a.com", t0 + 5 * h, 0.1, 200)])  # moves the watermark past the first sighting
    batch([(4, "https://a.com/z", "a.com", t0 + 5.5 * h, 0.1, 200)])  # a batch that evicts the expired /x state
    batch([(5, "https://a.com/x", "a.com", t0 + 6 * h, 0.1, 200)])  # state for /x is gone: emitted again
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    stream = S.dedup_urls(S.fetch_log_stream(spark, src, max_files_per_trigger=1), watermark="1 hour")
    S.run_available(stream.select("event_id", "url"), out, ck)
    got = sorted(r.event_id for r in spark.read.parquet(out).collect())
    assert got == [1, 3, 4, 5]


def _log_parts(spark, path, parts):
    for rows in parts:
        df = spark.createDataFrame(rows, "event_id long, url string, domain string, ts timestamp, elapsed_s double, status int")
        df.withColumn("error_type", error_class("status")).withColumn("attempt", F.lit(1)).coalesce(1).write.mode("append").parquet(path)


def test_carried_streams_equal_batch_and_keep_late_rows(spark, tmpdir_path):
    """Three micro-batches, a domain with most of the rows, outages across batch edges, one row out of order."""
    import random

    from webloom.operators.outages import outages
    rng = random.Random(3)
    t0, rows = dt.datetime(2024, 1, 1), []
    for i in range(600):
        d = "hot.com" if rng.random() < 0.6 else f"d{rng.randint(0, 4)}.com"
        rows.append((i, f"https://{d}/{i}", d, t0 + dt.timedelta(seconds=i * 7 + rng.randint(0, 6)), 0.1, rng.choice([200, 200, 200, 503, 0, 404])))
    late = (9000, "https://hot.com/late", "hot.com", t0 + dt.timedelta(seconds=5), 0.1, 503)
    parts = [rows[:200], rows[200:400], [*rows[400:], late]]
    src = os.path.join(tmpdir_path, "src")
    _log_parts(spark, src, parts)
    log = spark.read.parquet(src).where("event_id <> 9000")
    setting = dict(threshold=3, window_s=60.0, cooldown_s=90.0)

    def run(body, name, **kw):
        out, state, side, ck = (os.path.join(tmpdir_path, name, x) for x in ("out", "state", "late", "ck"))
        S.run_batches(S.fetch_log_stream(spark, src, max_files_per_trigger=1), body(spark, out, state, side, **kw), ck)
        assert sorted(os.listdir(state)) == ["0", "1", "2"]
        assert spark.read.parquet(f"{state}/2").groupBy("domain").count().agg(F.max("count")).first()[0] == 1
        assert [r.event_id for r in spark.read.parquet(side).collect()] == [9000]
        return spark.read.parquet(out)

    got = S.final_outages(run(S.outage_batches, "t3", chunk_seconds=200, **setting))
    want = outages(log, **setting).select("domain", "opened_at", "open_until", "failures_while_open")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 5
    got = {r.event_id: (r.gap_s, r.required_gap_s) for r in run(S.rate_batches, "t4", bucket_seconds=100).collect()}
    want = {r.event_id: (r.gap_s, r.required_gap_s) for r in rate_compliance(log).collect()}
    assert got == want


def test_idle_domains_leave_the_state(spark, tmpdir_path):
    t0 = dt.datetime(2024, 1, 1)
    src = os.path.join(tmpdir_path, "src")
    _log_parts(spark, src, [[(1, "https://a.com/", "a.com", t0, 0.1, 200), (2, "https://b.com/", "b.com", t0, 0.1, 503)],
                            [(3, "https://b.com/", "b.com", t0 + dt.timedelta(hours=3), 0.1, 503)]])
    state = os.path.join(tmpdir_path, "state")
    S.run_batches(S.fetch_log_stream(spark, src, max_files_per_trigger=1),
                  S.rate_batches(spark, os.path.join(tmpdir_path, "o"), state, os.path.join(tmpdir_path, "l"), idle_s=3600),
                  os.path.join(tmpdir_path, "ck"))
    assert [tuple(r) for r in spark.read.parquet(f"{state}/1").select("domain", "fails").collect()] == [("b.com", 2)]


def test_pages_stream_of_a_file_or_a_folder(spark, tmpdir_path):
    rows = [(i, f"http://h/{i}", "<title>t</title>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df.repartition(3).write.parquet(os.path.join(tmpdir_path, "folder", "pages.parquet"))
    df.coalesce(1).write.parquet(os.path.join(tmpdir_path, "one"))
    os.makedirs(os.path.join(tmpdir_path, "file"))
    part = next(f for f in os.listdir(os.path.join(tmpdir_path, "one")) if f.endswith(".parquet"))
    shutil.copy(os.path.join(tmpdir_path, "one", part), os.path.join(tmpdir_path, "file", "pages.parquet"))
    for form in ("folder", "file"):
        got = C.QUERIES["t5_extraction_stream"](spark, os.path.join(tmpdir_path, form)).groupBy("sink").count().collect()
        assert {tuple(r) for r in got} == {("jsonl", 6), ("csv", 6), ("table", 6)}

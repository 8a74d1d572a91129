"""Structured Streaming twins: S8 source, T1–T6, E3.

Every job reads a ``fetch_log``/``pages`` stream from a file source with an
explicit schema, keeps its state bounded by a watermark or by a few values per
domain, and writes through ``foreachBatch`` sinks (E1) or a file sink.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.outcomes import counts_for_breaker
from ..session import checkpoint_dir, cut_lineage
from ..sources.fetchlog import FETCH_LOG_SCHEMA


# S8 ---------------------------------------------------------------------------
def fetch_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(FETCH_LOG_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def pages_stream(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The page table as a stream: a folder of files, or ``<folder>/{name}`` for a table that is one file or
    a folder of part files (a plain path must be a folder, a pattern need not)."""
    r = spark.readStream.schema("page_id LONG, url STRING, html STRING")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


# T1 ---------------------------------------------------------------------------
def progress(log: DataFrame, window: str = "1 second", watermark: str = "10 seconds") -> DataFrame:
    """Per tumbling window: requests, pages (ok), errors, mean latency of ok, rate."""
    secs = F.unix_timestamp(F.col("window.end")) - F.unix_timestamp(F.col("window.start"))
    agg = (log.withWatermark("ts", watermark).groupBy(F.window("ts", window))
           .agg(F.count(F.lit(1)).alias("requests"),
                F.count_if(F.col("error_type").isNull()).alias("pages"),
                F.count_if(F.col("error_type").isNotNull()).alias("errors"),
                F.avg(F.when(F.col("error_type").isNull(), F.col("elapsed_s"))).alias("mean_latency_s")))
    return agg.select(F.col("window.start").alias("window_start"), "requests", "pages", "errors",
                      F.round("mean_latency_s", 6).alias("mean_latency_s"),
                      F.round(F.col("requests") / secs, 6).alias("rate_per_s"))


def progress_to_target(windows: DataFrame, max_pages: int, bucket_seconds: int = 86_400) -> DataFrame:
    """Batch step over the per-window table: cumulative pages, % of the target
    and ETA at the current rate.  The running sum is bucketed by day, so a
    long log (one row per second) never sorts in one task."""
    from ..operators.sequence import Prefix, prefix_aggregate, time_bucket
    w = windows.withColumn("_bk", time_bucket("window_start", bucket_seconds))
    w = prefix_aggregate(w, [], ["window_start"], "_bk", [Prefix("pages_done", F.col("pages"))])
    cum = F.col("pages_done")
    return w.select("*", F.round(F.least(cum * 100.0 / max_pages, F.lit(100.0)), 3).alias("pct_of_target"),
                    F.round(F.try_divide(F.greatest(F.lit(max_pages) - cum, F.lit(0)), F.col("rate_per_s")), 3)
                    .alias("eta_s")).drop("_bk")


# T2 ---------------------------------------------------------------------------
def dedup_urls(log: DataFrame, watermark: str = "1 hour", exact: bool = False) -> DataFrame:
    """First sighting of each URL; bounded state within the watermark, or exact
    (state grows with the number of distinct URLs)."""
    if exact:
        return log.withWatermark("ts", watermark).dropDuplicates(["url"])
    return log.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["url"])


# T3 / T4 --------------------------------------------------------------------------
# The breaker and the limiter follow every domain in time order.  A keyed state per domain would make a
# hot domain's rows one group, so each micro-batch is worked on as the batch jobs do it, in
# time buckets (``operators.sequence``, ``outages.chunked_replay``), and what goes from
# one micro-batch to the next is a state table with one row of a few values per domain, in
# the shared folder.  A batch that is run again overwrites its own folder and reads the
# state before it, so restarts change nothing.  Rows older than their domain's state go to a side table.
OUTAGE_OUT = "domain STRING, opened_at TIMESTAMP, open_until TIMESTAMP, failures_while_open LONG"
LAST = ["last_us", "last_eid"]


class CarriedState:
    """The state tables of a stream, one folder per micro-batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def before(self, epoch_id: int) -> DataFrame:
        if epoch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{epoch_id - 1}")

    def save(self, epoch_id: int, changed: DataFrame, idle_us: int | None, now: DataFrame) -> None:
        """States of this batch's domains, and of the others unless idle for longer than ``idle_us``."""
        rest = self.before(epoch_id).join(changed.select("domain"), "domain", "left_anti")
        if idle_us is not None:
            rest = rest.where(F.col("last_us") >= F.coalesce(now.agg(F.max("t_us")).scalar(), F.lit(0)) - idle_us)
        names = [c.split()[0] for c in self.schema.split(", ")]
        rest.select(*names).unionByName(changed.select(*names)).write.mode("overwrite").parquet(f"{self.path}/{epoch_id}")


def split_late(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows behind their domain's state, rows older than it)."""
    x = rows.join(state.select("domain", *LAST), "domain", "left")
    late = F.col("last_us").isNotNull() & (F.struct("t_us", "event_id") <= F.struct(*LAST))
    return x.where(~late).drop(*LAST), x.where(late).drop(*LAST)


def _newest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("domain").agg(F.max(F.struct(F.col("t_us").alias("last_us"), F.col("event_id").alias("last_eid"))).alias("l")).select(
        "domain", "l.*")


def outage_batches(spark: SparkSession, out: str, state: str, late: str, threshold: int = 5, window_s: float = 60.0,
                   cooldown_s: float = 30.0, chunk_seconds: int = 3600, idle_s: float | None = None) -> callable:
    """``foreachBatch`` body of T3: outages as known after each micro-batch; ``final_outages`` keeps the
    last version of each.  State per domain: its last row, at most ``threshold - 1`` failure times, and
    the open outage."""
    from ..operators.outages import STATE, chunked_replay
    carried = CarriedState(spark, state, "domain STRING, last_us LONG, last_eid LONG, e_recent ARRAY<LONG>, e_open_until LONG, "
                                         "opened_at_us LONG, opened_by LONG, n_open LONG")
    w_us, c_us = int(window_s * 1e6), int(cooldown_s * 1e6)
    chunk_us = int(max(chunk_seconds, 2 * (window_s + cooldown_s)) * 1e6)

    def run(batch: DataFrame, epoch_id: int) -> None:
        old = carried.before(epoch_id)
        rows = cut_lineage(batch.select("domain", "ts", "event_id", "error_type", F.unix_micros("ts").alias("t_us")))
        fresh, behind = split_late(rows, old)
        behind.drop("t_us").write.mode("overwrite").parquet(f"{late}/batch={epoch_id}")
        f = fresh.where(counts_for_breaker("error_type")).select("domain", F.lit(0).cast("long").alias("episode"), "t_us", "event_id")
        found, ends = chunked_replay(f, threshold, w_us, c_us, chunk_us, carry=old.select(*STATE), with_state=True)
        found.select("domain", "opened_at", "open_until", "failures_while_open").write.mode("overwrite").parquet(f"{out}/batch={epoch_id}")
        # a domain without counting failures in this batch keeps its breaker state
        same = old.select(*STATE).join(ends.select("domain"), "domain", "left_anti")
        both = _newest(fresh).join(ends.unionByName(same), "domain", "left")
        carried.save(epoch_id, both, None if idle_s is None else int(idle_s * 1e6), rows)
    return run


def final_outages(rows: DataFrame) -> DataFrame:
    """The last version of every outage: an open interval only grows."""
    return rows.groupBy("domain", "opened_at").agg(
        F.max("open_until").alias("open_until"), F.max("failures_while_open").alias("failures_while_open")).select(
        "domain", "opened_at", "open_until", "failures_while_open")


OUTAGE_STATE = ("recent_us ARRAY<LONG>, open_until_us LONG, opened_at_us LONG, n_open LONG, last_us LONG, "
                "last_eid LONG")


def _breaker_fn(threshold: int, window_us: int, cooldown_us: int):
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterable[pd.DataFrame]:
        (domain,) = key
        if state.hasTimedOut:
            recent, open_until, opened_at, n_open, _, _ = state.get
            state.remove()
            if open_until is not None:
                yield pd.DataFrame({"domain": [domain], "opened_at": [pd.Timestamp(opened_at, unit="us")],
                                    "open_until": [pd.Timestamp(open_until, unit="us")],
                                    "failures_while_open": [n_open]})
            return
        if state.exists:
            recent, open_until, opened_at, n_open, last_us, last_eid = state.get
            recent = list(recent or [])
        else:
            recent, open_until, opened_at, n_open, last_us, last_eid = [], None, None, 0, None, None
        pdf = pd.concat(list(batches), ignore_index=True)
        pdf = pdf.sort_values(["t_us", "event_id"])
        out = []
        for t, eid in zip(pdf["t_us"].tolist(), pdf["event_id"].tolist()):
            if last_us is not None and (t, eid) <= (last_us, last_eid):
                continue  # older than the state: late row, ignored
            last_us, last_eid = t, eid
            if open_until is not None and t >= open_until:
                out.append((opened_at, open_until, n_open))
                open_until, recent = None, []
            recent.append(t)
            recent = [x for x in recent if x >= t - window_us]
            if len(recent) >= threshold:
                if open_until is None:
                    opened_at, n_open = t, 0
                open_until = t + cooldown_us
            if open_until is not None:
                n_open += 1
            recent = recent[-max(threshold - 1, 1):] if len(recent) >= threshold else recent
        if open_until is not None:  # the outage as known so far; later rows of it replace this one
            out.append((opened_at, open_until, n_open))
        state.update((recent, open_until, opened_at, n_open, last_us, last_eid))
        # wake up when the watermark passes the end of the open interval, or when
        # the history can no longer matter
        wake = open_until if open_until is not None else (last_us + window_us)
        state.setTimeoutTimestamp(max(int(wake // 1000) + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame({"domain": [domain] * len(out),
                                "opened_at": [pd.Timestamp(o[0], unit="us") for o in out],
                                "open_until": [pd.Timestamp(o[1], unit="us") for o in out],
                                "failures_while_open": [o[2] for o in out]})
    return fn


def outage_stream(log: DataFrame, threshold: int = 5, window_s: float = 60.0, cooldown_s: float = 30.0,
                  watermark: str = "1 minute") -> DataFrame:
    """T3 as a DataFrame, for logs whose domains are all small: keyed state makes each domain's rows of
    a micro-batch one group.  The query runs ``outage_batches``, which deals a hot domain out.  State per domain is at
    most ``threshold - 1`` failure times and the open interval.  An outage is emitted when a later failure closes
    it, when the watermark (which follows every request) passes ``open_until``, and, while open, as known after
    each micro-batch; ``final_outages`` keeps the last version of each."""
    # the watermark is set on the whole stream; the failure filter is written as
    # one expression over the event-time column, which Catalyst does not push
    # below the watermark, so event time advances with every request
    counting = F.when(F.col("ts").isNotNull(), counts_for_breaker("error_type")).otherwise(F.lit(False))
    f = (log.withWatermark("ts", watermark).filter(counting)
         .select("domain", "ts", "event_id", F.unix_micros("ts").alias("t_us")))
    fn = _breaker_fn(threshold, int(window_s * 1e6), int(cooldown_s * 1e6))
    return f.groupBy("domain").applyInPandasWithState(fn, OUTAGE_OUT, OUTAGE_STATE, "append",
                                                      GroupStateTimeout.EventTimeTimeout)


def rate_batches(spark: SparkSession, out: str, state: str, late: str, rps: float = 5.0, min_delay: float = 0.5,
                 factor: float = 2.0, max_backoff: float = 60.0, bucket_seconds: int = 3600, idle_s: float | None = None) -> callable:
    """``foreachBatch`` body of T4: gap and required gap of every request, as W5.  State per domain: its last
    request and the failures since its last success."""
    from ..operators.sequence import Prefix, prefix_aggregate, previous_row, time_bucket
    carried = CarriedState(spark, state, "domain STRING, last_us LONG, last_eid LONG, fails LONG")
    base, cap = max(min_delay, 1.0 / rps), max_backoff / (1.0 / rps + min_delay)

    def multiplier(k):
        return F.when(k == 0, F.lit(1.0)).otherwise(F.least(F.pow(F.lit(float(factor)), k), F.lit(cap)))

    def run(batch: DataFrame, epoch_id: int) -> None:
        old = carried.before(epoch_id)
        rows = cut_lineage(batch.select("event_id", "domain", "ts", F.unix_micros("ts").alias("t_us"),
                                        F.col("error_type").isNull().alias("ok")))
        fresh, behind = split_late(rows, old)
        behind.drop("t_us").write.mode("overwrite").parquet(f"{late}/batch={epoch_id}")
        order = ["ts", "event_id"]
        x = prefix_aggregate(fresh.withColumn("_bk", time_bucket("ts", bucket_seconds)), ["domain"], order, "_bk",
                             [Prefix("_cnt", F.lit(1)), Prefix("_okc", F.col("ok"), how="last")])
        x = x.join(old.select("domain", F.col("last_us").alias("_us"), F.col("fails").alias("_fails")), "domain", "left")
        x = x.withColumn("fails", F.when(F.col("_okc").isNull(), F.col("_cnt") + F.coalesce("_fails", F.lit(0)))
                         .otherwise(F.col("_cnt") - F.col("_okc")).cast("long"))
        x = previous_row(x, ["domain"], order, "_bk", ["t_us", "fails"])
        gap = F.col("t_us") - F.coalesce("prev_t_us", "_us")
        prev = F.coalesce("prev_fails", "_fails", F.lit(0))
        x = cut_lineage(x.select("event_id", "domain", "ts", "t_us", "fails", F.round(gap / F.lit(1e6), 6).alias("gap_s"),
                                 F.round(F.least(F.lit(base) * multiplier(prev), F.lit(float(max_backoff))), 6).alias("required_gap_s"),
                                 F.round(multiplier(F.col("fails")), 6).alias("backoff_multiplier")))
        x.drop("t_us", "fails").write.mode("overwrite").parquet(f"{out}/batch={epoch_id}")
        new = x.groupBy("domain").agg(F.max(F.struct(F.col("t_us").alias("last_us"), F.col("event_id").alias("last_eid"), "fails")).alias("l"))
        carried.save(epoch_id, new.select("domain", "l.*"), None if idle_s is None else int(idle_s * 1e6), rows)
    return run


def run_batches(stream: DataFrame, body, ckpt_path: str) -> None:
    """Process everything available now, micro-batch by micro-batch."""
    (stream.writeStream.foreachBatch(body).option("checkpointLocation", ckpt_path).trigger(availableNow=True).start()).awaitTermination()


# T5 ---------------------------------------------------------------------------
def extraction_stream(pages: DataFrame) -> DataFrame:
    """X9 projection on a page stream (stateless)."""
    from ..operators.extract import cleaned
    from ..functions import html as H
    from ..operators.links import page_links_expr
    c = cleaned(pages)
    return c.select("page_id", "url", H.title("_clean").alias("title"), H.page_text("_clean").alias("text"),
                    page_links_expr("url", "_clean").alias("links"), H.images("_clean").alias("images"),
                    H.headings_struct("_clean").alias("headings"),
                    H.meta_content("_clean", "description").alias("description"),
                    H.meta_content("_clean", "keywords").alias("keywords"))


def extraction_batches(sinks) -> callable:
    """``foreachBatch`` body of T5: pages to whole stored records, to every sink."""
    from ..operators.extract import page_records
    from ..sinks.records import fan_out, page_records_to_crawl_records

    def run(batch: DataFrame, epoch_id: int) -> None:
        fan_out(page_records_to_crawl_records(page_records(batch)), sinks)
    return run


def fan_out_batches(sinks) -> callable:
    """``foreachBatch`` body: every micro-batch goes to every sink."""
    from ..sinks.records import fan_out

    def run(batch: DataFrame, epoch_id: int) -> None:
        fan_out(batch, sinks)
    return run


# T6 ---------------------------------------------------------------------------
def error_counters(log: DataFrame, window: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Failures per (window, error type).  All rows are aggregated and the
    success group dropped afterwards: a filter in front would be pushed below
    the watermark and let it follow the error rows only."""
    agg = (log.withWatermark("ts", watermark)
           .groupBy(F.window("ts", window), "error_type")
           .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("error_type").isNotNull()).alias("_failed")))
    # filtering on an aggregate output: Catalyst cannot push it below the watermark
    return agg.filter("_failed").select(F.col("window.start").alias("window_start"), "error_type", "n")


# running a stream to completion into a table -------------------------------------
def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/webloom-{name}-{uuid.uuid4().hex[:12]}"


def run_available(stream: DataFrame, out_path: str, ckpt_path: str, mode: str = "append") -> None:
    """Process everything available now (``availableNow``) into Parquet files."""
    q = (stream.writeStream.outputMode(mode).format("parquet").option("path", out_path)
         .option("checkpointLocation", ckpt_path).trigger(availableNow=True).start())
    q.awaitTermination()


def run_versions(stream: DataFrame, out_path: str, ckpt_path: str) -> None:
    """Process everything available now in update mode: every micro-batch adds the
    new versions of its groups, stamped with the batch number.  No group waits for
    the watermark, so the end of the input leaves none out."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("_batch", F.lit(epoch_id).cast("long")).write.mode("overwrite").parquet(f"{out_path}/batch={epoch_id}")

    q = (stream.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", ckpt_path).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_versions(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """The last version of each group written by ``run_versions``."""
    rows = spark.read.parquet(out_path).drop("batch")
    rest = [c for c in rows.columns if c not in (*keys, "_batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in rest])

"""Run statistics over outcome rows (A1–A6, A8–A10) and the page-domain census.

All are hash aggregations with map-side partial aggregation (one shuffle of
already-combined rows); top-k uses ``orderBy().limit()`` which plans as
TakeOrderedAndProject (per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.outcomes import is_retryable
from ..functions.urls import netloc


def _end_us():
    return F.unix_micros("ts") + F.round(F.col("elapsed_s") * 1e6).cast("long")


# A1 ---------------------------------------------------------------------------
def run_summary(outcomes: DataFrame) -> DataFrame:
    """processed, ok, failed, duration, pages/s, mean response of successes, start, end."""
    a = outcomes.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(F.col("error_type").isNull()).alias("successful_requests"),
        F.count_if(F.col("error_type").isNotNull()).alias("failed_requests"),
        F.min(F.unix_micros("ts")).alias("_start"),
        F.max(_end_us()).alias("_end"),
        F.avg(F.when(F.col("error_type").isNull(), F.col("elapsed_s"))).alias("_avg"))
    dur = (F.col("_end") - F.col("_start")) / F.lit(1e6)
    return a.select(
        "total_processed", "successful_requests", "failed_requests",
        F.round(F.coalesce(dur, F.lit(0.0)), 6).alias("duration"),
        F.round(F.coalesce(F.try_divide(F.col("total_processed"), dur), F.lit(0.0)), 6).alias("average_speed"),
        F.round(F.coalesce(F.col("_avg"), F.lit(0.0)), 6).alias("avg_response_time"),
        F.timestamp_micros("_start").alias("start_time"),
        F.timestamp_micros("_end").alias("end_time"))


# A2 ---------------------------------------------------------------------------
def status_bucket():
    return F.when(F.col("error_type").isNull(), F.col("status").cast("string")).otherwise(F.lit("error"))


def status_distribution(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy(status_bucket().alias("status")).agg(F.count(F.lit(1)).alias("n"))


# A3 ---------------------------------------------------------------------------
def top_domains(df: DataFrame, url_col: str = "url", k: int = 10) -> DataFrame:
    """Top-k netlocs by rows; empty netloc dropped; ties by name."""
    d = df.select(netloc(url_col).alias("domain")).filter(F.col("domain") != "")
    return d.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "domain").limit(k)


# A4 ---------------------------------------------------------------------------
def error_counts(outcomes: DataFrame) -> DataFrame:
    return (outcomes.filter(F.col("error_type").isNotNull())
            .groupBy("error_type").agg(F.count(F.lit(1)).alias("n")))


# A5 ---------------------------------------------------------------------------
def permanent_error_urls(outcomes: DataFrame) -> DataFrame:
    """Distinct URLs whose request ended in an error that is not retried: a
    PermanentError or an error of no known class."""
    failed = F.col("error_type").isNotNull() & ~is_retryable("error_type")
    return outcomes.filter(failed).select("url").distinct()


# A6 ---------------------------------------------------------------------------
def success_error_split(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(F.count_if(F.col("error_type").isNull()).alias("ok"),
                        F.count_if(F.col("error_type").isNotNull()).alias("errors"))


# A8 ---------------------------------------------------------------------------
def last_error_per_url(outcomes: DataFrame) -> DataFrame:
    """Last write wins: the latest failed request's error per URL."""
    err = F.concat(F.col("error_type"), F.lit(": "), F.col("status").cast("string"))
    f = outcomes.filter(F.col("error_type").isNotNull())
    return f.groupBy("url").agg(F.max_by(err, F.struct("ts", "event_id")).alias("last_error"),
                                F.count(F.lit(1)).alias("n_failures"))


# A9 ---------------------------------------------------------------------------
def with_bar(counts: DataFrame, n_col: str = "n") -> DataFrame:
    """Bar width in % of the largest bucket.  ``counts`` is already aggregated
    (a handful of buckets), so the unpartitioned window is tiny."""
    return counts.withColumn("bar_pct", F.round(F.col(n_col) * 100.0 / F.max(n_col).over(W.partitionBy()), 1))


def report_table(outcomes: DataFrame, k: int = 10) -> DataFrame:
    """Status buckets and top domains with bar widths, in one table."""
    s = with_bar(status_distribution(outcomes)).select(F.lit("status").alias("section"),
                                                      F.col("status").alias("bucket"), "n", "bar_pct")
    d = with_bar(top_domains(outcomes, k=k)).select(F.lit("domain").alias("section"),
                                                   F.col("domain").alias("bucket"), "n", "bar_pct")
    return s.unionByName(d)


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row results side by side: their union, aggregated to the one value of each column."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])


# A10 --------------------------------------------------------------------------
def error_report(attempts: DataFrame, outcomes: DataFrame, sample: int = 5) -> DataFrame:
    """One-row JSON document: A1 + A4 + A5 + A7, each a one-row aggregate."""
    from .retries import retry_summary
    a1 = run_summary(outcomes)
    a4 = error_counts(outcomes).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("error_type", "n")))).alias("error_stats"))
    # the sample is a limit by design (the reference shows 5); the count is exact
    a5 = permanent_error_urls(outcomes).agg(F.count(F.lit(1)).alias("permanent_error_count"))
    smp = (permanent_error_urls(outcomes).orderBy("url").limit(sample)
           .agg(F.array_sort(F.collect_list("url")).alias("permanent_error_sample")))
    j = one_row(a1, a4, a5, smp, retry_summary(attempts))
    # in the document: times as ISO text, fractional numbers as DECIMAL(20,6)
    # (plain digits, never scientific notation)
    fields = []
    for c in j.columns:
        if c in ("start_time", "end_time"):
            fields.append(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c))
        elif c in ("duration", "average_speed", "avg_response_time", "total_retry_time", "mean_retry_time"):
            fields.append(F.round(c, 6).cast("decimal(20,6)").alias(c))
        else:
            fields.append(F.col(c))
    return j.select(F.to_json(F.struct(*fields)).alias("report"), *j.columns)

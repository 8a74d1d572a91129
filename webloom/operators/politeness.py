"""Per-domain politeness audits over outcome rows: W4 backoff multiplier,
W5 rate compliance, W6 rolling failure count, W8 concurrency profile,
W9 latest records.

Ordered per-domain logic uses the bucketed helpers of ``sequence`` (a hot
domain is split into time buckets) or "halo" buckets for the time-range
window (W6): each failure is copied into its own bucket and the next one, so
a range frame never needs more than one bucket and its predecessor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.outcomes import counts_for_breaker
from .sequence import KEY_BUCKET_SECONDS, GLOBAL_BUCKET_SECONDS, Prefix, prefix_aggregate, previous_row, time_bucket, top_n_per_key

ORDER = ["ts", "event_id"]


def _cap(rps: float, min_delay: float, max_backoff: float) -> float:
    return max_backoff / (1.0 / rps + min_delay)


# W4 ---------------------------------------------------------------------------
def backoff(outcomes: DataFrame, factor: float = 2.0, rps: float = 5.0, min_delay: float = 0.5,
            max_backoff: float = 60.0, bucket_seconds: int = KEY_BUCKET_SECONDS) -> DataFrame:
    """Multiplier after each request: ``min(factor ** k, cap)``, k = failures
    since the domain's last success (any failure class), 1.0 after a success."""
    x = outcomes.withColumn("_bk", time_bucket("ts", bucket_seconds))
    x = prefix_aggregate(x, ["domain"], ORDER, "_bk",
                         [Prefix("_cnt", F.lit(1)), Prefix("_okc", F.col("error_type").isNull(), how="last")])
    k = (F.col("_cnt") - F.coalesce(F.col("_okc"), F.lit(0))).cast("int")
    mult = F.when(k == 0, F.lit(1.0)).otherwise(F.least(F.pow(F.lit(float(factor)), k),
                                                          F.lit(_cap(rps, min_delay, max_backoff))))
    return x.select("event_id", "domain", "ts", "error_type", k.alias("fails_since_success"),
                    F.round(mult, 6).alias("backoff_multiplier"))


# W5 ---------------------------------------------------------------------------
def rate_compliance(outcomes: DataFrame, delays: DataFrame | None = None, rps: float = 5.0,
                    min_delay: float = 0.5, factor: float = 2.0, max_backoff: float = 60.0,
                    per_domain: bool = True, bucket_seconds: int = KEY_BUCKET_SECONDS,
                    default_crawl_delay: float = 1.0) -> DataFrame:
    """Gap to the previous request of the domain (or of the whole log when
    ``per_domain`` is False) against the limiter's lower bound
    ``min((max(min_delay, 1/rps) + 0) * multiplier_before, max_backoff)``
    (jitter's lower bound is 0), and against the robots crawl delay."""
    b = backoff(outcomes, factor, rps, min_delay, max_backoff, bucket_seconds)
    keys = ["domain"] if per_domain else []
    x = b.withColumn("_bk", time_bucket("ts", bucket_seconds if per_domain else
                                        min(bucket_seconds, GLOBAL_BUCKET_SECONDS)))
    x = previous_row(x, keys, ORDER, "_bk", ["ts", "backoff_multiplier"])
    base = max(min_delay, 1.0 / rps)
    mult_before = F.coalesce(F.col("prev_backoff_multiplier"), F.lit(1.0))
    required = F.least(F.lit(base) * mult_before, F.lit(float(max_backoff)))
    gap = (F.unix_micros("ts") - F.unix_micros("prev_ts")) / F.lit(1e6)
    y = x.select("event_id", "domain", "ts", F.round(gap, 6).alias("gap_s"),
                 F.round(required, 6).alias("required_gap_s"))
    if delays is not None:
        y = y.join(delays.select("domain", "crawl_delay"), "domain", "left")
        cd = F.coalesce(F.col("crawl_delay"), F.lit(default_crawl_delay))
    else:
        cd = F.lit(default_crawl_delay)
    return y.select("event_id", "domain", "ts", "gap_s", "required_gap_s",
                    F.coalesce(F.col("gap_s") >= F.col("required_gap_s"), F.lit(True)).alias("rate_ok"),
                    cd.alias("crawl_delay"),
                    F.coalesce(F.col("gap_s") >= cd, F.lit(True)).alias("delay_ok"))


# W6 ---------------------------------------------------------------------------
def rolling_failures(outcomes: DataFrame, window_s: float = 60.0) -> DataFrame:
    """For each outcome row: breaker-counting failures of its domain within
    ``[ts - window, ts]`` up to and including the row (inclusive edge)."""
    w_us = int(window_s * 1_000_000)
    x = outcomes.select("event_id", "domain", "ts",
                        counts_for_breaker("error_type").alias("counting"),
                        F.unix_micros("ts").alias("_us"))
    x = x.withColumn("_bk", F.floor(F.col("_us") / F.lit(w_us)).cast("long"))
    own = x.withColumn("_own", F.lit(True))
    halo = (x.filter("counting").withColumn("_bk", F.col("_bk") + 1).withColumn("_own", F.lit(False)))
    u = own.unionByName(halo)
    part = W.partitionBy("domain", "_bk")
    fr = part.orderBy("_us").rangeBetween(-w_us, 0)
    later_ties = (W.partitionBy("domain", "_bk", "_us").orderBy("event_id")
                  .rowsBetween(1, W.unboundedFollowing))
    c = F.count_if(F.col("counting")).over(fr) - F.coalesce(F.count_if(F.col("counting")).over(later_ties), F.lit(0))
    y = u.withColumn("failures_in_window", c.cast("long")).filter("_own")
    return y.select("event_id", "domain", "ts", "counting", "failures_in_window")


# W8 ---------------------------------------------------------------------------
def request_intervals(attempts: DataFrame) -> DataFrame:
    """One interval per request: first attempt start to last attempt end
    (the semaphore is held across retries).  Requests are bounded groups."""
    end_us = F.unix_micros("ts") + F.round(F.col("elapsed_s") * 1e6).cast("long")
    return (attempts.groupBy("domain", "url", "run", "request_no")
            .agg(F.min(F.unix_micros("ts")).alias("start_us"), F.max(end_us).alias("end_us"),
                 F.min("event_id").alias("req_id")))


def active_requests(attempts: DataFrame, per_domain: bool = True, bucket_seconds: int = KEY_BUCKET_SECONDS) -> tuple[DataFrame, list[str]]:
    """Every start and end of a request (ends first at equal times) with the number of active requests
    after it, per domain or over the whole log, in time buckets; and the key columns."""
    iv = request_intervals(attempts)
    ev = (iv.select("domain", "req_id", F.col("start_us").alias("t"), F.lit(1).alias("delta"))
          .unionByName(iv.select("domain", "req_id", F.col("end_us").alias("t"), F.lit(-1).alias("delta"))))
    keys = ["domain"] if per_domain else []
    width = bucket_seconds if per_domain else min(bucket_seconds, GLOBAL_BUCKET_SECONDS)
    ev = ev.withColumn("_bk", F.floor(F.col("t") / F.lit(width * 1_000_000)).cast("long"))
    return prefix_aggregate(ev, keys, ["t", "delta", "req_id"], "_bk", [Prefix("active", F.col("delta"))]), keys


def concurrency_profile(attempts: DataFrame, per_domain_limit: int = 5, global_limit: int = 10,
                        per_domain: bool = True, bucket_seconds: int = KEY_BUCKET_SECONDS) -> DataFrame:
    """Per domain (or globally): peak of active requests, first time at peak, starts over the limit."""
    ev, keys = active_requests(attempts, per_domain, bucket_seconds)
    limit = per_domain_limit if per_domain else global_limit
    g = ev.groupBy(*keys) if keys else ev.groupBy()
    out = g.agg(F.max("active").alias("peak_active"),
                F.timestamp_micros(F.max_by("t", F.struct(F.col("active"), -F.col("t")))).alias("peak_at"),
                F.count_if((F.col("delta") == 1) & (F.col("active") > limit)).alias("over_limit_starts"),
                F.min("active").alias("min_active"))
    if not keys:
        out = out.select(F.lit("*").alias("domain"), "*")
    return out


def concurrency_steps(attempts: DataFrame, per_domain: bool = True, bucket_seconds: int = KEY_BUCKET_SECONDS) -> DataFrame:
    """The profile over time: (domain, at, active) at every time something starts or ends."""
    ev, keys = active_requests(attempts, per_domain, bucket_seconds)
    last = ev.groupBy(*keys, "t").agg(F.max_by("active", F.struct("delta", "req_id")).alias("active"))
    return last.select(F.col("domain") if keys else F.lit("*").alias("domain"), F.timestamp_micros("t").alias("at"), "active")


def over_limit_spans(attempts: DataFrame, limit: int = 5, per_domain: bool = True,
                     bucket_seconds: int = KEY_BUCKET_SECONDS) -> DataFrame:
    """(domain, span_start, span_end, peak_active, starts): every span in which more than ``limit`` requests are active.

    A span starts where the count first passes the limit and ends where it is back at it.  Both are
    edges between neighbouring events; the previous event's state is carried over bucket edges, so a span that covers
    many buckets is stitched by numbering the edges, and no domain's events meet in one task."""
    ev, keys = active_requests(attempts, per_domain, bucket_seconds)
    order = ["t", "delta", "req_id"]
    x = previous_row(ev.select(*keys, *order, "_bk", "active"), keys, order, "_bk", ["active"])
    over, before = F.col("active") > limit, F.coalesce(F.col("prev_active"), F.lit(0)) > limit
    x = x.withColumn("_over", over).withColumn("_edge", over & ~before).where(over | before)
    x = prefix_aggregate(x, keys, order, "_bk", [Prefix("_span", F.col("_edge").cast("int"))])
    out = x.groupBy(*keys, "_span").agg(F.min("t").alias("a"), F.max("t").alias("z"), F.max("active").alias("peak_active"),
                                        F.count_if(F.col("_over") & (F.col("delta") == 1)).alias("starts"))
    return out.select(F.col("domain") if keys else F.lit("*").alias("domain"), F.timestamp_micros("a").alias("span_start"),
                      F.timestamp_micros("z").alias("span_end"), F.col("peak_active").cast("long").alias("peak_active"), "starts")


# W9 ---------------------------------------------------------------------------
def latest_per_domain(outcomes: DataFrame, n: int = 3) -> DataFrame:
    """Latest n requests of each domain (two-step top-n, skew-safe)."""
    x = outcomes.select("event_id", "domain", "url", "ts", "status")
    return top_n_per_key(x, ["domain"], [F.desc("ts"), F.desc("event_id")], n)


def latest(df: DataFrame, n: int = 3, order=("ts", "event_id")) -> DataFrame:
    """Latest n rows overall: TakeOrderedAndProject, no global sort."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)

"""Skew-safe ordered computations per key (running sums/maxima, count at the
last flagged row, previous row, top-n).

A plain ``Window.partitionBy(domain).orderBy(ts)`` puts every row of a key in
one task; with one domain holding a third of the log that task holds a third
of the data.  These helpers split each key's sequence into time buckets:

1. one shuffle on (key, bucket); running values *inside* each bucket
   (windows bounded by one bucket);
2. a per-(key, bucket) summary (a partial aggregation of the input, or taken
   from the windowed rows when positions inside the bucket are needed) and a
   carry over earlier buckets: a window over the small summary table only;
3. the carry joined back on (key, bucket): the big side keeps its
   partitioning, only the small side moves (AQE broadcasts it when measured
   small).

The result equals the unbucketed window exactly; only the partitioning differs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# default widths: one hour per key bounds the largest task by a hot key's
# hourly volume; a sequence over the whole log (no key) uses one minute
KEY_BUCKET_SECONDS = 3_600
GLOBAL_BUCKET_SECONDS = 60


def time_bucket(ts_col: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts_col)) / F.lit(seconds * 1_000_000)).cast("long")


@dataclass(frozen=True)
class Prefix:
    """One running value.

    how = "sum" | "max": running sum / max of ``value``;
    how = "last": running row count up to the last row where ``value`` (a
    boolean) is true, i.e. the position of the last flagged row (null if none).
    """
    out: str
    value: Column
    how: str = "sum"
    inclusive: bool = True


def prefix_aggregate(df: DataFrame, keys: list[str], order: list[str], bucket: str,
                     specs: list[Prefix], last_flag: str | None = None) -> DataFrame:
    """Running values per key in ``order``; optional flag for the key's last row."""
    vals = [f"_pv{i}" for i in range(len(specs))]
    wr = W.partitionBy(*keys, bucket).orderBy(*order)
    x = df.select("*", F.row_number().over(wr).alias("_wn"), *[s.value.alias(v) for s, v in zip(specs, vals)])

    def frame(s: Prefix):
        return wr.rowsBetween(W.unboundedPreceding, 0 if s.inclusive else -1)

    within = []
    for s, v in zip(specs, vals):
        if s.how == "sum":
            c = F.sum(v).over(frame(s))
        elif s.how == "max":
            c = F.max(v).over(frame(s))
        else:
            c = F.max(F.when(F.col(v), F.col("_wn"))).over(frame(s))
        within.append(c.alias(f"_w{v}"))
    x = x.select("*", *within)

    if all(s.how in ("sum", "max") for s in specs):
        # bucket totals straight from the input: a partial (map-side)
        # aggregation, so this branch shuffles per-bucket partials, not rows
        src = df.select(*keys, bucket, *[s.value.alias(v) for s, v in zip(specs, vals)])
        aggs = [F.count(F.lit(1)).alias("_bn")]
    else:
        # "last" needs row positions inside the bucket: take them from x
        src = x
        aggs = [F.max("_wn").alias("_bn")]
    for s, v in zip(specs, vals):
        if s.how == "sum":
            aggs.append(F.sum(v).alias(f"_b{v}"))
        elif s.how == "max":
            aggs.append(F.max(v).alias(f"_b{v}"))
        else:
            aggs.append(F.max(F.when(F.col(v), F.col("_wn"))).alias(f"_b{v}"))
    b = src.groupBy(*keys, bucket).agg(*aggs)
    wb = W.partitionBy(*keys).orderBy(bucket)
    before = wb.rowsBetween(W.unboundedPreceding, -1)
    b = b.select("*", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_cbefore"))
    carry = []
    for s, v in zip(specs, vals):
        if s.how == "sum":
            carry.append(F.sum(f"_b{v}").over(before).alias(f"_c{v}"))
        elif s.how == "max":
            carry.append(F.max(f"_b{v}").over(before).alias(f"_c{v}"))
        else:
            carry.append(F.max(F.col("_cbefore") + F.col(f"_b{v}")).over(before).alias(f"_c{v}"))
    extra = []
    if last_flag:
        extra = [(F.col(bucket) == F.max(bucket).over(W.partitionBy(*keys))).alias("_blast"), "_bn"]
    b = b.select(*keys, bucket, "_cbefore", *carry, *extra)

    j = x.join(b, keys + [bucket])
    out = []
    for s, v in zip(specs, vals):
        w_, c_ = F.col(f"_w{v}"), F.col(f"_c{v}")
        if s.how == "sum":
            col = F.coalesce(c_, F.lit(0)) + F.coalesce(w_, F.lit(0))
        elif s.how == "max":
            col = F.greatest(c_, w_)
        else:
            col = F.coalesce(F.col("_cbefore") + w_, c_)
        out.append(col.alias(s.out))
    if last_flag:
        out.append((F.col("_blast") & (F.col("_wn") == F.col("_bn"))).alias(last_flag))
    return j.select(*df.columns, *out)


def running_count(out: str = "_cnt") -> Prefix:
    return Prefix(out, F.lit(1))


def previous_row(df: DataFrame, keys: list[str], order: list[str], bucket: str,
                 cols: list[str], prefix: str = "prev_") -> DataFrame:
    """``lag(col)`` over (keys ordered by order) for each col, bucketed."""
    wr = W.partitionBy(*keys, bucket).orderBy(*order)
    x = df.select("*", F.row_number().over(wr).alias("_wn"),
                  *[F.lag(c).over(wr).alias(f"_lag_{c}") for c in cols])
    st = F.struct(*[F.col(c).alias(c) for c in cols])
    last = x.groupBy(*keys, bucket).agg(F.max_by(st, F.col("_wn")).alias("_last"))
    last = last.select(*keys, bucket,
                       F.lag("_last").over(W.partitionBy(*keys).orderBy(bucket)).alias("_carry"))
    j = x.join(last, keys + [bucket])
    out = [F.when(F.col("_wn") == 1, F.col("_carry")[c]).otherwise(F.col(f"_lag_{c}")).alias(prefix + c)
           for c in cols]
    return j.select(*df.columns, *out)


# Spark plans ``row_number() <= n`` with a partial WindowGroupLimit below the
# shuffle (only n rows per key leave each map task) up to this n
WINDOW_GROUP_LIMIT_MAX = 1000


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, salt_buckets: int = 16,
                  salt_col: Column | None = None, rank_col: str = "rank") -> DataFrame:
    """Top-n rows per key without sorting a hot key in one task.

    For n up to ``WINDOW_GROUP_LIMIT_MAX`` a plain ``row_number() <= n`` is
    enough: the optimizer adds a partial group limit before the exchange.
    Larger n go in two steps: per (key, salt) first, then per key over at
    most n x salt_buckets survivors."""
    if n <= WINDOW_GROUP_LIMIT_MAX and salt_col is None:
        x = df.withColumn(rank_col, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        return x.filter(F.col(rank_col) <= n)
    salt = salt_col if salt_col is not None else F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    x = df.withColumn("_salt", salt)
    x = x.withColumn("_r1", F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(*order))).filter(F.col("_r1") <= n)
    x = x.withColumn(rank_col, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(rank_col) <= n)
    return x.drop("_salt", "_r1")

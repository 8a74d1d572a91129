"""The bucketed (skew-safe) ordered helpers equal plain windows; hot key included."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webloom.operators.sequence import Prefix, prefix_aggregate, previous_row, top_n_per_key


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"
        rows.append((i, k, rnd.randint(0, 500), rnd.random() < 0.3, rnd.randint(-5, 5)))
    df = spark.createDataFrame(rows, "id long, k string, t long, flag boolean, v int")
    return df.withColumn("bk", F.floor(F.col("t") / 37).cast("long"))


def test_prefix_equals_window(spark):
    df = _data(spark)
    specs = [Prefix("c", F.lit(1)), Prefix("s", F.col("v"), inclusive=False),
             Prefix("m", F.when(F.col("flag"), F.col("id")), how="max")]
    got = prefix_aggregate(df, ["k"], ["t", "id"], "bk", specs, last_flag="last")
    w = W.partitionBy("k").orderBy("t", "id")
    exp = df.select("id", F.count(F.lit(1)).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("c"),
                    F.sum("v").over(w.rowsBetween(W.unboundedPreceding, -1)).alias("s"),
                    F.max(F.when(F.col("flag"), F.col("id"))).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("m"),
                    (F.row_number().over(W.partitionBy("k").orderBy(F.desc("t"), F.desc("id"))) == 1).alias("last"))
    g = {r.id: (r.c, r.s or 0, r.m, r.last) for r in got.collect()}
    e = {r.id: (r.c, r.s or 0, r.m, r.last) for r in exp.collect()}
    assert g == e


def test_previous_row_equals_lag(spark):
    df = _data(spark)
    got = {r.id: (r.prev_t, r.prev_v) for r in previous_row(df, ["k"], ["t", "id"], "bk", ["t", "v"]).collect()}
    w = W.partitionBy("k").orderBy("t", "id")
    exp = {r.id: (r.a, r.b) for r in df.select("id", F.lag("t").over(w).alias("a"), F.lag("v").over(w).alias("b")).collect()}
    assert got == exp


def test_top_n_per_key(spark):
    df = _data(spark)
    got = {(r.k, r.rank): r.id for r in top_n_per_key(df, ["k"], [F.desc("t"), F.desc("id")], 3).collect()}
    w = W.partitionBy("k").orderBy(F.desc("t"), F.desc("id"))
    exp = {(r.k, r.rank): r.id for r in df.withColumn("rank", F.row_number().over(w)).filter("rank <= 3").collect()}
    assert got == exp

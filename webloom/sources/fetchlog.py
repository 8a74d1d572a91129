"""Request-log source: ``fetch_log`` (FETCH_LOG schema) and its fixture adapter.

The test data holds no crawl log, so one is derived from ``events`` by a
fixed rule (same SQL on the DuckDB side): 40 hosts, 7 paths per host, a
status per event (failures spread over 429/503/404/403/no answer).  Any real
log with the FETCH_LOG columns can be used instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.outcomes import error_class, error_class_sql
from ..session import read_table

FETCH_LOG_SCHEMA = ("event_id LONG, url STRING, domain STRING, ts TIMESTAMP, elapsed_s DOUBLE, "
                    "status INT, error_type STRING")

# fixed values of the adapter rule
N_HOSTS = 40
N_PATHS = 7


def from_events(events: DataFrame) -> DataFrame:
    host = F.concat(F.lit("d"), (F.col("user_id") % N_HOSTS).cast("string"), F.lit(".example.com"))
    status = (F.when(F.col("event_type") != "error", F.lit(200))
              .when(F.col("event_id") % 5 == 0, F.lit(429))
              .when(F.col("event_id") % 5 == 1, F.lit(503))
              .when(F.col("event_id") % 5 == 2, F.lit(404))
              .when(F.col("event_id") % 5 == 3, F.lit(403))
              .otherwise(F.lit(0)))
    x = events.select(
        F.col("event_id").cast("long").alias("event_id"),
        F.concat(F.lit("https://"), host, F.lit("/p/"), (F.col("event_id") % N_PATHS).cast("string")).alias("url"),
        host.alias("domain"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") / F.lit(100.0)).cast("double").alias("elapsed_s"),
        status.cast("int").alias("status"))
    return x.withColumn("error_type", error_class("status"))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(read_table(spark, sf_dir, "events"))


FETCH_LOG_SQL = f"""SELECT event_id, url, domain, ts, elapsed_s, status, {error_class_sql('status')} AS error_type
FROM (SELECT CAST(event_id AS BIGINT) AS event_id,
             'https://d' || CAST(user_id % {N_HOSTS} AS VARCHAR) || '.example.com/p/' || CAST(event_id % {N_PATHS} AS VARCHAR) AS url,
             'd' || CAST(user_id % {N_HOSTS} AS VARCHAR) || '.example.com' AS domain,
             CAST(ts AS TIMESTAMP) AS ts,
             CAST(value / 100.0 AS DOUBLE) AS elapsed_s,
             CAST(CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 5 = 0 THEN 429
                       WHEN event_id % 5 = 1 THEN 503 WHEN event_id % 5 = 2 THEN 404
                       WHEN event_id % 5 = 3 THEN 403 ELSE 0 END AS INTEGER) AS status
      FROM events)"""

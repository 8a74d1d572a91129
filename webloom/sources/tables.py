"""S1 and the driver tables: explicit schemas, column pruning at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table

PAGES_SCHEMA = "page_id LONG, url STRING, html STRING"


def pages(spark: SparkSession, sf_dir: str, with_html: bool = True) -> DataFrame:
    """S1 page corpus scan.  Without ``html`` the scan never reads that column."""
    df = read_table(spark, sf_dir, "pages")
    cols = ["page_id", "url"] + (["html"] if with_html else [])
    return df.select(*[F.col(c) for c in cols])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def lineitem_edges_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")

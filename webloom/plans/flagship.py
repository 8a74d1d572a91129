"""Flagship job: page records of the corpus with their domain's weight.

scan(pages) -> X9 record projection (narrow, one stage)
            -> join with per-domain counts (U1 + A3: partial+final aggregate)
The domain table has one row per host; it is joined by hash on ``domain``
(AQE turns it into a broadcast at run time when it measures small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import netloc
from ..operators.extract import page_records
from ..sources.tables import pages


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pages(spark, sf_dir)
    rec = page_records(p).withColumn("domain", netloc("url"))
    dom = (pages(spark, sf_dir, with_html=False).select(netloc("url").alias("domain"))
           .filter(F.col("domain") != "").groupBy("domain").agg(F.count(F.lit(1)).alias("domain_pages")))
    # share of the corpus: the total is a scalar subquery
    total = dom.agg(F.sum("domain_pages")).scalar()
    dom = dom.select("domain", "domain_pages", F.round(F.col("domain_pages") / total, 6).alias("domain_share"))
    return (rec.join(dom, "domain", "left")
            .select("page_id", "url", "domain", "domain_pages", "domain_share", "title", "description", "keywords",
                    F.length("text").alias("text_length"), "links", "images", "headings", "tables", "lists"))

"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its
predecessor kept; its output is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.

1. toxicity: documents scored 0.3 or more go (classifier trained on ``labels``)
2. n-gram Jaccard join: of linked documents (5-word shingles, 80 in 100) the
   one with the smallest doc_id stays
3. benchmark decontamination: documents with a passage of ``benchmark`` go
4. PII: personal data in the texts becomes ``<EMAIL>``, ``<IP>``, ``<CARD>``, ``<PHONE>``
5. best-fit packing into sequences of at most 2048 tokens

Rows with a null doc_id are never dropped by stages 2 and 3, which name
documents by id; rows of equal doc_id and text are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import decontaminate, jaccard_join, packing, pii, toxicity
from webloom.llm.common import cut_lineage, prepare, table
from webloom.llm.tokenize import vocabulary

#: pieces of text that a packing worker keeps: it also holds what the stages before it left there
PIECES_KEPT = 1 << 18


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    group = cut_lineage(jaccard_join.jaccard_components(docs, k=5, num=80, den=100))
    copies = group.where("doc_id != component_id").select("doc_id").distinct()
    repeated = group.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    kept = docs.join(copies, "doc_id", "left_anti")
    once = kept.join(repeated, "doc_id", "left_anti")
    again = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    leaks = cut_lineage(decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct())
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = pii.redact(docs, pii.fit(docs))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    packed = packing.pack(docs, vocabulary("byte_bpe_50k.json"), entries=PIECES_KEPT)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", redact_private),
    ("best_fit_packing", pack),
]

#: the stages are trained models, tokenizers and packing: checked against a
#: brute-force version in tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

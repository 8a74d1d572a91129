"""Crawl records and their sinks/readers: K1–K8, S2–S4, E1.

Records are ordinary DataFrames in the ``CRAWL_RECORD`` shape; every sink is a
function ``(df) -> None`` (E1), so a fan-out (K4) or a streaming
``foreachBatch`` can call any list of them.  "Missing" values are empty values
('' / [] / {}), never nulls, as in the stored files of the reference.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

Sink = Callable[[DataFrame], None]

CRAWL_RECORD = (
    "url STRING, title STRING, text STRING, text_length INT, links ARRAY<STRING>, "
    "images ARRAY<STRUCT<src: STRING, alt: STRING>>, "
    "headings STRUCT<h1: ARRAY<STRING>, h2: ARRAY<STRING>, h3: ARRAY<STRING>>, "
    "metadata MAP<STRING, STRING>, error STRING, crawled_at TIMESTAMP, status_code INT, content_type STRING")

# fixed values: CSV header order of the reference sink
CSV_FIELDS = ["url", "title", "text", "links", "metadata", "crawled_at", "status_code", "content_type",
              "text_length", "images_count", "headings", "error"]
JSON_IN_CSV = ("links", "metadata", "headings")
EMPTY_HEADINGS = "struct(array() AS h1, array() AS h2, array() AS h3)"


# K5 ---------------------------------------------------------------------------
def page_records_to_crawl_records(pages_rec: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """X9 records -> CRAWL_RECORD: metadata from description/keywords,
    ``text_length = length(text)``, ``error = ''``; status/content type/time
    from the fetch outcome when one is given (else 200 / text/html / null)."""
    r = pages_rec
    if fetched is not None:
        r = r.join(fetched.select("url", "status", "content_type", "fetched_at"), "url", "left")
        status = F.coalesce(F.col("status"), F.lit(200))
        ctype = F.coalesce(F.col("content_type"), F.lit("text/html"))
        at = F.col("fetched_at")
    else:
        status, ctype, at = F.lit(200), F.lit("text/html"), F.lit(None).cast("timestamp")
    return r.select(
        "url", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("text", F.lit("")).alias("text"),
        F.length(F.coalesce("text", F.lit(""))).alias("text_length"),
        "links", "images", "headings",
        F.create_map(F.lit("description"), F.col("description"), F.lit("keywords"), F.col("keywords"))
        .alias("metadata"),
        F.lit("").alias("error"), at.alias("crawled_at"), status.cast("int").alias("status_code"),
        ctype.alias("content_type"))


# K6 ---------------------------------------------------------------------------
def error_records(failures: DataFrame) -> DataFrame:
    """(url, error, crawled_at) -> CRAWL_RECORD rows with status_code 0."""
    return failures.select("url", F.col("error"), F.col("crawled_at").cast("timestamp").alias("crawled_at"),
                           F.lit(0).alias("status_code"))


def union_records(ok: DataFrame, err: DataFrame) -> DataFrame:
    """One table for both: missing columns become their empty values."""
    u = ok.unionByName(err, allowMissingColumns=True)
    return u.select(
        "url", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("text_length", F.lit(0)).alias("text_length"),
        F.coalesce("links", F.array().cast("array<string>")).alias("links"),
        F.coalesce("images", F.array().cast("array<struct<src:string,alt:string>>")).alias("images"),
        F.coalesce("headings", F.expr(EMPTY_HEADINGS).cast("struct<h1:array<string>,h2:array<string>,h3:array<string>>"))
        .alias("headings"),
        F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
        F.coalesce("error", F.lit("")).alias("error"), "crawled_at",
        F.coalesce("status_code", F.lit(0)).alias("status_code"),
        F.coalesce("content_type", F.lit("")).alias("content_type"))


# K1 / S2 ------------------------------------------------------------------------
def with_crawled_at(df: DataFrame) -> DataFrame:
    if "crawled_at" not in df.columns:
        return df.withColumn("crawled_at", F.current_timestamp())
    return df.withColumn("crawled_at", F.coalesce(F.col("crawled_at"), F.current_timestamp()))


def jsonl_sink(path: str, mode: str = "append") -> Sink:
    """K1: one JSON object per line (never indented), ``crawled_at`` defaulted."""
    def write(df: DataFrame) -> None:
        with_crawled_at(df).write.mode(mode).json(path)
    return write


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Explicit schema, bad lines kept in ``_corrupt_record`` (not multiLine)."""
    schema = CRAWL_RECORD + ", _corrupt_record STRING"
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


# K2 / S3 ------------------------------------------------------------------------
def csv_rows(df: DataFrame, fields: Iterable[str] = CSV_FIELDS) -> DataFrame:
    """The CSV projection: header order, nested values as JSON text,
    ``images_count = size(images)``, missing -> '', extra columns dropped."""
    cols = []
    have = set(df.columns)
    for f in fields:
        if f == "images_count" and "images" in have:
            c = F.size("images").cast("string")
        elif f in JSON_IN_CSV and f in have:
            c = F.to_json(f)
        elif f in have:
            c = F.col(f).cast("string")
        else:
            c = F.lit("")
        cols.append(F.coalesce(c, F.lit("")).alias(f))
    return df.select(*cols)


def csv_sink(path: str, mode: str = "append", fields: Iterable[str] = CSV_FIELDS) -> Sink:
    def write(df: DataFrame) -> None:
        (csv_rows(df, fields).write.mode(mode).option("header", True).option("escape", '"')
         .option("quoteAll", False).csv(path))
    return write


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: header, quoted multi-line cells, JSON-in-cell columns decoded."""
    schema = ", ".join(f"{f} STRING" for f in CSV_FIELDS)
    raw = (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
           .csv(path))
    e = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)  # noqa: E731  (an empty cell is '', as csv.DictReader)
    return raw.select(
        e("url"), e("title"), e("text"),
        F.from_json("links", "array<string>").alias("links"),
        F.from_json("metadata", "map<string,string>").alias("metadata"),
        F.col("crawled_at").try_cast("timestamp").alias("crawled_at"),
        F.col("status_code").try_cast("int").alias("status_code"), e("content_type"),
        F.col("text_length").try_cast("int").alias("text_length"),
        F.col("images_count").try_cast("int").alias("images_count"),
        F.from_json("headings", "struct<h1:array<string>,h2:array<string>,h3:array<string>>").alias("headings"),
        e("error"))


# K3 / S4 ------------------------------------------------------------------------
TABLE_COLUMNS = ["url", "title", "text", "text_length", "links", "images", "headings", "metadata", "error",
                 "crawled_at", "status_code", "content_type"]


NEXT_ID = "webloom.next_id"


def table_sink(spark: SparkSession, table: str, buckets: int = 16, path: str | None = None) -> Sink:
    """K3: append to a Parquet table bucketed and sorted by ``url``, with a Parquet Bloom filter on it (the url
    index of the reference); duplicates are kept; each row gets ``saved_at`` and an
    ``id`` that is unique in the table and larger than those of earlier appends.  The next free id
    is a table property, set from what the write itself observed, so no append scans the table.
    Rows are dealt by ``url`` first, so an append writes one file per bucket.  ``buckets`` should grow with the table
    (a bucket is what a lookup reads).  With ``path`` the table's files live there (an
    external table, e.g. in the shared folder)."""
    def write(df: DataFrame) -> None:
        first = 0
        if spark.catalog.tableExists(table):
            known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
            first = int(known.get(NEXT_ID, 0))
        x = df.select(*[c for c in TABLE_COLUMNS if c in df.columns])
        x = x.withColumn("id", F.monotonically_increasing_id() + F.lit(first))
        x = x.withColumn("saved_at", F.current_timestamp()).repartition(buckets, "url")
        seen = Observation()
        w = (x.observe(seen, F.max("id").alias("last")).write.mode("append").format("parquet").bucketBy(buckets, "url").sortBy("url")
             .option("parquet.bloom.filter.enabled#url", "true"))
        if path:
            w = w.option("path", path)
        w.saveAsTable(table)
        last = seen.get["last"]
        if last is not None:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{NEXT_ID}' = '{last + 1}')")
    return write


def latest_from_table(spark: SparkSession, table: str, n: int = 3, order=("saved_at", "id")) -> DataFrame:
    """Projection, newest first, limit (TakeOrderedAndProject)."""
    return (spark.table(table).select("url", "title", "status_code", "saved_at", "id")
            .orderBy(*[F.desc(c) for c in order]).limit(n))


def lookup_url(spark: SparkSession, table: str, url: str) -> DataFrame:
    """Point lookup by url: one bucket is read, and of it the row groups that the Bloom filter and the
    min/max statistics leave."""
    return spark.table(table).filter(F.col("url") == url)


def lookup_urls(spark: SparkSession, table: str, urls: DataFrame) -> DataFrame:
    """The stored rows of every URL of a table: the URLs are dealt out as the stored table is, which
    itself is neither shuffled nor sorted again."""
    return spark.table(table).join(urls.select("url").distinct(), "url", "left_semi")


# K4 ---------------------------------------------------------------------------
def fan_out(df: DataFrame, sinks: Iterable[Sink]) -> None:
    """One result, many sinks: computed once into the shared folder (page bodies
    are not held in executor storage), then written by each."""
    x = cut_lineage(df)
    for s in sinks:
        s(x)


# K7 ---------------------------------------------------------------------------
def result_digest(fetched: DataFrame, n_chars: int | None = None) -> DataFrame:
    """url + the html (its first ``n_chars`` characters if the caller asks for a
    preview), or the error text."""
    body = F.coalesce("html", F.lit(""))
    return fetched.select("url", F.when(F.col("error").isNotNull() & (F.col("error") != ""), F.col("error"))
                          .otherwise(body if n_chars is None else F.substring(body, 1, n_chars)).alias("content"))


# K8 ---------------------------------------------------------------------------
def run_stats_row(outcomes: DataFrame, k: int = 10) -> DataFrame:
    """A1 + A2 (as a map) + A3 (as a list) in one row; every part is a one-row
    aggregate over already-aggregated (small) tables."""
    from ..operators.stats import one_row, run_summary, status_distribution, top_domains
    a1 = run_summary(outcomes)
    a2 = status_distribution(outcomes).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("status_code_distribution"))
    a3 = top_domains(outcomes, k=k).agg(
        F.array_sort(F.collect_list(F.struct(F.col("n") * -1, F.col("domain"), F.col("n").alias("count"))))
        .alias("_t")).select(F.transform("_t", lambda s: F.struct(s["domain"].alias("domain"), s["count"].alias("count")))
                             .alias("top_domains"))
    return one_row(a1, a2, a3)


def stats_sink(path: str) -> Sink:
    def write(df: DataFrame) -> None:
        df.coalesce(1).write.mode("overwrite").json(path)
    return write

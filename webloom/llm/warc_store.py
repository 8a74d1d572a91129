"""Operator 10 - content-addressed WARC archive.

Two tables make the archive:

* ``headers``: per record its exact WARC header block and, apart from it, the HTTP header of its
  block, with the SHA-256 address of its payload
* ``payloads``: every distinct payload once, by SHA-256

A record is rebuilt by joining its headers with its payload:
``header CRLF http-header payload CRLF CRLF`` (revisit records carry no
payload in their block, as WARC defines them; their payload is still reachable
by the join).  Reading parses the header text, joins the payload and verifies its
digest and length against the header; a mismatch raises an error.

Of records with equal payloads of at least ``revisit_min_bytes`` bytes the one
with the largest page_id is the response, the others are revisits of it.

All work is JVM-side expressions; texts are shuffled once to store each
payload once.  Reading back takes each stored payload's digest and length where it lies and
joins those to the headers; only :func:`records`, asked for whole records, shuffles payloads.  Hashing
happens before the shuffle and groups are pre-aggregated, so thousands of copies of a page move as digests.

Defined results: null html is the empty payload; null or empty url gives
an empty target; line breaks in a url are percent-encoded; equal rows: one of them is the
response; a null page_id counts as the smallest; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import cut_lineage, table

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "1970-01-01T00:00:00Z"  # the table holds no fetch time


def base32_of_hex(h: Column) -> Column:
    """RFC 4648 base32 (upper case) of a SHA-1 in hex: five hex digits are four
    base32 digits."""
    out = []
    for i in range(8):
        v = F.conv(F.substring(h, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(ALPHABET), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, rf"(?md)^{name}: ([^\r]*)\r$", 1)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          revisit_min_bytes: int = 0, date: str = DATE) -> None:
    """Write the archive's two tables under ``folder``."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = cut_lineage(pages.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.sha2(payload, 256).alias("sha256"), F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("bytes")))
    first = (base.where(F.col("bytes") >= revisit_min_bytes).groupBy("sha256")
             .agg(F.max(F.struct("page_id", "rid")).alias("m"), F.max(F.struct("page_id", "rid", "url"))["url"].alias("m_url")))
    name = lambda p, r: F.concat(F.lit("<urn:page:"), F.coalesce(p.cast("string"), F.lit("")), F.lit(":"),
                                 r.cast("string"), F.lit(">"))
    target = lambda u: F.regexp_replace(F.regexp_replace(F.coalesce(u, F.lit("")), "\r", "%0D"), "\n", "%0A")
    r = base.join(first, "sha256", "left")
    revisit = F.coalesce(F.col("rid") != F.col("m.rid"), F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", name(F.col("page_id"), F.col("rid"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", target(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", name(F.col("m.page_id"), F.col("m.rid"))),
            _line("WARC-Refers-To-Target-URI", target(F.col("m_url"))))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http;msgtype=response")), _line("Content-Length", length.cast("string")))
    r.select(header.alias("header"), http.alias("http"), F.unhex("sha256").alias("address")).write.mode("overwrite").parquet(f"{folder}/headers")
    (pages.select(F.unhex(F.sha2(payload, 256)).alias("address"), payload.alias("payload")).groupBy("address")
     .agg(F.first("payload").alias("payload")).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/payloads"))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """(header, http, payload, record, digest, size): every record rebuilt from the archive.  The digest and size of a
    payload are taken where it is read: who asks for no more of it shuffles no payload."""
    stored = spark.read.parquet(f"{folder}/headers")
    kept = spark.read.parquet(f"{folder}/payloads").select(
        "address", "payload", base32_of_hex(F.sha1("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    body = F.when(_field(F.col("header"), "WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit("\r\n\r\n").cast("binary")
    return stored.join(kept, "address").select(
        "header", "http", "payload",
        F.concat(F.col("header").cast("binary"), F.lit("\r\n").cast("binary"), F.col("http").cast("binary"), body, end).alias("record"),
        "digest", "size")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) parsed
    from the records, with every payload's digest and length verified."""
    h = F.col("header")
    stated = F.regexp_replace(_field(h, "WARC-Payload-Digest"), "^sha1:", "")
    digest, size = F.col("digest"), F.col("size")
    sound = (digest == stated) & (_field(F.col("http"), "Content-Length").cast("long") == size)
    number = lambda name: F.nullif(
        F.regexp_extract(_field(h, name), "<urn:page:(-?[0-9]*):", 1), F.lit("")).cast("long")
    return records(spark, folder).select(
        number("WARC-Record-ID").alias("page_id"), _field(h, "WARC-Target-URI").alias("url"),
        size.alias("payload_bytes"),
        F.when(sound, digest).otherwise(F.raise_error(F.lit("payload does not match its record header"))).alias("payload_digest"),
        _field(h, "WARC-Type").alias("record_type"), number("WARC-Refers-To").alias("refers_to"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive the whole ``pages`` table and read it back."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/warc-store-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_B32 = " || ".join(
    f"substr('{ALPHABET}', (CAST('0x' || substr(h, {5 * i + 1}, 5) AS INTEGER) >> {s}) % 32 + 1, 1)"
    for i in range(8) for s in (15, 10, 5, 0))
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT page_id, octet_length(b) AS n, h, max(page_id) OVER (PARTITION BY b) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM m
"""

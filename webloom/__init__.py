"""webloom: web-corpus and crawl-log analytics as Spark jobs.

Sub-packages
------------
functions  Column expressions (URL parts, outcome classes, HTML extraction).
sources    Table readers and derived inputs (pages, fetch_log, robots, sitemaps).
operators  DataFrame -> DataFrame jobs (extraction, links, stats, windows, graph).
plans      Composite jobs (crawl reachability, reports) and the query catalogue.
sinks      Writers (JSONL, CSV, table, fan-out).
streaming  Structured Streaming twins of the batch jobs.
"""

__version__ = "0.1.0"

"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully materialised with the ``noop`` sink (no collect to the
driver).  Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "x9_page_records", "x2_page_text", "x4_link_table", "x11_corpus_totals", "a3_top_page_domains",
    "a1_run_summary", "a8_last_error_per_url", "w1_attempt_numbering", "w2_retry_audit",
    "w4_backoff_multiplier", "w5_rate_compliance", "w6_rolling_failures", "w7_outages",
    "w8_concurrency_domains", "w9_latest_per_domain",
    "d3_reach_parts", "d4_page_budget", "j6_robots_allow", "s6_sitemap_expand",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from webloom.plans.catalog import QUERIES
    from webloom.session import build_session
    spark = build_session(f"local[{cpus}]", app="webloom-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    names = [q for q in HEADLINE if q in QUERIES]
    # warm-up (not timed): JVM and scan path, and the Python workers the pandas
    # operators use (a service keeps both running)
    QUERIES["s1_pages_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, 64, 1, int(cpus)).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

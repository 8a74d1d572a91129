"""Print the formatted physical plan of catalogue queries.

    python tools/explain.py [sf_dir] name [name ...]

Shows what reaches the scans (ReadSchema, PushedFilters), the exchanges and
joins chosen, and whether whole-stage codegen covers the projections.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from webloom.plans.catalog import QUERIES  # noqa: E402
from webloom.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    for name in args:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"===== {name}: exchanges={len(re.findall(r'Exchange ', plan))} "
              f"scans={plan.count('FileScan')} windows={len(re.findall(r'Window ', plan))}")
        df.explain("formatted")


if __name__ == "__main__":
    main()

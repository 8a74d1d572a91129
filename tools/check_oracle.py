"""Run each catalogue query on Spark and its oracle SQL on DuckDB; compare.

Comparison as the driver does it: columns sorted by name, rows compared as an
order-insensitive multiset after rounding doubles to 6 places.

    python tools/check_oracle.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import numpy as np

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from webloom.plans.catalog import ORACLE, QUERIES  # noqa: E402
from webloom.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, (float, np.floating)):
        f = float(v)
        return None if math.isnan(f) else round(f, 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, (dt.datetime, np.datetime64)):
        import pandas as pd
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, str) and pd.isna(v)):
            return None
    except (TypeError, ValueError):
        pass
    return v


def table(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            s_cols, s_rows = table(fn(spark, sf).toPandas())
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in ORACLE:
            print(f"---- {name}: spark {len(s_rows)} rows ({t1 - t0:.1f}s), no oracle")
            continue
        try:
            d_cols, d_rows = table(con.execute(ORACLE[name]).df())
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {type(e).__name__}: {str(e)[:600]}")
            bad += 1
            continue
        ok = s_cols == d_cols and s_rows == d_rows
        print(f"{'ok  ' if ok else 'FAIL'} {name}: spark {len(s_rows)} rows ({t1 - t0:.1f}s), duck {len(d_rows)} rows")
        if not ok:
            bad += 1
            if s_cols != d_cols:
                print("   cols", s_cols, d_cols)
            else:
                sd, dd = set(s_rows), set(d_rows)
                for r in list(sd - dd)[:3]:
                    print("   spark-only", str(r)[:400])
                for r in list(dd - sd)[:3]:
                    print("   duck-only ", str(r)[:400])
    print("bad", bad)


if __name__ == "__main__":
    main()

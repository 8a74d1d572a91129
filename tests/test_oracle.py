"""Every catalogue query against its DuckDB oracle on sf0.001 (the driver's
check at sf0.01 is the same comparison); queries without an oracle must run."""

import duckdb
import pytest

from tools.check_oracle import TABLES, table
from webloom.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    s_cols, s_rows = table(QUERIES[name](spark, SF).toPandas())
    if name in ORACLE:
        d_cols, d_rows = table(con.execute(ORACLE[name]).df())
        assert s_cols == d_cols
        assert s_rows == d_rows

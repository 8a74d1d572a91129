"""The registered queries: against DuckDB where SQL can express them, and their
columns otherwise (their operators have brute-force tests beside this file)."""

import duckdb
import pytest

from tools.check_oracle import TABLES, table
from webloom.llm import catalog

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2_": "doc_id start n_tokens ids_crc32",
    "op3_": "doc_id item_id",
    "op4_": "doc_id held_out score predicted",
    "op5_": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_": "doc_id n_shingles component_id",
    "op7_": "page_id url text n_chars",
    "op8_": "query_id rank vec_id score",
    "op9_": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10_": "page_id payload_bytes payload_digest record_type refers_to",
    "op11_": "doc_id n_shingles component_id kept",
    "op12_": "vec_id component n deviation whitened explained identity_error",
    "op13_": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def test_one_query_per_operator():
    assert sorted(n.split("_")[0] for n in catalog.QUERIES) == sorted(p[:-1] for p in COLUMNS)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = table(catalog.QUERIES[name](spark, SF).toPandas()), table(con.execute(catalog.ORACLE[name]).df())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_columns(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert set(COLUMNS[name.split("_")[0] + "_"].split()) <= set(df.columns)
    assert df.count() > 0

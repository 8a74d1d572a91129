"""The extraction oracles on HTML the driver tables lack (tables, images,
metas, h2/h3, ordered lists): Spark and DuckDB must agree on a fixture."""

import duckdb
import pandas as pd
import pytest

from tools.check_oracle import table
from webloom.plans.catalog import ORACLE, QUERIES

PAGES = [
    (1, "https://example.com/a/b.html?x=1#f", """<!DOCTYPE html><html><head><title>Test &amp; Page</title>
      <meta name="description" content="Test description"><meta name="keywords" content='k1, k2'>
      <meta name="description" content="Second wins"></head>
      <body><h1>Main <b>Header</b></h1><h2>Sub</h2><h3> </h3><h3>Third</h3>
      <p>Some text here.</p><a href="/page1">1</a><a href='../up'>2</a><a href=rel>3</a><a href="#x">4</a>
      <img src="image.png" alt="image"><img alt="no src"><IMG SRC="b.gif">
      <ul><li>Item 1</li><li>Item 2<li>Item 3</ul><ol><li>one</li><li></li></ol>
      <table><tr><th>H1</th><th>H2</th></tr><tr><td>Cell 1</td><td></td></tr><tr></tr></table>
      <table></table><table><tr><td>x &lt; y</td></tr></table></body></html>"""),
    (2, "http://other.org", "<html><body><h1>Unclosed tag</p><div class=\"ad\">A <i>d</i></div></body></html>"),
    (3, "http://third.net/dir/", "<div><p>Unclosed <span>"),
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.register("pages_df", pd.DataFrame(PAGES, columns=["page_id", "url", "html"]))
    c.execute("CREATE VIEW pages AS SELECT CAST(page_id AS BIGINT) AS page_id, url, html FROM pages_df")
    return c


@pytest.mark.parametrize("name", ["x1_title_meta", "x2_page_text", "x3_selector_text", "x4_link_table", "x5_images",
                                  "x6_headings", "x7_table_cells", "x8_list_items", "x9_page_records",
                                  "x11_corpus_totals", "u3_link_validity", "u4_resolved_links", "d1_link_dedup"])
def test_fixture(spark, con, tmp_path, name, monkeypatch):
    d = tmp_path / "sf"
    d.mkdir()
    spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1).write.parquet(
        str(d / "pages.parquet"))
    s_cols, s_rows = table(QUERIES[name](spark, str(d)).toPandas())
    d_cols, d_rows = table(con.execute(ORACLE[name]).df())
    assert s_cols == d_cols
    assert s_rows == d_rows
    assert s_rows

"""Page extraction jobs (X1–X3, X5–X9, X11) over the page table.

Titles, texts, links, images and headings are a narrow projection of the scan (no shuffle): one
pass of Catalyst expressions per page.  Tables, lists and selectors pair up tags page by page
(``operators.elements``): the pass also cuts the page into tags and text pieces, written once, and only
structural tags go to the Arrow function that finds their intervals.  Results are
per-page columns or long (element-per-row) tables via ``posexplode``, so they can be joined and
aggregated across the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from . import elements as E
from . import links as L

CLEAN = "_clean"


def cleaned(pages: DataFrame) -> DataFrame:
    """Project the cleaned html once; later extracts reuse the column."""
    return pages.select("page_id", "url", H.clean("html").alias(CLEAN))


# X1 ---------------------------------------------------------------------------
def meta(pages: DataFrame) -> DataFrame:
    c = cleaned(pages)
    return c.select("page_id", "url",
                    H.title(CLEAN).alias("title"),
                    H.meta_content(CLEAN, "description").alias("description"),
                    H.meta_content(CLEAN, "keywords").alias("keywords"))


# X2 ---------------------------------------------------------------------------
def text(pages: DataFrame) -> DataFrame:
    c = cleaned(pages).select("page_id", "url", H.page_text(CLEAN).alias("text"))
    return c.select("page_id", "url", "text", F.length("text").alias("text_length"))


# X3 ---------------------------------------------------------------------------
def selector_text(pages: DataFrame, selector: str) -> DataFrame:
    """Text of all elements that the selector names, elements inside each other included."""
    return E.selected(cleaned(pages), selector, CLEAN)


# X5 ---------------------------------------------------------------------------
def images(pages: DataFrame) -> DataFrame:
    c = cleaned(pages).select("page_id", F.posexplode(H.images(CLEAN)).alias("pos", "img"))
    return c.select("page_id", "pos", F.col("img.src").alias("src"), F.col("img.alt").alias("alt"))


# X6 ---------------------------------------------------------------------------
def headings(pages: DataFrame) -> DataFrame:
    """Long table (page_id, level, pos, text); pos counts within the level."""
    c = cleaned(pages)
    per_level = F.array(*(F.struct(F.lit(n).alias("level"), H.headings(CLEAN, n).alias("items"))
                          for n in (1, 2, 3)))
    x = c.select("page_id", F.explode(per_level).alias("h"))
    x = x.select("page_id", F.col("h.level").alias("level"), F.posexplode("h.items").alias("pos", "text"))
    return x


# X7 ---------------------------------------------------------------------------
def cells_from_tables(df: DataFrame, col: str = "tables") -> DataFrame:
    # outer: before a plain posexplode Spark filters by the tables' size, for which it finds and puts together all of them a
    # second time; the row of a page without tables ends at the next step
    t = df.select("page_id", F.posexplode_outer(col).alias("table_no", "rows"))
    r = t.select("page_id", "table_no", F.posexplode("rows").alias("row_no", "cells"))
    return r.select("page_id", "table_no", "row_no", F.posexplode("cells").alias("col_no", "text"))


def cells(pages: DataFrame) -> DataFrame:
    """Table-cell long table; a table also holds the rows and cells of tables inside it."""
    return cells_from_tables(E.with_structure(E.parsed(cleaned(pages), clean=CLEAN)))


# X8 ---------------------------------------------------------------------------
def items_from_lists(df: DataFrame, ul: str = "ul", ol: str = "ol") -> DataFrame:
    kinds = F.array(F.struct(F.lit("ul").alias("kind"), F.col(ul).alias("items")),
                    F.struct(F.lit("ol").alias("kind"), F.col(ol).alias("items")))
    x = df.select("page_id", F.explode(kinds).alias("k"))
    return x.select("page_id", F.col("k.kind").alias("kind"), F.posexplode("k.items").alias("pos", "text"))


def list_items(pages: DataFrame) -> DataFrame:
    """List-item long table; an item also holds the text of lists inside it."""
    x = E.with_structure(E.parsed(cleaned(pages), clean=CLEAN))
    return items_from_lists(x.select("page_id", "lists.ul", "lists.ol"))


# X9 ---------------------------------------------------------------------------
def page_records(pages: DataFrame, filter_external: bool = False, allowed_domains=None) -> DataFrame:
    """Whole ``PAGE`` record per page: one scan of the html makes all but tables and lists, which
    come from the structural tags of the same scan."""
    links = L.page_links_expr("url", CLEAN, filter_external, allowed_domains, parts_projected=True)
    cols = [H.title(CLEAN).alias("title"),
            H.meta_content(CLEAN, "description").alias("description"),
            H.meta_content(CLEAN, "keywords").alias("keywords"),
            links.alias("links"),
            H.images(CLEAN).alias("images"),
            H.headings_struct(CLEAN).alias("headings")]
    c = L.with_base_parts(cleaned(pages))
    x = E.with_structure(E.parsed(c, *cols, clean=CLEAN))
    return x.select("page_id", "url", "title", "description", "keywords",
                    F.array_join(F.filter(E.TEXT, lambda p: p != ""), " ").alias("text"),
                    "links", "images", "headings", "tables", "lists")


# X11 --------------------------------------------------------------------------
def corpus_totals(pages: DataFrame) -> DataFrame:
    """One row: pages, links, images, text characters (partial + final aggregate)."""
    c = L.with_base_parts(cleaned(pages))
    per_page = c.select(
        F.size(L.page_links_expr("url", CLEAN, parts_projected=True)).alias("n_links"),
        F.size(H.images(CLEAN)).alias("n_images"),
        F.length(H.page_text(CLEAN)).alias("n_chars"))
    return per_page.agg(F.count(F.lit(1)).alias("pages"),
                        F.coalesce(F.sum("n_links"), F.lit(0)).alias("links"),
                        F.coalesce(F.sum("n_images"), F.lit(0)).alias("images"),
                        F.coalesce(F.sum("n_chars"), F.lit(0)).alias("text_chars"))


def page_digest(pages: DataFrame, n_links: int = 5) -> DataFrame:
    """Per page: title, link count, first ``n_links`` links (in page order)."""
    c = L.with_base_parts(cleaned(pages)).select("page_id", "url", H.title(CLEAN).alias("title"),
                                                 L.page_links_expr("url", CLEAN, parts_projected=True).alias("links"))
    return c.select("page_id", "url", "title", F.size("links").alias("n_links"),
                    F.array_join(F.slice("links", 1, n_links), " ").alias("first_links"))

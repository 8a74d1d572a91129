"""Element intervals: which tags of a page open and close one element, found from depths.

A page is cut into tags, numbered from 1, and the text pieces between them (piece i stands behind
tag i).  The element that a start tag opens is the interval (start tag, end tag) in these numbers.  No tree is built
and inline tags play no part, so an unclosed ``<b>`` disturbs nothing; flat and nested markup
take the same way:

1. **Tables.** Running depth of ``<table>``/``</table>`` (+1, -1, never below 0: a stray end tag counts
   nothing).  The start that reaches depth d ends at the next end tag that leaves depth d; the table around
   any tag is the last one that reached the tag's depth.
2. **Rows and cells** of a table, apart from those of tables inside it: each ends at the next tag of
   its table that closes it (its end tag, the next cell or row, a section, the table's end), so omitted
   end tags need no repair.
3. **Scopes.** A cell shuts off what is in it: lists and other elements pair up inside their cell only, as
   an end tag in a cell closes nothing outside of it.
4. **Lists** by depth inside their scope as in 1, **items** of a list as in 2; any other element by the depth of its own tag.
   One without an end tag ends with its scope (``<p>``: at the next block).

All of it is running sums, last and next values by page and depth over the structural tags of a batch of pages, in
numpy inside an Arrow function (:func:`_intervals`): nothing is shuffled, sorted by Spark or joined back, and a task
holds one batch of tags.  Containment is never joined by ranges: a table's rows and a row's cells are slices of the
page's rows and cells in tag order, their ends are running counts at the tags.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..session import cut_lineage

ROW, TEXT, TAGS = "_row", "_pieces", "_tags"
#: tags worked on at once in a task
RUN = 1 << 18

# fixed values: tags that make tables and lists, and blocks that end a paragraph
SECTIONS = ("thead", "tbody", "tfoot", "caption", "colgroup")
CELLS = ("td", "th")
LISTS = ("ul", "ol")
STRUCTURE = ("table", "tr", *CELLS, *SECTIONS, *LISTS, "li")
BLOCKS = ("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5",
          "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dt", "dd")


def parsed(pages: DataFrame, *extra: Column, clean: str = "_clean", names: tuple[str, ...] | None = STRUCTURE,
           start: Column | None = None) -> DataFrame:
    """The page table cut into pieces and tags, written once: (_row, page_id, url, _pieces, _tags, extra).

    ``names`` are the tags wanted (None: all); ``start`` adds a column ``hit`` to every tag, computed
    from its text in the column ``tag``."""
    def tag_of(tag, i):
        fields = [(i + 1).alias("i"), H.tag_name(tag).alias("name"), tag.startswith("</").alias("ends")]
        return F.struct(*fields, *([start(tag).alias("hit")] if start is not None else []))

    def named(name, i):
        return F.struct((i + 1).alias("i"), F.lower(F.ltrim(name, F.lit("/"))).alias("name"), name.startswith("/").alias("ends"))

    # names come with the tags; a tag's text is only read where a selector or any name is asked for
    whole = start is not None or names is None
    found = F.transform(F.regexp_extract_all(F.col(clean), F.lit(H.TAG_RE), F.lit(0 if whole else 1)), tag_of if whole else named)
    found = F.filter(found, lambda t: t["name"].isin(*names) if names is not None else t["name"] != "")
    return cut_lineage(pages.select(F.monotonically_increasing_id().alias(ROW), "page_id", "url",
                                    H.text_pieces(clean).alias(TEXT), found.alias(TAGS), *extra))


# ---- the windows: by a dense key of each tag, in tag order ------------------------
def _ordered(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(``at`` by key and tag order, where a key begins)."""
    o = at[np.argsort(key[at], kind="stable")]
    k = key[o]
    return o, np.concatenate([[True], k[1:] != k[:-1]]) if len(o) else np.zeros(0, bool)


def _next(key: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For a wanted tag the next wanted one of its key (-1: none, or not wanted)."""
    o, new = _ordered(key, np.flatnonzero(wanted))
    out = np.full(len(key), -1)
    same = ~new[1:]
    out[o[:-1][same]] = o[1:][same]
    return out


def _last(key: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The last wanted tag of the same key up to this one (-1: none)."""
    o, new = _ordered(key, np.arange(len(key)))
    n = np.arange(len(o))
    at = np.maximum.accumulate(np.where(wanted[o], n, -1))
    begin = np.maximum.accumulate(np.where(new, n, 0))
    out = np.empty(len(key), np.int64)
    out[o] = np.where(at >= begin, o[at], -1)
    return out


def _depth(key: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(open elements behind each tag, the depth that a start reached or an end left; 0 for stray ends
    and other tags)."""
    o, new = _ordered(key, np.arange(len(key)))
    step = opens[o].astype(np.int64) - closes[o]
    total = np.cumsum(step)
    group = np.cumsum(new) - 1
    s = total - (total - step)[new][group]
    far = 2 * len(o) + 2  # each key's values lie below those of the key before it, so one running minimum serves all
    low = np.minimum.accumulate(np.minimum(s, 0) - group * far) + group * far
    d = s - low
    before = np.where(new, 0, np.concatenate([[0], d[:-1]]))
    level = np.where(opens[o], d, np.where(closes[o] & (before > 0), d + 1, 0))
    depth, reached = np.empty_like(d), np.empty_like(d)
    depth[o], reached[o] = d, level
    return depth, reached


def _paired(key: np.ndarray, level: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The tag that ends what this start tag opens (-1: none)."""
    return np.where(ends, -1, _next(key * (int(level.max(initial=0)) + 1) + level, level > 0))


@dataclass
class _Tags:
    """The tags of some pages: page (dense), number, name, end tag or not, hit by a selector, pieces of their page."""
    n: int
    page: np.ndarray
    i: np.ndarray
    name: pa.DictionaryArray
    ends: np.ndarray
    hit: np.ndarray
    last: np.ndarray

    def named(self, *names: str) -> np.ndarray:
        """Tags with one of these names."""
        known = self.name.dictionary.to_pylist()
        return np.array([x in names for x in known] or [False])[self.code]

    @property
    def code(self) -> np.ndarray:
        return self.name.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _end(found: np.ndarray, value: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.where(found >= 0, value[found], other)


def _scoped(t: _Tags) -> dict[str, np.ndarray]:
    """Table, row and cell intervals of the tags and their scopes."""
    size = len(t.i)
    row, cell, table = t.named("tr"), t.named(*CELLS), t.named("table")
    depth, level = _depth(t.page, table & ~t.ends, table & t.ends)
    # rows and cells counted up to each tag; those outside of every table are none
    held = ~t.ends & (depth > 0)
    off = np.concatenate([[0], np.cumsum(np.bincount(t.page, minlength=t.n))])
    counts, totals = {}, {}
    for k, what in (("rows", row & held), ("cells", cell & held)):
        c = np.concatenate([[0], np.cumsum(what)])
        counts[k], totals[k] = c[1:] - c[off[:-1]][t.page], (c[off[1:]] - c[off[:-1]])[t.page]
    starts = table & ~t.ends
    e = _paired(t.page, level, t.ends)
    table_end = {"i": _end(e, t.i, t.last), **{k: _end(e, c, totals[k]) for k, c in counts.items()}}
    # the table around a tag: the last one that reached the tag's depth; a start tag belongs to the table it opens
    # (its own boundary), its end tag to the table around it
    around = np.where(depth > 0, _last(t.page * (int(depth.max(initial=0)) + 1) + depth, starts), -1)
    inside = around >= 0
    table_key = np.where(inside, around, size + t.page)
    table_stop = np.where(inside, table_end["i"][around], t.last)
    # rows and cells: up to the next boundary in the same table
    row_edge = inside & (row | t.named(*SECTIONS))
    cell_edge = row_edge | (inside & cell)
    is_row, is_cell = inside & row & ~t.ends, inside & cell & ~t.ends
    e = _next(table_key, row_edge)
    row_end = {"i": _end(e, t.i, table_stop), "cells": _end(e, counts["cells"], table_end["cells"][around])}
    cell_stop = _end(_next(table_key, cell_edge), t.i, table_stop)
    # the scope of any tag: the cell of its table that is open, or the table outside of its cells, or the page
    opened = np.where(inside, _last(table_key, cell_edge), -1)
    in_cell = (opened >= 0) & is_cell[opened]
    return {**counts, "is_table": starts, "table_i": table_end["i"], "table_rows": table_end["rows"],
            "is_row": is_row, "row_i": row_end["i"], "row_cells": row_end["cells"], "is_cell": is_cell, "cell_i": cell_stop,
            "scope": np.where(in_cell, opened, size + table_key), "scope_stop": np.where(in_cell, cell_stop[opened], table_stop)}


def _items(t: _Tags, s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list of each tag or -1, item start or not, where the item stops)."""
    lists = t.named(*LISTS)
    depth, level = _depth(s["scope"], lists & ~t.ends, lists & t.ends)
    stop = _end(_paired(s["scope"], level, t.ends), t.i, s["scope_stop"])
    at = np.where(depth > 0, _last(s["scope"] * (int(depth.max(initial=0)) + 1) + depth, lists & ~t.ends), -1)
    edge = t.named("li") & (at >= 0)
    return at, edge & ~t.ends, _end(_next(at, edge), t.i, stop[at])


INTERVALS = ("struct<cells:array<struct<i:int,cell_stop:int>>,rows:array<struct<i:int,first:int,n:int>>,"
             "tables:array<struct<i:int,first:int,n:int>>,items:array<struct<at:int,i:int,item_stop:int,kind:string>>>")
HITS = "array<struct<i:int,stop:int>>"


def _lists(t: _Tags, chosen: np.ndarray, /, **fields) -> pa.Array:
    """Per page the list of its chosen tags (``chosen``, by page) as structs."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(t.page[chosen], minlength=t.n))])
    cols = [v[chosen] if isinstance(v, np.ndarray) else v.take(pa.array(chosen)) for v in fields.values()]
    cols = [pa.array(c.astype(np.int32)) if isinstance(c, np.ndarray) else c for c in cols]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(cols, list(fields)))


def _structure(t: _Tags) -> pa.Array:
    s = _scoped(t)
    at, is_item, item_stop = _items(t, s)
    items = np.flatnonzero(is_item)
    items = items[np.lexsort((t.i[items], t.i[at[items]], t.page[items]))]
    parts = {"cells": _lists(t, np.flatnonzero(s["is_cell"]), i=t.i, cell_stop=s["cell_i"]),
             "rows": _lists(t, np.flatnonzero(s["is_row"]), i=t.i, first=s["cells"], n=s["row_cells"] - s["cells"]),
             "tables": _lists(t, np.flatnonzero(s["is_table"]), i=t.i, first=s["rows"], n=s["table_rows"] - s["rows"]),
             "items": _lists(t, items, at=t.i[at], i=t.i, item_stop=item_stop, kind=t.name.cast(pa.string()).take(pa.array(np.maximum(at, 0))))}
    return pa.StructArray.from_arrays(list(parts.values()), list(parts))


def _hits(t: _Tags) -> pa.Array:
    s = _scoped(t)
    _, is_item, item_stop = _items(t, s)
    code = t.code
    key = s["scope"] * (int(code.max(initial=0)) + 1) + code
    key = np.unique(key, return_inverse=True)[1]
    _, level = _depth(key, ~t.ends, t.ends)
    stop = _end(_paired(key, level, t.ends), t.i, s["scope_stop"])
    for is_one, end in ((is_item, item_stop), (s["is_cell"], s["cell_i"]), (s["is_row"], s["row_i"]), (s["is_table"], s["table_i"])):
        stop = np.where(is_one, end, stop)
    block = t.named(*BLOCKS)
    stop = np.where(t.named("p"), _end(_next(s["scope"], block), t.i, s["scope_stop"]), stop)
    stop = np.where(t.named(*H.VOID), t.i, stop)
    return _lists(t, np.flatnonzero(t.hit & ~t.ends), i=t.i, stop=stop)


def _by_pages(last: pa.Array, tags: pa.Array, body) -> pa.Array:
    """``body`` over runs of pages with about ``RUN`` tags at most (a page's tags stay together)."""
    lens = pc.fill_null(pc.list_value_length(tags), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens)
    out, a = [], 0
    while a < len(lens) or not out:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + RUN, side="right"))) if len(lens) else 0
        flat = tags.slice(a, b - a).flatten()
        names = flat.field("name") if len(flat) else pa.array([], pa.string())
        size = lens[a:b]
        out.append(body(_Tags(
            b - a, np.repeat(np.arange(b - a), size), flat.field("i").to_numpy(zero_copy_only=False).astype(np.int64),
            names.dictionary_encode(), flat.field("ends").to_numpy(zero_copy_only=False).astype(bool),
            flat.field("hit").to_numpy(zero_copy_only=False).astype(bool) if flat.type.get_field_index("hit") >= 0 else np.zeros(len(flat), bool),
            np.repeat(last.slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64), size))))
        a = b
        if not len(lens):
            break
    return pa.concat_arrays(out)


def _intervals(kind: str) -> Column:
    """Per page: ``cells`` (start, stop) in tag order, ``rows`` (first cell, number of cells) in tag order, ``tables``
    (first row, number of rows) in tag order and ``items`` (list's start tag, start, stop, kind); or, for a selector, the
    intervals of its hits."""
    body, form = (_structure, INTERVALS) if kind == "structure" else (_hits, HITS)

    def run(last: pa.Array, tags: pa.Array) -> pa.Array:
        return _by_pages(last, tags, body)

    return F.arrow_udf(run, form)(F.size(TEXT), F.col(TAGS))


def piece_text(start, stop) -> Column:
    """``get_text(strip=True)`` of the pieces behind tag ``start`` up to tag ``stop``."""
    return F.array_join(F.slice(F.col(TEXT), start + 1, stop - start), "")


def with_structure(parsed_pages: DataFrame) -> DataFrame:
    """``parsed_pages`` with ``tables`` (table -> row -> cell texts; rows and tables without cells
    dropped) and ``lists`` (ul, ol: item texts, empty ones dropped)."""
    p = parsed_pages.withColumn("_s", _intervals("structure")).select("*", "_s.*").drop("_s")
    none = F.array()
    cells = F.coalesce(F.transform("cells", lambda c: piece_text(c["i"], c["cell_stop"])), none.cast("array<string>"))

    def tables_of(rows):
        kept = F.transform("tables", lambda t: F.filter(F.slice(rows, t["first"] + 1, t["n"]), lambda r: F.size(r) > 0))
        return F.filter(kept, lambda t: F.size(t) > 0)

    # named by a lambda each, so that a page's cells are put together once, not for every row and table that holds them
    def rows_of(cells):
        rows = F.transform("rows", lambda r: F.slice(cells, r["first"] + 1, r["n"]))
        return F.transform(F.array(rows), tables_of)[0]

    tables = F.coalesce(F.transform(F.array(cells), rows_of)[0], none.cast("array<array<array<string>>>"))

    def of(kind):
        mine = F.filter("items", lambda x: x["kind"] == kind)
        texts = F.filter(F.transform(mine, lambda x: piece_text(x["i"], x["item_stop"])), lambda s: s != "")
        return F.coalesce(texts, none.cast("array<string>")).alias(kind)

    return p.withColumn("tables", tables).withColumn("lists", F.struct(of("ul"), of("ol"))).drop("cells", "rows", "items")


def selected(pages: DataFrame, selector: str, clean: str = "_clean") -> DataFrame:
    """(page_id, url, selected_text): the texts of all elements that a simple selector
    (``tag``, ``.class``, ``#id`` or a tag with one of them) names, in page order, joined by one space."""
    tag, hit = H.selector_test(selector)
    own = {"li": LISTS, "p": BLOCKS}.get(tag, ()) if tag else BLOCKS
    wanted = None if tag is None else tuple(dict.fromkeys((*STRUCTURE, tag, *own)))
    # a page without a hit needs no tags: they are emptied before they are looked at
    p = parsed(pages, names=wanted, start=hit, clean=clean)
    p = p.withColumn(TAGS, F.when(F.exists(TAGS, lambda x: x["hit"]), F.col(TAGS)).otherwise(F.slice(TAGS, 1, 0)))
    text = F.array_join(F.transform("hits", lambda h: piece_text(h["i"], h["stop"])), " ")
    return p.withColumn("hits", _intervals("hits")).select("page_id", "url", F.coalesce(text, F.lit("")).alias("selected_text"))

"""HTML extraction as Catalyst expressions (X1–X8 building blocks).

The page is never parsed into a tree on the JVM side.  Instead:

1. ``clean``: script/style/template elements, comments and the doctype are
   replaced by an empty marker tag, so they add no text but still break text
   nodes apart;
2. text nodes are the pieces between tags (``split`` on the tag pattern);
3. character references are settled once per page, those that would make markup per piece (after
   the split, so ``&lt;`` makes no tag);
4. element text = stripped pieces, empties dropped, joined by '' (as
   ``get_text(strip=True)``); page text = joined by ' '.

Lists, tables and selectors need to know which tags belong together; they use the
element intervals of ``operators.elements`` over :func:`text_pieces`.

Every pattern is linear in the page: what is repeated is possessive, and an element or
comment that never ends runs to the end of the page instead of being tried again from every start.

Most builders have a ``*_sql`` twin producing DuckDB SQL, used by the oracle queries.
Entities are decoded from the standard library's table here and by a few plain replacements there.
"""

from __future__ import annotations

import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .memo import cached_column
from .sqltext import lit

# ---- fixed values: patterns --------------------------------------------------
def _until(end: str) -> str:
    """Anything up to ``end`` (which begins with '<'), or up to the end of the page."""
    return rf"(?:[^<]++|<(?!{end[1:]}))*+(?:{end}|\z)"


# '<' stands before the alternatives, here and in TAG_RE: text is passed over without trying each of them at every character
SKIP_RE = ("(?is)<(?:" + "|".join(rf"{t}\b[^>]*+(?:>|\z){_until(rf'</{t}[^a-z0-9>]*+>')}" for t in ("script", "style", "template"))
           + r"|!--(?:[^-]++|-(?!->))*+(?:-->|\z)|!doctype[^>]*+(?:>|\z))")
SKIP_RE2 = (r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
            r"|<template\b[^>]*>.*?</template\s*>|<!--.*?-->|<!doctype[^>]*>")
SKIP_MARK = "<x>"
ATTR_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# rest of a start tag, attribute values may hold '>'.  Java form is possessive
# (no per-character recursion or backtracking); the RE2 form (DuckDB oracle)
# matches the same strings, RE2 being linear-time anyway.
TAG_TOKEN = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
TAG_TOKEN_RE2 = r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""

# a whole tag; one with an unclosed quote ends at its first '>', one without any with the page.
# Group 1 is its name, behind the '/' of an end tag (none if there is a quote in it).
_TAG_REST = r"""(?:[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>|[^>]*+(?:>|\z))"""
TAG_RE = rf"""<(?:(/?[A-Za-z][^\s/>"']*+)(?:>|(?!["']){_TAG_REST})|/?[A-Za-z]{_TAG_REST}|[!?][^>]*+(?:>|\z))"""
TAG_RE2 = rf"</?[A-Za-z]{TAG_TOKEN_RE2}|</?[A-Za-z][^>]*(?:>|\z)|<[!?][^>]*(?:>|\z)"
# the attributes before the wanted one, each with its value: a name inside
# another attribute's value is not an attribute
ATTRS_BEFORE = r"""(?is)^<[^\s/>]+(?:[\s/]+[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?[\s/]+"""

# ---- fixed values: entities that the SQL twins replace (``&amp;`` always last) -
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"),
    ("&amp;", "&"),
]

# ---- fixed values: characters ``str.strip()`` removes --------------------------
WS_CHARS = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")
_WS_CLASS = "[" + "".join("\\x{%x}" % ord(c) for c in WS_CHARS) + "]"
STRIP_RE = "^" + _WS_CLASS + "+|" + _WS_CLASS + "+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- text primitives ---------------------------------------------------------
# names of the standard library's table: with ';', and the old ones that count without it (longest first)
_SEP = "\x01"
_WITH_END = sorted(n for n in html5 if n.endswith(";"))
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: what a numeric reference to a code from 128 to 159 means: the Windows code page
_C1 = bytes(range(128, 160)).decode("cp1252", "replace")


#: references that stay written, in this form, until the markup is read: what they stand for would be taken for it
_KEPT = {"<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&apos;", " ": "&#32;", "\t": "&#9;", "\n": "&#10;", "\f": "&#12;", "\r": "&#13;"}


def _written(text: str) -> str:
    text = text.replace("&", "&amp;")
    for char, name in _KEPT.items():
        text = text.replace(char, name)
    return text


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _reference_sql() -> str:
    """Lambda over the parts of a text cut at its '&': the reference at a part's start settled.
    One SQL text, as a Column built call by call would take longer than the query."""
    names = (f"map_from_arrays(split('{_SEP.join(_WITH_END)}', '{_SEP}'),"
             f" split({_quoted(_SEP.join(_written(html5[n]) for n in _WITH_END))}, '{_SEP}'))")
    c1 = "array(" + ", ".join(_quoted(c if c != "\ufffd" else chr(128 + i)) for i, c in enumerate(_C1)) + ")"
    dec, hexa = "regexp_extract(p, r'^#0*+([0-9]++)', 1)", "regexp_extract(p, r'^#[xX]0*+([0-9a-fA-F]++)', 1)"
    code = (f"CASE WHEN length({dec}) > 7 OR length({hexa}) > 6 THEN 1073741824L WHEN {dec} <> '' THEN cast({dec} AS BIGINT)"
            f" WHEN {hexa} <> '' THEN cast(conv({hexa}, 16, 10) AS BIGINT) ELSE 0L END")
    kept = " ".join(f"WHEN c = {ord(char)} THEN '{name}'" for char, name in {**_KEPT, "&": "&amp;"}.items())
    char = (f"CASE WHEN c = 0 OR c BETWEEN 55296 AND 57343 OR c > 1114111 THEN '\ufffd' {kept}"
            f" WHEN c BETWEEN 128 AND 159 THEN try_element_at({c1}, cast(c - 127 AS INT))"
            " WHEN c < 32 OR c = 127 OR c BETWEEN 64976 AND 65007 OR c % 65536 >= 65534 THEN ''"
            " ELSE decode(unhex(lpad(hex(c), 8, '0')), 'UTF-32') END")
    full = "regexp_extract(p, r'^([A-Za-z][A-Za-z0-9]{1,30};)', 1)"
    bare = f"regexp_extract(p, r'^({'|'.join(_BARE)})', 1)"
    # the longest name: with its ';', or one of the old names that count without it
    named = (f"transform(array(transform(array({full}, concat({bare}, ';')), k -> try_element_at({names}, k))), v ->"
             f" CASE WHEN v[0] IS NOT NULL THEN concat(v[0], substring(p, length({full}) + 1))"
             f" WHEN v[1] IS NOT NULL THEN concat(v[1], substring(p, length({bare}) + 1)) ELSE concat('&amp;', p) END)[0]")
    return (r"(p, i) -> CASE WHEN i = 0 THEN p WHEN p RLIKE r'^(?:amp|lt|gt|quot);' THEN concat('&', p)"
            f" WHEN p RLIKE r'^#(?:[0-9]|[xX][0-9a-fA-F])' THEN concat(transform(array({code}), c -> {char})[0],"
            f" regexp_replace(p, r'^#(?:[xX][0-9a-fA-F]++|[0-9]++);?', '')) ELSE {named} END")


@cached_column
def _reference() -> Column:
    return F.expr(_reference_sql())


def settle_references(x) -> Column:
    """Every character reference replaced by its character, as ``html.unescape`` reads it (longest name of the
    standard library's table, code points), except that characters with a meaning in markup stay
    references in one fixed form; a lone '&' becomes ``&amp;``.  Done once per page; ``x`` is named once, as Spark
    makes it anew at each place that names it."""
    return F.array_join(F.call_function("transform", F.split(_c(x), "&", -1), _reference()), "")


def decode_entities(x) -> Column:
    """The few references that :func:`settle_references` leaves; ``&amp;`` last, so each is decoded once."""
    src = _c(x)
    y = src
    for char, name in _KEPT.items():
        y = F.replace(y, F.lit(name), F.lit(char))
    y = F.replace(y, F.lit("&amp;"), F.lit("&"))
    # most text pieces hold no '&'
    return F.when(F.instr(src, "&") > 0, y).otherwise(src)


def decode_entities_sql(x: str) -> str:
    for ent, ch in ENTITIES:
        x = f"replace({x}, {lit(ent)}, {lit(ch)})"
    return x


def strip(x) -> Column:
    """``str.strip()``: a character-set trim (no regex) over the whitespace set."""
    return F.btrim(_c(x), F.lit(WS_CHARS))


def strip_sql(x: str) -> str:
    return f"trim({x}, {lit(WS_CHARS)})"


@cached_column
def clean(html) -> Column:
    """Blank out non-text elements, keep a node break in their place; character references settled."""
    return settle_references(F.regexp_replace(_c(html), SKIP_RE, SKIP_MARK))


def clean_sql(html: str) -> str:
    return f"regexp_replace({html}, {lit(SKIP_RE2)}, {lit(SKIP_MARK)}, 'g')"


def text_pieces(cleaned) -> Column:
    """The decoded, stripped text in front of, between and behind the tags ('' where there is none)."""
    return F.transform(F.split(_c(cleaned), TAG_RE, -1), lambda p: strip(decode_entities(p)))


def tag_name(tag) -> Column:
    """Lower-cased name of a start or end tag ('' for other markup)."""
    return F.lower(F.regexp_extract(_c(tag), "^</?([A-Za-z][^\\s/>]*)", 1))


def text_nodes(fragment) -> Column:
    """Array of stripped, decoded, non-empty text nodes of a cleaned fragment."""
    parts = F.split(_c(fragment), TAG_RE, -1)
    return F.filter(F.transform(parts, lambda p: strip(decode_entities(p))), lambda p: p != "")


def text_nodes_sql(fragment: str) -> str:
    return (f"list_filter(list_transform(string_split_regex({fragment}, {lit(TAG_RE2)}), "
            f"lambda p: {strip_sql(decode_entities_sql('p'))}), lambda p: p <> '')")


@cached_column
def page_text(cleaned) -> Column:
    """``get_text(separator=' ', strip=True)`` of the whole page."""
    return F.array_join(text_nodes(cleaned), " ")


def page_text_sql(cleaned: str) -> str:
    return f"array_to_string({text_nodes_sql(cleaned)}, ' ')"


@cached_column
def elem_text(fragment) -> Column:
    """``get_text(strip=True)``: no separator between nodes."""
    return F.array_join(text_nodes(fragment), "")


def elem_text_sql(fragment: str) -> str:
    return f"array_to_string({text_nodes_sql(fragment)}, '')"


# ---- element patterns ----------------------------------------------------------
def element_re(tag: str, re2: bool = False) -> str:
    """Inner content of every ``<tag>…</tag>`` (not nested in itself); group 1.  Without an end tag it
    runs to the end of the page."""
    end = rf"</{re.escape(tag)}\s*>"
    if re2:
        return rf"{tag_re(tag, re2)}(.*?)(?:{end}|\z)"
    return rf"{tag_re(tag)}((?:[^<]++|<(?!{end[1:]}))*+)(?:{end}|\z)"


def tag_re(tag: str, re2: bool = False) -> str:
    """Every start tag ``<tag …>`` whole (attribute values may hold '>')."""
    return rf"(?is)<{re.escape(tag)}\b{TAG_TOKEN_RE2 if re2 else TAG_TOKEN}"


def attr_re(name: str) -> str:
    return rf"{ATTRS_BEFORE}{re.escape(name)}{ATTR_VALUE}"


def attr(tag_text, name: str) -> Column:
    """Decoded value of attribute ``name`` in a start-tag string ('' if absent)."""
    r = attr_re(name)
    t = _c(tag_text)
    return decode_entities(F.concat(F.regexp_extract(t, r, 1), F.regexp_extract(t, r, 2),
                                    F.regexp_extract(t, r, 3)))


def attr_sql(tag_text: str, name: str) -> str:
    r = lit(attr_re(name))
    return decode_entities_sql(f"(regexp_extract({tag_text}, {r}, 1) || regexp_extract({tag_text}, {r}, 2)"
                               f" || regexp_extract({tag_text}, {r}, 3))")


def has_attr(tag_text, name: str) -> Column:
    return _c(tag_text).rlike(attr_re(name))


def has_attr_sql(tag_text: str, name: str) -> str:
    return f"regexp_matches({tag_text}, {lit(attr_re(name))})"


def inner_all(cleaned, tag: str) -> Column:
    return F.regexp_extract_all(_c(cleaned), F.lit(element_re(tag)), 1)


def inner_all_sql(cleaned: str, tag: str) -> str:
    return f"regexp_extract_all({cleaned}, {lit(element_re(tag, re2=True))}, 1)"


def tags_all(cleaned, tag: str) -> Column:
    return F.regexp_extract_all(_c(cleaned), F.lit(tag_re(tag)), 0)


def tags_all_sql(cleaned: str, tag: str) -> str:
    return f"regexp_extract_all({cleaned}, {lit(tag_re(tag, re2=True))}, 0)"


# ---- X1 ------------------------------------------------------------------------
TITLE_RE = element_re("title")


@cached_column
def title(cleaned) -> Column:
    """Text of the first ``<title>``."""
    return elem_text(F.regexp_extract(_c(cleaned), TITLE_RE, 1))


def title_sql(cleaned: str) -> str:
    return elem_text_sql(f"regexp_extract({cleaned}, {lit(element_re('title', re2=True))}, 1)")


@cached_column
def meta_content(cleaned, name: str) -> Column:
    """``content`` of the last ``<meta name=…>`` whose name equals ``name`` (case-sensitive)."""
    metas = F.filter(tags_all(cleaned, "meta"), lambda m: has_attr(m, "name") & (attr(m, "name") == name))
    return F.coalesce(attr(F.try_element_at(metas, F.lit(-1)), "content"), F.lit(""))


def meta_content_sql(cleaned: str, name: str) -> str:
    metas = f"list_filter({tags_all_sql(cleaned, 'meta')}, lambda m: {attr_sql('m', 'name')} = {lit(name)})"
    return f"coalesce({attr_sql(f'({metas})[-1]', 'content')}, '')"


# ---- X5 ------------------------------------------------------------------------
@cached_column
def images(cleaned) -> Column:
    """``ARRAY<STRUCT<src, alt>>``: src verbatim (not resolved), empty src dropped."""
    imgs = F.transform(tags_all(cleaned, "img"),
                       lambda t: F.struct(attr(t, "src").alias("src"), attr(t, "alt").alias("alt")))
    return F.filter(imgs, lambda s: s["src"] != "")


# ---- X6 ------------------------------------------------------------------------
@cached_column
def headings(cleaned, level: int) -> Column:
    return F.filter(F.transform(inner_all(cleaned, f"h{level}"), elem_text), lambda s: s != "")


def headings_sql(cleaned: str, level: int) -> str:
    return (f"list_filter(list_transform({inner_all_sql(cleaned, f'h{level}')}, "
            f"lambda s: {elem_text_sql('s')}), lambda s: s <> '')")


@cached_column
def headings_struct(cleaned) -> Column:
    return F.struct(*(headings(cleaned, n).alias(f"h{n}") for n in (1, 2, 3)))


# ---- X8 ------------------------------------------------------------------------
LI_START, LI_START_RE2 = tag_re("li"), tag_re("li", re2=True)
LI_END = r"(?i)</li\s*>"


def list_items_sql(cleaned: str, kind: str) -> str:
    items = (f"list_transform(string_split_regex(b, {lit(LI_START_RE2)})[2:], "
             f"lambda c: {elem_text_sql(f'string_split_regex(c, {lit(LI_END)})[1]')})")
    return (f"list_filter(flatten(list_transform({inner_all_sql(cleaned, kind)}, lambda b: {items})), "
            f"lambda s: s <> '')")


# ---- X7 ------------------------------------------------------------------------
TR_START, TR_START_RE2 = tag_re("tr"), tag_re("tr", re2=True)
TR_END = r"(?i)</tr\s*>"
CELL_START, CELL_START_RE2 = (rf"(?is)<t[dh]\b{t}" for t in (TAG_TOKEN, TAG_TOKEN_RE2))
CELL_END = r"(?i)</t[dh]\s*>"


# ---- X3 ------------------------------------------------------------------------
SELECTOR_RE = re.compile(r"^([A-Za-z][A-Za-z0-9]*)?(?:([.#])([A-Za-z0-9_-]+))?$")


# fixed values: elements without content
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def _selector(selector: str) -> tuple[str | None, str | None, str | None]:
    """(tag, '.' or '#', name) of ``tag``, ``tag.class``, ``tag#id``, ``.class`` or ``#id``.  Combinators, attribute
    selectors and pseudo-classes are rejected."""
    m = SELECTOR_RE.match(selector.strip())
    if not m or not (m.group(1) or m.group(2)):
        raise ValueError(f"only simple selectors are supported, got {selector!r}")
    return m.group(1) and m.group(1).lower(), m.group(2), m.group(3)


def selector_test(selector: str):
    """(tag name or None, test of a tag's text): is it a start tag that the selector names?"""
    tag, kind, name = _selector(selector)

    def test(t) -> Column:
        ok = t.rlike("^<[A-Za-z]")
        if tag:
            ok = ok & (tag_name(t) == tag)
        if kind == ".":
            ok = ok & F.array_contains(F.split(attr(t, "class"), r"[ \t\n\r\f]+"), name)
        elif kind == "#":
            ok = ok & (attr(t, "id") == name)
        return ok

    return tag, test


def selector_text_sql(cleaned_cte: str, selector: str) -> str:
    """SELECT (page_id, url, selected_text) from a CTE (page_id, url, c): each hit's end is the tag where its own name's
    starts and ends balance, found by counting from the hit on."""
    tag, kind, name = _selector(selector)
    ok = "regexp_matches(tag, '^<[A-Za-z]')"
    if tag:
        ok += f" AND name = {lit(tag)}"
    if kind == ".":
        ok += f" AND list_contains(string_split_regex({attr_sql('tag', 'class')}, '[ \t\n\r\f]+'), {lit(name)})"
    elif kind == "#":
        ok += f" AND {attr_sql('tag', 'id')} = {lit(name)}"
    return f"""sp AS (SELECT page_id, url, regexp_extract_all(c, {lit(TAG_RE2)}) AS tags,
       list_transform(string_split_regex(c, {lit(TAG_RE2)}), lambda p: {strip_sql(decode_entities_sql('p'))}) AS pieces FROM {cleaned_cte}),
tg AS (SELECT page_id, len(tags) AS n, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i FROM sp),
nm AS (SELECT *, lower(regexp_extract(tag, '^</?([A-Za-z][^\\s/>]*)', 1)) AS name FROM tg),
hit AS (SELECT * FROM nm WHERE {ok}),
bal AS (SELECT h.page_id, h.i, t.i AS j, sum(CASE WHEN starts_with(t.tag, '</') THEN -1 ELSE 1 END)
               OVER (PARTITION BY h.page_id, h.i ORDER BY t.i) AS open
        FROM hit h JOIN nm t ON t.page_id = h.page_id AND t.name = h.name AND t.i >= h.i),
fin AS (SELECT hit.page_id, hit.i, coalesce(min(j) FILTER (WHERE open = 0), any_value(hit.n) + 1) AS j
        FROM hit LEFT JOIN bal USING (page_id, i) GROUP BY 1, 2)
SELECT sp.page_id, sp.url, coalesce(string_agg(CASE WHEN fin.i IS NOT NULL THEN array_to_string(list_filter(pieces[fin.i + 1:fin.j],
       lambda p: p <> ''), '') END, ' ' ORDER BY fin.i), '') AS selected_text
FROM sp LEFT JOIN fin USING (page_id) GROUP BY sp.page_id, sp.url"""


# ---- X4 --------------------------------------------------------------------------
@cached_column
def hrefs(cleaned) -> Column:
    """Decoded ``href`` values of ``<a>`` tags that carry one, in document order."""
    a = F.filter(tags_all(cleaned, "a"), lambda t: has_attr(t, "href"))
    return F.transform(a, lambda t: attr(t, "href"))


def hrefs_sql(cleaned: str) -> str:
    return (f"list_transform(list_filter({tags_all_sql(cleaned, 'a')}, lambda t: {has_attr_sql('t', 'href')}), "
            f"lambda t: {attr_sql('t', 'href')})")

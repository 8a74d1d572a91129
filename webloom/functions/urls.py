"""URL column functions.

All are Catalyst expressions (no Python worker).  Each has a ``*_sql`` twin
that renders the same logic as DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqltext import lit

# Fixed patterns (shared by Spark and the DuckDB oracle; RE2-safe).
SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.-]*:"
NETLOC_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
VALID_RE = r"^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]"
LEADING_JUNK_RE = r"^[\x00-\x20]+"
UNSAFE_RE = r"[\t\r\n]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# U1 -------------------------------------------------------------------------
def netloc(url) -> Column:
    """``urlparse(url).netloc``: host with case, port, userinfo and ``www.`` kept."""
    return F.regexp_extract(_c(url), NETLOC_RE, 1)


def netloc_sql(url: str) -> str:
    return f"regexp_extract({url}, {lit(NETLOC_RE)}, 1)"


# U2 -------------------------------------------------------------------------
def norm_domain(url) -> Column:
    """Lower-cased netloc with a leading ``www.`` cut (used for page scope)."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def norm_domain_sql(url: str) -> str:
    return f"regexp_replace(lower({netloc_sql(url)}), {lit(r'^www\.')}, '')"


# U3 -------------------------------------------------------------------------
def is_valid_url(url) -> Column:
    """http/https scheme (any case) and a non-empty netloc."""
    return _c(url).rlike(VALID_RE)


def is_valid_url_sql(url: str) -> str:
    return f"regexp_matches({url}, {lit(VALID_RE)})"


# U5 -------------------------------------------------------------------------
def strip_fragment(url) -> Column:
    return F.substring_index(_c(url), "#", 1)


def strip_fragment_sql(url: str) -> str:
    return f"split_part({url}, '#', 1)"


# U4 -------------------------------------------------------------------------
def _clean_ref(x: Column) -> Column:
    # urlsplit drops leading C0/space characters and tab/CR/LF anywhere
    return F.regexp_replace(F.regexp_replace(x, LEADING_JUNK_RE, ""), UNSAFE_RE, "")


DOT_SEGMENT_RE = r"(^|/)\.\.?(/|$)"


def base_parts(base) -> dict[str, Column]:
    """Parts of the base URL; compute once per page and pass to ``resolve``.

    ``dir`` is the base directory as a segment list with the empty middle
    segments already dropped (``urljoin`` drops them when merging)."""
    b = strip_fragment(_clean_ref(_c(base)))
    path = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    # directory = path up to and including its last '/'; then [''] + its non-empty segments
    dir_str = F.regexp_extract(path, r"^(.*/)", 1)
    dir_segs = F.concat(F.array(F.lit("")), F.filter(F.split(dir_str, "/", -1), lambda x: x != ""))
    return {
        "b": b,
        "scheme": F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1),
        "origin": F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1),
        "dir": dir_segs,
        "noquery": F.substring_index(b, "?", 1),
    }


def clean_ref(href) -> Column:
    """Reference as urlsplit sees it, fragment cut."""
    return strip_fragment(_clean_ref(_c(href)))


def normalize_ref(h, base_scheme) -> Column:
    """Two ``urljoin`` rules before resolution: a reference with the base's own
    scheme and no host (``http:?q``, ``http:../x``) is relative; ``//`` followed
    by an empty host (``//``, ``///x``) drops the empty authority."""
    h = _c(h)
    m = F.regexp_extract(h, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    rest = F.substring(h, F.length(m) + 2, 1 << 30)
    same_scheme = (m != "") & (F.lower(m) == F.lower(base_scheme))
    with_host = rest.rlike(r"^//[^/?#]")
    # same scheme with a host: as urlunparse writes it (scheme lower-cased, empty query dropped)
    hosted = F.concat(F.lower(m), F.lit(":"),
                      F.when(F.instr(rest, "?") == F.length(rest), F.substring(rest, 1, F.length(rest) - 1))
                      .otherwise(rest))
    # same scheme without a host: a relative reference (kept a path if it looks like a scheme)
    relative = F.when(rest.rlike(SCHEME_RE), F.concat(F.lit("./"), rest)).otherwise(rest)
    h1 = F.when(same_scheme & with_host, hosted).when(same_scheme, relative).otherwise(h)
    return F.when(h1.rlike(r"^//([/?#]|$)"), F.substring(h1, 3, 1 << 30)).otherwise(h1)


def split_ref(h) -> Column:
    """STRUCT<h, hp (path), hq (query or null), segs> of a cleaned reference."""
    h = _c(h)
    hp = F.substring_index(h, "?", 1)
    return F.struct(h.alias("h"), hp.alias("hp"),
                    F.when(F.instr(h, "?") > 0, F.substring(h, F.instr(h, "?") + 1, 1 << 30)).alias("hq"),
                    F.split(hp, "/", -1).alias("segs"))


def _remove_dots(segs: Column) -> Column:
    """``urljoin``'s dot-segment removal; a trailing '.' or '..' leaves a final ''."""
    init = F.struct(F.array().cast("array<string>").alias("l"), F.lit(False).alias("dot"))

    def step(acc, s):
        lst = acc["l"]
        nxt = (F.when(s == "..", F.when(F.size(lst) > 0, F.slice(lst, 1, F.size(lst) - 1)).otherwise(lst))
               .when(s == ".", lst).otherwise(F.concat(lst, F.array(s))))
        return F.struct(nxt.alias("l"), s.isin(".", "..").alias("dot"))

    return F.aggregate(segs, init, step,
                       lambda acc: F.when(acc["dot"], F.concat(acc["l"], F.array(F.lit("")))).otherwise(acc["l"]))


def resolve(parts: dict, ref: Column) -> Column:
    """Resolution core over a ``split_ref`` struct.  Every part is referenced
    once (no subtree copies), so the expression stays small inside lambdas."""
    h, hp, hq, hs = ref["h"], ref["hp"], ref["hq"], ref["segs"]
    query_part = F.when(F.coalesce(hq, F.lit("")) != "", F.concat(F.lit("?"), hq)).otherwise(F.lit(""))
    merged = F.concat(parts["dir"], F.filter(F.slice(hs, 1, F.size(hs) - 1), lambda x: x != ""),
                      F.slice(hs, -1, 1))
    segs = F.when(hp.startswith("/"), hs).otherwise(merged)
    path = F.concat(F.lit("/"), F.regexp_replace(F.array_join(_remove_dots(segs), "/"), "^/", ""))
    return (F.when(h.rlike(SCHEME_RE), h)
            .when(h.rlike(r"^//[^/?#]"), F.concat(parts["scheme"], F.lit(":"), h))
            .when((hp == "") & (F.coalesce(hq, F.lit("")) == ""), parts["b"])
            .when(hp == "", F.concat(parts["noquery"], F.lit("?"), hq))
            # fast path: an absolute path without dot segments is kept as written
            .when(hp.startswith("/") & ~hp.rlike(DOT_SEGMENT_RE), F.concat(parts["origin"], hp, query_part))
            .otherwise(F.concat(parts["origin"], path, query_part)))


def urljoin(base, href, parts: dict | None = None) -> Column:
    """RFC-3986-style resolution with the rules of Python's ``urljoin``.

    Cases: scheme present -> verbatim; ``//host`` -> base scheme; empty path
    (only ``?query``) -> base path with the new query; ``/path`` -> base
    origin + path; otherwise merge with the base directory (empty middle
    segments dropped) and remove dot segments.  The fragment of ``href`` is
    dropped up front (callers cut fragments anyway).  ``parts`` may hold the
    base's parts precomputed as columns (see ``base_parts``).
    """
    p = parts or base_parts(base)
    return resolve(p, split_ref(normalize_ref(clean_ref(href), p["scheme"])))


def urljoin_sql(base: str, href: str) -> str:
    b = f"split_part(regexp_replace(regexp_replace({base}, {lit(LEADING_JUNK_RE)}, ''), {lit(UNSAFE_RE)}, '', 'g'), '#', 1)"
    h = f"split_part(regexp_replace(regexp_replace({href}, {lit(LEADING_JUNK_RE)}, ''), {lit(UNSAFE_RE)}, '', 'g'), '#', 1)"
    # DuckDB: build in a correlated subquery so every part is computed once
    return f"""(SELECT CASE
        WHEN regexp_matches(h, {lit(SCHEME_RE)}) THEN h
        WHEN regexp_matches(h, '^//[^/?#]') THEN regexp_extract(b, {lit(r'^([A-Za-z][A-Za-z0-9+.-]*):')}, 1) || ':' || h
        WHEN hp = '' AND coalesce(hq, '') = '' THEN b
        WHEN hp = '' THEN split_part(b, '?', 1) || '?' || hq
        ELSE regexp_extract(b, {lit(r'^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)')}, 1)
             || (SELECT CASE WHEN starts_with(p2, '/') THEN p2 ELSE '/' || p2 END
                 FROM (SELECT CASE WHEN p1 = '' THEN '/' ELSE p1 END AS p2
                       FROM (SELECT array_to_string(
                                 CASE WHEN segs[-1] IN ('.', '..') THEN list_append(res, '') ELSE res END, '/') AS p1
                             FROM (SELECT segs, list_reduce(segs,
                                      lambda acc, s: CASE WHEN s = '..' THEN acc[1:len(acc) - 1]
                                                          WHEN s = '.' THEN acc
                                                          ELSE list_append(acc, s) END,
                                      []::VARCHAR[]) AS res
                                   FROM (SELECT CASE WHEN starts_with(hp, '/') THEN string_split(hp, '/')
                                                     ELSE list_filter(mg, lambda x, i: i = 1 OR i = len(mg) OR x <> '')
                                                END AS segs
                                         FROM (SELECT list_concat(
                                                   CASE WHEN bp[-1] <> '' THEN bp[1:len(bp) - 1] ELSE bp END,
                                                   string_split(hp, '/')) AS mg
                                               FROM (SELECT string_split(regexp_extract(b,
                                                        {lit(r'^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)')}, 1), '/') AS bp)))))))
             || CASE WHEN coalesce(hq, '') <> '' THEN '?' || hq ELSE '' END
      END
      FROM (SELECT b, h, split_part(h, '?', 1) AS hp,
                   CASE WHEN strpos(h, '?') > 0 THEN substr(h, strpos(h, '?') + 1) END AS hq
            FROM (SELECT b, CASE WHEN regexp_matches(h1, '^//([/?#]|$)') THEN substr(h1, 3) ELSE h1 END AS h
                  FROM (SELECT b, CASE WHEN m <> '' AND lower(m) = lower(regexp_extract(b, {lit(r'^([A-Za-z][A-Za-z0-9+.-]*):')}, 1))
                                       THEN CASE WHEN regexp_matches(substr(h0, length(m) + 2), '^//[^/?#]')
                                                 THEN lower(m) || ':' || CASE WHEN strpos(substr(h0, length(m) + 2), '?') = length(substr(h0, length(m) + 2))
                                                                              THEN substr(h0, length(m) + 2, length(substr(h0, length(m) + 2)) - 1)
                                                                              ELSE substr(h0, length(m) + 2) END
                                                 WHEN regexp_matches(substr(h0, length(m) + 2), {lit(SCHEME_RE)})
                                                 THEN './' || substr(h0, length(m) + 2)
                                                 ELSE substr(h0, length(m) + 2) END
                                       ELSE h0 END AS h1
                        FROM (SELECT b, h0, regexp_extract(h0, {lit(r'^([A-Za-z][A-Za-z0-9+.-]*):')}, 1) AS m
                              FROM (SELECT {b} AS b, {h} AS h0))))))"""

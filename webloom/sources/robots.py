"""S5 robots ingest: robots text per domain -> groups, rules and crawl delay.

Parsing follows the standard-library robots parser:

* lines are split like ``str.splitlines``; a raw empty line ends a group;
* ``#`` starts a comment; ``name: value`` with the name lower-cased and the
  value stripped;
* a ``User-agent`` line opens a new group unless the previous significant
  line was also a ``User-agent`` line;
* ``Allow``/``Disallow`` lines count only inside a group (after a
  ``User-agent`` with no blank line between); an empty ``Disallow`` allows;
* a group enters the file only if it has at least one rule; the first group
  naming ``*`` is the default (checked last), later ``*`` groups are ignored.

Per-domain windows run over the lines of one robots file (bounded size).
The crawl delay follows the crawler's own scan: first ``crawl-delay:`` line
anywhere with a positive number, default 1.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.html import strip

# fixed values: line breaks of ``str.splitlines``
LINE_SPLIT_RE = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
DEFAULT_CRAWL_DELAY = 1.0


def percent_decoded(c):
    """Percent escapes decoded as UTF-8, malformed ones kept; ``+`` stays."""
    safe = F.regexp_replace(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.when(F.instr(c, "%") > 0, F.coalesce(F.try_url_decode(safe), c)).otherwise(c)


def robots_lines(robots: DataFrame) -> DataFrame:
    x = robots.select("domain", F.posexplode(F.split("content", LINE_SPLIT_RE, -1)).alias("line_no", "raw"))
    body = strip(F.substring_index(F.col("raw"), "#", 1))
    has_colon = F.instr(body, ":") > 0
    key = F.lower(strip(F.substring_index(body, ":", 1)))
    value = strip(F.substring(body, F.instr(body, ":") + 1, 1 << 30))
    kind = (F.when(F.col("raw") == "", "B")
            .when(has_colon & (key == "user-agent"), "U")
            .when(has_colon & key.isin("allow", "disallow"), "R")
            .otherwise("O"))
    return x.select("domain", "line_no", "raw", kind.alias("kind"), key.alias("key"), value.alias("value"))


def robots_groups_and_rules(robots: DataFrame):
    """(groups: domain, group_no, agents, is_default; rules: domain, group_no, rule_no, allow, path)."""
    ln = robots_lines(robots)
    w = W.partitionBy("domain").orderBy("line_no")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    prev_sig = F.last(F.when(F.col("kind") != "O", F.col("kind")), ignorenulls=True).over(before)
    prev_bu = F.last(F.when(F.col("kind").isin("B", "U"), F.col("kind")), ignorenulls=True).over(before)
    ln = ln.withColumn("_new", ((F.col("kind") == "U") & F.coalesce(prev_sig != "U", F.lit(True))).cast("int"))
    ln = ln.withColumn("_accepted", (F.col("kind") == "R") & F.coalesce(prev_bu == "U", F.lit(False)))
    ln = ln.withColumn("group_no", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    rules = ln.filter("_accepted").select(
        "domain", "group_no", F.col("line_no").alias("rule_no"),
        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"), percent_decoded(F.col("value")).alias("path"))
    agents = (ln.filter(F.col("kind") == "U").groupBy("domain", "group_no")
              .agg(F.sort_array(F.collect_list(F.struct("line_no", "value"))).alias("_a")))
    agents = agents.select("domain", "group_no", F.transform("_a", lambda s: s["value"]).alias("agents"))
    with_rules = agents.join(rules.select("domain", "group_no").distinct(), ["domain", "group_no"], "left_semi")
    star = F.array_contains("agents", "*")
    first_star = F.min(F.when(star, F.col("group_no"))).over(W.partitionBy("domain"))
    groups = with_rules.select("domain", "group_no", "agents", star.alias("_star"),
                               (star & (F.col("group_no") == first_star)).alias("is_default"))
    groups = groups.filter(~F.col("_star") | F.col("is_default")).drop("_star")
    rules = rules.join(groups.select("domain", "group_no"), ["domain", "group_no"], "left_semi")
    return groups, rules


def crawl_delays(robots: DataFrame) -> DataFrame:
    """J8 input: first positive ``crawl-delay:`` per domain (any group)."""
    x = robots.select("domain", F.posexplode(F.split("content", LINE_SPLIT_RE, -1)).alias("line_no", "raw"))
    s = strip(F.col("raw"))
    x = x.withColumn("_s", s).filter(F.lower(F.col("_s")).startswith("crawl-delay:"))
    x = x.withColumn("_v", strip(F.substring(F.col("_s"), 13, 1 << 30)).try_cast("double")).filter(F.col("_v") > 0)
    return x.groupBy("domain").agg(F.min_by("_v", "line_no").alias("crawl_delay"))


# ---- fixture: robots text per host, derived from the data by a fixed rule -------
ROBOTS_RULE_SQL_TEMPLATE = """SELECT domain,
  'User-agent: webloombot' || chr(10) || 'Disallow: /' || chr(10) || chr(10) ||
  CASE length(domain) % 3
    WHEN 0 THEN 'User-agent: *' || chr(10) || 'Disallow: /en/' || chr(10) || 'Allow: /en/1' || chr(10) || 'Crawl-delay: 2.5'
    WHEN 1 THEN 'User-agent: *' || chr(10) || 'Disallow:' || chr(10) || 'Crawl-delay: abc' || chr(10) || 'crawl-delay: 0.5'
    ELSE 'User-agent: Crawler' || chr(10) || 'User-agent: other' || chr(10) || 'Disallow: /de/ # old' || chr(10) ||
         'Allow: /' || chr(10) || chr(10) || '# default' || chr(10) || 'User-agent: *' || chr(10) || 'Disallow: /fr/'
  END || chr(10) AS content
FROM ({hosts})"""


def robots_fixture(hosts: DataFrame) -> DataFrame:
    """One robots file per distinct host (column ``domain``)."""
    nl = F.lit("\n")
    case = (F.when(F.length("domain") % 3 == 0,
                   F.concat(F.lit("User-agent: *"), nl, F.lit("Disallow: /en/"), nl, F.lit("Allow: /en/1"), nl,
                            F.lit("Crawl-delay: 2.5")))
            .when(F.length("domain") % 3 == 1,
                  F.concat(F.lit("User-agent: *"), nl, F.lit("Disallow:"), nl, F.lit("Crawl-delay: abc"), nl,
                           F.lit("crawl-delay: 0.5")))
            .otherwise(F.concat(F.lit("User-agent: Crawler"), nl, F.lit("User-agent: other"), nl,
                                F.lit("Disallow: /de/ # old"), nl, F.lit("Allow: /"), nl, nl, F.lit("# default"), nl,
                                F.lit("User-agent: *"), nl, F.lit("Disallow: /fr/"))))
    content = F.concat(F.lit("User-agent: webloombot"), nl, F.lit("Disallow: /"), nl, nl, case, nl)
    return hosts.select("domain", content.alias("content"))


def robots_fixture_sql(hosts_sql: str) -> str:
    return ROBOTS_RULE_SQL_TEMPLATE.format(hosts=hosts_sql)


__all__ = ["robots_lines", "robots_groups_and_rules", "crawl_delays", "robots_fixture", "robots_fixture_sql",
           "LINE_SPLIT_RE", "DEFAULT_CRAWL_DELAY"]

"""J6 robots allow/deny, J7 blocked count, J8 crawl delay per domain.

For a user agent, each domain's governing group is the first non-default
group with an agent that is a (case-insensitive) substring of the agent's
product token, else the default ``*`` group, else none (allow).  Inside the
group the first rule, in file order, whose path is a prefix of the URL's
path+query (or is ``*``) decides; no match allows.

The URL rows join the files' rule arrays on the host; AQE broadcasts the file
side when it measures small, and splits a hot host otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import netloc
from ..sources.robots import DEFAULT_CRAWL_DELAY, crawl_delays, percent_decoded, robots_groups_and_rules

PATH_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$"


def url_path_key(url) -> F.Column:
    """Path and query of a URL, percent-decoded, as the rules' paths are."""
    rest = F.regexp_extract(url if not isinstance(url, str) else F.col(url), PATH_RE, 1)
    return F.when(rest == "", F.lit("/")).otherwise(percent_decoded(rest))


def governing_rules(robots: DataFrame, user_agent: str = "*") -> DataFrame:
    """Rules of the group that governs ``user_agent`` on each domain."""
    groups, rules = robots_groups_and_rules(robots)
    token = user_agent.split("/")[0].lower()
    applies = F.exists("agents", lambda a: F.instr(F.lit(token), F.lower(a)) > 0)
    chosen = groups.groupBy("domain").agg(
        F.coalesce(F.min(F.when(~F.col("is_default") & applies, F.col("group_no"))),
                   F.min(F.when(F.col("is_default"), F.col("group_no")))).alias("group_no"))
    return rules.join(chosen, ["domain", "group_no"], "left_semi")


def allow_urls(urls: DataFrame, robots: DataFrame, user_agent: str = "*", url_col: str = "url") -> DataFrame:
    """``allowed`` per URL row.  Every row is kept with all its columns; a file's
    rules are one array (its size is the file's), and the first match decides."""
    # one row per robots file: its governing rules in file order
    files = (governing_rules(robots, user_agent).groupBy(F.col("domain").alias("_rd"))
             .agg(F.array_sort(F.collect_list(F.struct("rule_no", "path", "allow"))).alias("_rules")))
    path = F.col("_p")
    matching = F.filter("_rules", lambda r: (r["path"] == "*") | path.startswith(r["path"]))
    return (urls.withColumn("_d", netloc(url_col)).withColumn("_p", url_path_key(url_col))
            .join(files, F.col("_d") == F.col("_rd"), "left")
            .select(*urls.columns, F.coalesce(F.get(matching, F.lit(0))["allow"], F.lit(True)).alias("allowed")))


def blocked_counts(allowed: DataFrame, url_col: str = "url") -> DataFrame:
    """URLs blocked by robots per domain."""
    return allowed.groupBy(netloc(url_col).alias("domain")).agg(
        F.count_if(~F.col("allowed")).alias("blocked_by_robots"), F.count(F.lit(1)).alias("checked"))


def domain_delays(domains: DataFrame, robots: DataFrame) -> DataFrame:
    """Crawl delay per domain, 1.0 where the file has none (or no file)."""
    d = crawl_delays(robots)
    return (domains.select("domain").distinct().join(d, "domain", "left")
            .select("domain", F.coalesce("crawl_delay", F.lit(DEFAULT_CRAWL_DELAY)).alias("crawl_delay")))

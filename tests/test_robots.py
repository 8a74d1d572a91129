"""Robots: parse + allow/deny against the standard-library parser (brute force)."""

import urllib.robotparser

import pytest

from webloom.operators import robots as RB
from webloom.sources import robots as RS

FILES = {
    "a.com": "User-agent: *\nDisallow: /deny\n",
    "b.com": ("User-agent: webloombot\nDisallow: /\n\nUser-agent: Crawler\nUser-agent: other\nDisallow: /de/ # x\n"
              "Allow: /\n\n# default\nUser-agent: *\nDisallow: /fr/\n"),
    "c.com": "Disallow: /early\nUser-agent: *\nDisallow: /en/\nAllow: /en/1\nCrawl-delay: 2.5\n",
    "d.com": "User-agent: *\nDisallow:\nCrawl-delay: abc\ncrawl-delay: 0.5\n",
    "e.com": "User-agent: *\nDisallow: /x\n\nUser-agent: *\nDisallow: /\n",
    "f.com": "User-agent: a\n\nDisallow: /lost\nUser-agent: *\nAllow: /p\nDisallow: /\n",
}
PATHS = ["/", "/deny", "/deny/x", "/de/a", "/fr/b", "/en/1", "/en/2", "/early", "/x", "/p?q=1", "/lost", "/other"]
AGENTS = ["*", "WebloomCrawler/1.0", "webloombot/2", "OTHERbot"]


@pytest.mark.parametrize("agent", AGENTS)
def test_allow_matches_stdlib(spark, agent):
    robots = spark.createDataFrame(list(FILES.items()), "domain string, content string")
    urls = [(i, f"https://{d}{p}") for i, (d, p) in enumerate((d, p) for d in FILES for p in PATHS)]
    df = spark.createDataFrame(urls, "url_id long, url string")
    got = {r.url: r.allowed for r in RB.allow_urls(df, robots, agent).collect()}
    for d, content in FILES.items():
        rp = urllib.robotparser.RobotFileParser()
        rp.parse(content.splitlines())
        for p in PATHS:
            u = f"https://{d}{p}"
            assert got[u] == rp.can_fetch(agent, u), (agent, u)


def test_reference_case(spark):
    robots = spark.createDataFrame([("example.com", "User-agent: *\nDisallow: /deny")], "domain string, content string")
    df = spark.createDataFrame([(1, "https://example.com/"), (2, "https://example.com/deny"),
                                (3, "https://nofile.com/deny")], "url_id long, url string")
    got = {r.url_id: r.allowed for r in RB.allow_urls(df, robots).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_crawl_delay(spark):
    robots = spark.createDataFrame(list(FILES.items()), "domain string, content string")
    doms = spark.createDataFrame([(d,) for d in list(FILES) + ["none.com"]], "domain string")
    got = {r.domain: r.crawl_delay for r in RB.domain_delays(doms, robots).collect()}
    assert got["c.com"] == 2.5 and got["d.com"] == 0.5 and got["a.com"] == 1.0 and got["none.com"] == 1.0


def test_groups(spark):
    robots = spark.createDataFrame([("b.com", FILES["b.com"])], "domain string, content string")
    groups, rules = RS.robots_groups_and_rules(robots)
    g = sorted((r.group_no, tuple(r.agents), r.is_default) for r in groups.collect())
    assert g == [(1, ("webloombot",), False), (2, ("Crawler", "other"), False), (3, ("*",), True)]
    assert rules.count() == 4


def test_equal_rows_are_kept_and_escapes_decoded(spark):
    robots = spark.createDataFrame([("a.com", "User-agent: *\nDisallow: /a%20b\nDisallow: /c+d")], "domain string, content string")
    rows = [(1, "https://a.com/a b/x"), (1, "https://a.com/a b/x"), (2, "https://a.com/a%20b"), (3, "https://a.com/ab"),
            (4, "https://a.com/c+d"), (5, "https://a.com/100%")]
    got = RB.allow_urls(spark.createDataFrame(rows, "url_id long, url string"), robots).collect()
    assert sorted((r.url_id, r.allowed) for r in got) == [(1, False), (1, False), (2, False), (3, True), (4, False), (5, True)]

"""Traversal: queue semantics and reachability against a brute-force BFS."""

import random
from collections import deque

from pyspark.sql import functions as F

from webloom.operators import frontier as D


def bfs(seeds, edges, max_depth):
    adj = {}
    for s, d, p in edges:
        adj.setdefault(s, []).append((p, d))
    depth = {s: 0 for s in seeds}
    q = deque(seeds)
    while q:
        u = q.popleft()
        if depth[u] >= max_depth:
            continue
        for _, v in sorted(adj.get(u, [])):
            if v not in depth:
                depth[v] = depth[u] + 1
                q.append(v)
    return depth


def test_reach_random_graph(spark):
    rnd = random.Random(5)
    nodes = [f"n{i}" for i in range(300)]
    edges = list({(rnd.choice(nodes[:40]) if rnd.random() < 0.5 else rnd.choice(nodes), rnd.choice(nodes), i)
                  for i in range(1500)})
    seeds = ["n0", "n1", "n2"]
    sd = spark.createDataFrame([(s, i) for i, s in enumerate(seeds)], "url string, seed_ord int")
    ed = spark.createDataFrame(edges, "src_url string, dst_url string, pos int")
    for k in (0, 1, 2, 4):
        got = {r.url: r.depth for r in D.reach(sd, ed, k).collect()}
        assert got == bfs(seeds, edges, k)
        assert max(got.values()) <= k


def test_seeds_are_made_once_and_no_level_is_probed(spark, tmp_path, monkeypatch):
    """Levels and the result read the seeds as written, not their source; null and repeated seeds and edges, and no seeds at all."""
    seeds, edges, none = (str(tmp_path / x) for x in ("seeds", "edges", "none"))
    form = "url string, seed_ord int"
    spark.createDataFrame([("a", 1), ("a", 0), (None, 2), ("alone", 3)], form).write.parquet(seeds)
    spark.createDataFrame([], form).write.parquet(none)
    spark.createDataFrame([("a", "b", 1), ("a", "b", 1), ("a", "b", 0), ("b", "a", 0), ("b", None, 0), ("b", "c", None), (None, "x", 0), ("c", "d", 0)],
                          "src_url string, dst_url string, pos int").write.parquet(edges)
    monkeypatch.setattr(type(spark.range(0)), "isEmpty", None)
    r = D.reach(spark.read.parquet(seeds), spark.read.parquet(edges), 2)
    assert not any(seeds in f or edges in f for f in r.inputFiles())
    assert {(x.url, x.depth, x.priority, tuple(x.path)) for x in r.collect()} == {
        ("a", 0, 0, (0,)), (None, 0, 0, (2,)), ("alone", 0, 0, (3,)), ("b", 1, 1, (0, 0)), ("c", 2, 1, (0, 0, None)), (None, 2, 1, (0, 0, 0))}
    assert D.reach(spark.read.parquet(none), spark.read.parquet(edges), 3).count() == 0


def test_queue_priority_and_dedup(spark):
    offers = spark.createDataFrame([("http://example.com", 0, 1), ("http://example.org", 0, 0),
                                    ("http://example.com", 0, 1)], "url string, depth int, priority int")
    d = D.enqueue_dedup(offers)
    assert d.count() == 2
    first = d.withColumn("path", F.array()).orderBy("priority", "depth", "path", "url").first()
    assert first.url == "http://example.org"


def test_states_and_budget(spark):
    seeds = spark.createDataFrame([("http://t.com/", 0)], "url string, seed_ord int")
    edges = spark.createDataFrame([("http://t.com/", "http://t.com/page1", 0), ("http://t.com/", "http://t.com/page2", 1),
                                   ("http://t.com/page1", "http://t.com/deep", 0)], "src_url string, dst_url string, pos int")
    r = D.reach(seeds, edges, 1, enqueue_beyond=True)
    pages = spark.createDataFrame([("http://t.com/",), ("http://t.com/page1",)], "url string")
    st = {x.url: x.state for x in D.url_states(r, pages, 1, k=2).collect()}
    assert st == {"http://t.com/": "processed", "http://t.com/page1": "processed",
                  "http://t.com/page2": "pending", "http://t.com/deep": "dropped_depth"}
    c = D.state_counts(D.url_states(r, pages, 1, k=2)).collect()[0]
    assert (c.total_added, c.processed, c.pending, c.dropped_depth) == (4, 2, 1, 1)
    b = [x.url for x in D.budget(r.filter("depth <= 1"), 2).collect()]
    assert b == ["http://t.com/", "http://t.com/page1"]

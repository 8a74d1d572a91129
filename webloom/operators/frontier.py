"""Frontier and traversal: D2 enqueue dedup, D3 bounded reachability,
D4 page budget, D5 frontier state counts.

D3 is breadth-first: one Spark job per depth level.  Each level joins the
new frontier to the edge table on the source URL (AQE splits a hub URL with
a huge out-degree), applies the scope filters to the discovered targets,
keeps one row per target (min discovery path, partial aggregation), drops
everything already seen (anti-join) and cuts the lineage with a reliable
checkpoint in the shared checkpoint folder.  The seeds are cut like a level, as
every level reads them.  The driver only holds how many rows the new level has,
counted as they are written.  Spark's recursive CTE is not used: it has only
``UNION ALL``, so cycles would multiply rows instead of stopping.

Discovery order is deterministic: the path of positions from the seed
(seed ordinal, then the link position at each hop), compared
lexicographically, equals breadth-first discovery order within a depth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut_lineage


def reach(seeds: DataFrame, edges: DataFrame, max_depth: int,
          link_filter: Callable[[DataFrame], DataFrame] | None = None,
          expand_filter: Callable[[DataFrame], DataFrame] | None = None,
          enqueue_beyond: bool = False, checkpoint: bool = True) -> DataFrame:
    """Min depth and discovery path per URL reachable within ``max_depth``.

    seeds: (url, seed_ord); edges: (src_url, dst_url, pos).
    ``link_filter`` filters discovered targets (scope rules; never seeds).
    ``expand_filter`` restricts which reached URLs are expanded (e.g. robots).
    ``enqueue_beyond`` also returns the level ``max_depth + 1`` (enqueued by
    the crawler, dropped when popped).
    Returns (url, depth INT, priority INT, path ARRAY<INT>).
    """
    e = edges.select("src_url", "dst_url", F.col("pos").cast("int").alias("pos"))
    if checkpoint:
        # materialise the edge table once (links are not re-extracted from html
        # at every level).  It is left evenly partitioned, not hashed on src_url:
        # a hub URL's out-links then spread over many tasks when the frontier is
        # broadcast, and a shuffle join keeps AQE's skew splitting.
        e = cut_lineage(e)
    seen = seeds.select(F.col("url"), F.lit(0).alias("depth"), F.lit(0).alias("priority"),
                        F.array(F.col("seed_ord").cast("int")).alias("path"))
    seen = seen.groupBy("url").agg(F.min("depth").alias("depth"), F.min("priority").alias("priority"),
                                   F.min("path").alias("path"))
    if checkpoint:
        seen = cut_lineage(seen)  # made once, not by every level's join and anti-join and by the result
    frontier = seen
    last = max_depth + (1 if enqueue_beyond else 0)
    for d in range(1, last + 1):
        src = frontier if expand_filter is None else expand_filter(frontier)
        cand = (src.select(F.col("url").alias("src_url"), "path")
                .join(e, "src_url")
                .select(F.col("dst_url").alias("url"), F.concat("path", F.array("pos")).alias("path")))
        if link_filter is not None:
            cand = link_filter(cand)
        cand = cand.groupBy("url").agg(F.min("path").alias("path"))
        new = (cand.join(seen.select("url"), "url", "left_anti")
               .select("url", F.lit(d).alias("depth"), F.lit(1).alias("priority"), "path"))
        if checkpoint:
            written = Observation()
            new = cut_lineage(new.observe(written, F.count(F.lit(1)).alias("n")))
            empty = written.get["n"] == 0
        else:
            empty = new.isEmpty()
        if empty:
            break
        seen = seen.unionByName(new)
        frontier = new
    return seen


def enqueue_dedup(offers: DataFrame) -> DataFrame:
    """One row per URL offered to the queue (min depth and priority), with
    how many times it was offered."""
    return offers.groupBy("url").agg(F.min("depth").alias("depth"), F.min("priority").alias("priority"),
                                     F.count(F.lit(1)).alias("offers"))


def budget(reached: DataFrame, k: int = 100) -> DataFrame:
    """The first ``k`` URLs in queue order (priority, depth, discovery, url).
    Plans as TakeOrderedAndProject: per-partition top-k, then a k-row merge."""
    return reached.orderBy("priority", "depth", "path", "url").limit(k)


def url_states(reached: DataFrame, pages: DataFrame, max_depth: int, k: int = 100) -> DataFrame:
    """Per reached URL: processed (in budget, stored page), failed (in budget,
    no page), pending (within depth, beyond budget), dropped_depth (enqueued
    beyond the depth cap)."""
    within = reached.filter(F.col("depth") <= max_depth)
    top = budget(within, k).select("url", F.lit(True).alias("_in_budget"))
    have = pages.select(F.col("url").alias("_purl")).distinct().withColumn("_page", F.lit(True))
    x = reached.join(top, "url", "left").join(have, F.col("url") == F.col("_purl"), "left")
    state = (F.when(F.col("depth") > max_depth, "dropped_depth")
             .when(F.col("_in_budget") & F.col("_page"), "processed")
             .when(F.col("_in_budget"), "failed")
             .otherwise("pending"))
    return x.select("url", "depth", state.alias("state"))


def state_counts(states: DataFrame) -> DataFrame:
    """total_added and counts per state in one aggregation."""
    return states.agg(
        F.count(F.lit(1)).alias("total_added"),
        F.count_if(F.col("state") == "processed").alias("processed"),
        F.count_if(F.col("state") == "failed").alias("failed"),
        F.count_if(F.col("state") == "pending").alias("pending"),
        F.count_if(F.col("state") == "dropped_depth").alias("dropped_depth"),
        F.count_if(F.col("state").isin("processed", "failed")).alias("visited"))

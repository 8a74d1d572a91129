"""Outage intervals of the per-domain circuit breaker (batch).

Breaker rules: every failure except PermanentError is recorded; failures
older than ``window`` (strictly) are dropped; with ``>= threshold`` left the
breaker opens (or stays open) until ``ts + cooldown``; the first request at or
after ``open_until`` closes it and clears the history.

Two facts make this a Spark job instead of one loop over the log:

* only counting failures change the state: a failure at ``ts >= open_until``
  is itself a request at/after ``open_until``, so the clear always lands
  between the failures before and after ``open_until``.  Successes are not
  needed at all (the log shrinks to the failure rows);
* a quiet gap longer than ``window`` and at least ``cooldown`` between two
  failures of a domain resets the breaker completely, so each domain splits
  into independent episodes (gap test = bucketed ``previous_row``, episode
  number = bucketed running sum).

Episodes are replayed in parallel time chunks by ``applyInPandas`` (see below).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.outcomes import counts_for_breaker
from .sequence import KEY_BUCKET_SECONDS, Prefix, prefix_aggregate, previous_row, time_bucket

OUTAGE_SCHEMA = ("domain STRING, episode LONG, opened_at TIMESTAMP, open_until TIMESTAMP, "
                 "opened_by LONG, failures_while_open LONG")
ORDER = ["ts", "event_id"]


def counting_failures(outcomes: DataFrame, window_s: float, cooldown_s: float,
                      bucket_seconds: int = KEY_BUCKET_SECONDS) -> DataFrame:
    """Counting failures with their episode number: a new episode starts
    after a quiet gap longer than the window and at least the cooldown."""
    w_us, c_us = int(window_s * 1e6), int(cooldown_s * 1e6)
    f = outcomes.filter(counts_for_breaker("error_type")).select("domain", "ts", "event_id")
    f = f.withColumn("_bk", time_bucket("ts", bucket_seconds))
    f = previous_row(f, ["domain"], ORDER, "_bk", ["ts"])
    gap = F.unix_micros("ts") - F.unix_micros("prev_ts")
    new_ep = F.when(F.col("prev_ts").isNull() | ((gap > w_us) & (gap >= c_us)), 1).otherwise(0)
    f = prefix_aggregate(f.withColumn("_new", new_ep), ["domain"], ORDER, "_bk", [Prefix("episode", F.col("_new"))])
    return f.select("domain", "episode", F.unix_micros("ts").alias("t_us"), "event_id")


def outages(outcomes: DataFrame, threshold: int = 5, window_s: float = 60.0, cooldown_s: float = 30.0,
            bucket_seconds: int = KEY_BUCKET_SECONDS, chunk_seconds: int | None = None) -> DataFrame:
    """Outage intervals.  Episodes are replayed in time chunks of
    ``chunk_seconds`` in parallel (see ``chunked_replay``).  The default chunk
    spans at least twice window + cooldown, so a chunk's start state depends
    on little more than its neighbour and the replay converges in few rounds."""
    w_us, c_us = int(window_s * 1e6), int(cooldown_s * 1e6)
    f = counting_failures(outcomes, window_s, cooldown_s, bucket_seconds)
    chunk = chunk_seconds or max(bucket_seconds, int(2 * (window_s + cooldown_s)))
    return chunked_replay(f, threshold, w_us, c_us, int(chunk * 1e6))


# ---- chunked replay -------------------------------------------------------------------
# The breaker's dynamic state is small: the last (threshold - 1) failure times
# since the last clear and ``open_until``.  Every chunk of an episode is
# replayed in parallel from an assumed start state; then each chunk's assumed
# start is compared with the end state of the chunk before it (normalised to
# the chunk's start: times older than the window dropped, an interval that has
# already run out counts as closed).  Only chunks whose start was wrong are
# replayed again, until nothing changes.  A dense stretch converges in a few
# rounds because an open breaker that keeps failing forgets how it started.
# Outages cut by chunk edges are stitched: a record that continues an outage
# open at its chunk's start joins the record before it.

REPLAY_SCHEMA = ("domain STRING, episode LONG, chunk LONG, kind STRING, seq INT, opened_at_us LONG, "
                 "opened_by LONG, open_until_us LONG, n_open LONG, cont BOOLEAN, "
                 "e_recent ARRAY<LONG>, e_open_until LONG")


def replay_chunk(times, eids, recent, open_until, threshold, window_us, cooldown_us):
    """Replay one chunk from a start state.  Returns (records, end_state);
    a record is (opened_at, opened_by, open_until, n_open, cont, finished)."""
    recent = list(recent)
    recs = []
    cont = open_until is not None
    opened_at = opened_by = None
    n_open = 0
    for t, eid in zip(times, eids):
        if open_until is not None and t >= open_until:
            recs.append((opened_at, opened_by, open_until, n_open, cont))
            open_until, recent, cont, n_open = None, [], False, 0
        recent.append(t)
        recent = [x for x in recent if x >= t - window_us]
        if len(recent) >= threshold:
            if open_until is None:
                opened_at, opened_by, n_open, cont = t, eid, 0, False
            open_until = t + cooldown_us
        if open_until is not None:
            n_open += 1
        if len(recent) > threshold - 1:
            recent = recent[-(threshold - 1):] if threshold > 1 else []
    if open_until is not None:
        recs.append((opened_at, opened_by, open_until, n_open, cont))
    return recs, (recent, open_until)


def _replay_groups(threshold, window_us, cooldown_us):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t_us", "event_id"])
        first = pdf.iloc[0]
        start_recent = list(first["s_recent"]) if first["s_recent"] is not None else []
        start_open = None if pd.isna(first["s_open_until"]) else int(first["s_open_until"])
        recs, (recent, open_until) = replay_chunk(pdf["t_us"].tolist(), pdf["event_id"].tolist(), start_recent,
                                                  start_open, threshold, window_us, cooldown_us)
        d, e, c = first["domain"], int(first["episode"]), int(first["chunk"])
        rows = [dict(domain=d, episode=e, chunk=c, kind="rec", seq=i, opened_at_us=r[0], opened_by=r[1],
                     open_until_us=r[2], n_open=r[3], cont=r[4], e_recent=None, e_open_until=None)
                for i, r in enumerate(recs)]
        rows.append(dict(domain=d, episode=e, chunk=c, kind="end", seq=len(recs), opened_at_us=None, opened_by=None,
                         open_until_us=None, n_open=None, cont=None, e_recent=[int(x) for x in recent],
                         e_open_until=open_until))
        out = pd.DataFrame(rows)
        for col in ("opened_at_us", "opened_by", "open_until_us", "n_open", "e_open_until"):
            out[col] = out[col].astype("Int64")
        out["seq"] = out["seq"].astype("int32")
        return out
    return fn


def _normalise(recent: F.Column, open_until: F.Column, start_us: F.Column, window_us: int):
    """State as seen at ``start_us``: expired interval -> closed and cleared."""
    expired = open_until.isNotNull() & (open_until <= start_us)
    r = F.when(expired | recent.isNull(), F.array().cast("array<long>")).otherwise(
        F.filter(recent, lambda x: x >= start_us - F.lit(window_us)))
    o = F.when(expired, F.lit(None).cast("long")).otherwise(open_until)
    return r, o


STATE = ["domain", "e_recent", "e_open_until", "opened_at_us", "opened_by", "n_open"]


def chunked_replay(f: DataFrame, threshold: int, window_us: int, cooldown_us: int, chunk_us: int,
                   carry: DataFrame | None = None, with_state: bool = False):
    """Replay rounds until no chunk's assumed start differs from the end before it.
    Every round settles at least the first stale chunk of each episode for good,
    so the loop ends, and it ends only with a consistent state.

    ``carry`` (columns ``STATE``; one row per domain, all failures in one episode 0) is the state that an
    earlier part of the log ended in: it stands as the chunk before all others.  ``with_state`` also
    returns the state behind the last chunk of every domain that ``f`` holds."""
    from ..session import cut_lineage
    before = None
    if carry is not None:
        before = carry.select("domain", F.lit(0).cast("long").alias("episode"), F.lit(-(1 << 40)).cast("long").alias("chunk"), *STATE[1:])
    f = f.withColumn("chunk", F.floor(F.col("t_us") / F.lit(chunk_us)).cast("long"))
    f = cut_lineage(f)
    keys = ["domain", "episode", "chunk"]
    fn = _replay_groups(threshold, window_us, cooldown_us)
    chunks = f.groupBy(*keys).agg(F.min("t_us").alias("_first")).select(
        *keys, F.array().cast("array<long>").alias("s_recent"), F.lit(None).cast("long").alias("s_open_until"))

    def run(starts: DataFrame) -> DataFrame:
        x = f.join(starts, keys)
        return x.groupBy(*keys).applyInPandas(fn, REPLAY_SCHEMA)

    state = cut_lineage(run(chunks).join(chunks, keys))  # replay rows + the start each chunk assumed
    while True:
        ends = state.filter(F.col("kind") == "end").select(*keys, "s_recent", "s_open_until", "e_recent",
                                                            "e_open_until")
        if before is not None:
            ends = ends.unionByName(before.select(*keys, "e_recent", "e_open_until"), allowMissingColumns=True)
        # previous chunk of the same episode; the chunk table has one row per chunk
        ends = ends.withColumn("_cb", F.floor(F.col("chunk") / F.lit(1024)).cast("long"))
        prev = previous_row(ends, ["domain", "episode"], ["chunk"], "_cb", ["e_recent", "e_open_until"])
        r, o = _normalise(F.col("prev_e_recent"), F.col("prev_e_open_until"), F.col("chunk") * F.lit(chunk_us),
                          window_us)
        if before is not None:
            prev = prev.where("s_recent IS NOT NULL")  # a carried state assumes nothing
        cmp = prev.select(*keys, "s_recent", "s_open_until", r.alias("a_recent"), o.alias("a_open_until"))
        stale = cmp.filter(~(F.col("s_recent").eqNullSafe(F.col("a_recent"))
                             & F.col("s_open_until").eqNullSafe(F.col("a_open_until"))))
        # small (one row per chunk whose start was wrong); recomputed from the cut state
        stale = stale.select(*keys, F.col("a_recent").alias("s_recent"), F.col("a_open_until").alias("s_open_until"))
        if stale.isEmpty():
            break
        redo = run(stale).join(stale, keys)
        state = cut_lineage(state.join(stale.select(*keys), keys, "left_anti").unionByName(redo))
    recs = state.filter(F.col("kind") == "rec").select(*keys, "seq", "opened_at_us", "opened_by", "open_until_us",
                                                       "n_open", "cont")
    if before is not None:  # an outage still open when the earlier part ended
        # once another failure of the domain is known; else its last version stands
        recs = recs.unionByName(before.where("e_open_until IS NOT NULL").join(recs.select("domain").distinct(), "domain", "left_semi").select(
            *keys, F.lit(0).alias("seq"), "opened_at_us", "opened_by", F.col("e_open_until").alias("open_until_us"), "n_open",
            F.lit(False).alias("cont")))
    # stitch: every record that does not continue an earlier outage starts an island
    recs = recs.withColumn("_cb", F.floor(F.col("chunk") / F.lit(1024)).cast("long"))
    recs = prefix_aggregate(recs, ["domain", "episode"], ["chunk", "seq"], "_cb",
                            [Prefix("island", (~F.col("cont")).cast("int"))])
    out = recs.groupBy("domain", "episode", "island").agg(
        F.max("opened_at_us").alias("opened_at_us"), F.max("opened_by").alias("opened_by"),
        F.max("open_until_us").alias("open_until_us"), F.sum("n_open").alias("failures_while_open"))
    found = out.select("domain", "episode", F.timestamp_micros("opened_at_us").alias("opened_at"),
                       F.timestamp_micros("open_until_us").alias("open_until"), "opened_by",
                       F.col("failures_while_open").cast("long").alias("failures_while_open"))
    if not with_state:
        return found
    last = (state.filter(F.col("kind") == "end").groupBy("domain")
            .agg(F.max_by(F.struct("e_recent", "e_open_until"), "chunk").alias("e")).select("domain", "e.*"))
    latest = out.groupBy("domain").agg(F.max_by(F.struct("opened_at_us", "opened_by", F.col("failures_while_open").alias("n_open")),
                                                "opened_at_us").alias("o")).select("domain", "o.*")
    open_now = F.col("e_open_until").isNotNull()
    return found, last.join(latest, "domain", "left").select(
        "domain", "e_recent", "e_open_until", *(F.when(open_now, F.col(c)).cast("long").alias(c) for c in STATE[3:]))


def flag_blocked(outcomes: DataFrame, outs: DataFrame, bucket_seconds: int = KEY_BUCKET_SECONDS) -> DataFrame:
    """Rows that start while the breaker is open: after the opening failure
    and before ``open_until``.  As-of lookup of the latest outage opened at or
    before each row, done with bucketed carry instead of a range join."""
    marks = outs.select("domain", F.col("opened_at").alias("ts"), F.col("opened_by").alias("event_id"),
                        F.col("open_until").alias("_until"), F.lit(True).alias("_mark"))
    rows = outcomes.select("domain", "ts", "event_id", F.lit(None).cast("timestamp").alias("_until"),
                           F.lit(False).alias("_mark"))
    u = marks.unionByName(rows).withColumn("_bk", time_bucket("ts", bucket_seconds))
    # order: a mark sorts after its own opening row (same ts, event_id) so that row is not blocked
    u = u.withColumn("_mk", F.col("_mark").cast("int"))
    u = prefix_aggregate(u, ["domain"], ["ts", "event_id", "_mk"], "_bk",
                         [Prefix("_last_until_us", F.when(F.col("_mark"), F.unix_micros("_until")), how="max",
                                 inclusive=False)])
    r = u.filter(~F.col("_mark"))
    return r.select("domain", "ts", "event_id",
                    F.coalesce(F.unix_micros("ts") < F.col("_last_until_us"), F.lit(False)).alias("blocked"))

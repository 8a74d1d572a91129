"""W8 against a sweep over all events."""

import datetime as dt
import random

from webloom.operators import politeness as P


def sweep(intervals, limit):
    """Spans over the limit and the profile of one domain's (start, end) microseconds."""
    ev = sorted([(a, 1, i) for i, (a, _) in enumerate(intervals)] + [(z, -1, i) for i, (_, z) in enumerate(intervals)])
    active, spans, steps = 0, [], {}
    for t, d, _ in ev:
        was, active = active, active + d
        steps[t] = active
        if active > limit >= was:
            spans.append([t, t, active, 0])
        if active > limit:
            spans[-1][2] = max(spans[-1][2], active)
            spans[-1][3] += d == 1
        if active > limit or was > limit:
            spans[-1][1] = t
    return [tuple(s) for s in spans], steps


def test_spans_and_steps_equal_a_sweep(spark):
    rng, t0, rows, want = random.Random(2), dt.datetime(2024, 1, 1), [], {}
    for d in ("hot.com", "b.com"):
        iv, t = [], 0
        for i in range(250 if d == "hot.com" else 40):
            t += rng.choice([0, 1, 2, 40]) * 1_000_000
            n = rng.choice([1, 5, 30, 300 if i % 50 == 0 else 2]) * 1_000_000  # some last over many buckets
            iv.append((t, t + n))
            rows.append((d, f"https://{d}/{i}", 0, 0, i, t0 + dt.timedelta(microseconds=t), n / 1e6))
        want[d] = iv
    a = spark.createDataFrame(rows, "domain string, url string, run long, request_no long, event_id long, ts timestamp, elapsed_s double")
    base = int(t0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)

    def us(x):
        return int(x.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) - base

    for width in (7, 100_000):
        got = {}
        for r in P.over_limit_spans(a, limit=3, bucket_seconds=width).collect():
            got.setdefault(r.domain, []).append((us(r.span_start), us(r.span_end), r.peak_active, r.starts))
        assert {d: sorted(s) for d, s in got.items()} == {d: s for d, iv in want.items() if (s := sweep(iv, 3)[0])}
        steps = {(r.domain, us(r.at)): r.active for r in P.concurrency_steps(a, bucket_seconds=width).collect()}
        assert steps == {(d, t): n for d, iv in want.items() for t, n in sweep(iv, 3)[1].items()}
    every = sorted((us(r.span_start), us(r.span_end), r.peak_active, r.starts) for r in P.over_limit_spans(a, 3, per_domain=False, bucket_seconds=7).collect())
    assert every == sweep([x for iv in want.values() for x in iv], 3)[0]

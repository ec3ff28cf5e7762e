"""Epoch-aligned windows and gaps with an unaligned range, against brute force."""

import random

from devmetrics.operators.aggregates import continuity_gaps, window_count

H = 3600 * 10**9


def _brute(points, every, start, stop):
    first = start - start % every
    starts = list(range(first, stop, every))
    groups = sorted({g for g, t in points if start <= t < stop}, key=str)
    counts = {}
    for g in groups:
        for w in starts:
            counts[(g, w)] = sum(1 for gg, t in points if gg == g and start <= t < stop and w <= t < w + every)
    return groups, starts, counts


def test_window_count_and_gaps_unaligned(spark):
    rnd = random.Random(2)
    start, stop = 10 * H + 17 * 60 * 10**9, 40 * H + 43 * 60 * 10**9  # neither on an hour
    points = [(rnd.choice(["a", "b", None]), rnd.randrange(8 * H, 43 * H)) for _ in range(120)]
    df = spark.createDataFrame([(g, t) for g, t in points], "gpu_id string, timestamp_ns long")
    groups, starts, counts = _brute(points, H, start, stop)

    got = {(r.gpu_id, r.window_start_ns, r.window_end_ns): r.points
           for r in window_count(df, H, start, stop, by=("gpu_id",)).collect()}
    expected = {(g, max(w, start), min(w + H, stop)): counts[(g, w)] for g in groups for w in starts}
    assert got == expected

    gaps = {(r.gpu_id, r.gap_start_ns, r.gap_end_ns, r.empty_windows)
            for r in continuity_gaps(df, H, start, stop, by=("gpu_id",)).collect()}
    want = set()
    for g in groups:
        run = []
        for w in starts + [None]:
            if w is not None and counts[(g, w)] == 0:
                run.append(w)
            elif run:
                want.add((g, max(run[0], start), min(run[-1] + H, stop), len(run)))
                run = []
    assert gaps == want

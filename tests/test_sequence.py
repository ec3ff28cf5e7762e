"""Bucket-split ordered operators against brute force, with one key holding most rows."""

import random

import pytest

from devmetrics.operators.sequence import asof_join, previous_row, rolling_agg
from pyspark.sql import functions as F

S = 10**9


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = []
    for i in range(600):
        key = "hot" if i % 3 else rnd.choice(["a", "b", None])
        out.append((i, key, rnd.randrange(0, 20 * 3600) * S, float(rnd.randrange(100))))
    return out


def test_previous_row(spark, rows):
    df = spark.createDataFrame(rows, "id long, k string, t long, v double")
    got = {r.id: (r.prev_t, r.prev_v) for r in previous_row(df, ["k"], "t", "id", ["v"], bucket_ns=3600 * S).collect()}
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        by_key.setdefault(r[1], []).append(r)
    for seq in by_key.values():
        for i, r in enumerate(seq):
            assert got[r[0]] == ((None, None) if i == 0 else (seq[i - 1][2], seq[i - 1][3]))


@pytest.mark.parametrize("split_rows", [5, 50])
def test_hot_buckets_are_cut(spark, split_rows):
    """Nearly all rows of one key within one minute of one day: the same results, and the largest window group is a
    small share of the rows."""
    from devmetrics.operators.sequence import bucketed
    from devmetrics.functions.values import truncate_ns

    rnd = random.Random(9)
    day = 24 * 3600 * S
    data = [(i, "hot" if i % 3 else "cold", (rnd.randrange(60) if i % 10 else rnd.randrange(5 * 86400)) * S + rnd.randrange(S), float(i)) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, k string, t long, v double")
    got = {r.id: (r.prev_t, r.prev_v) for r in previous_row(df, ["k"], "t", "id", ["v"], day, split_rows=split_rows).collect()}
    want, last = {}, {}
    for i, k, t, v in sorted(data, key=lambda r: (r[2], r[0])):
        want[i] = last.get(k, (None, None))
        last[k] = (t, v)
    assert got == want
    right = [(k, rnd.randrange(60) * S, f"o{i}") for i, k in enumerate(["hot"] * 30 + ["cold"] * 5)]
    r = spark.createDataFrame(right, "k string, from_t long, owner string")
    owners = {x.id: x.from_t for x in asof_join(df, r, ["k"], "t", "from_t", ["owner"], day, split_rows=split_rows).collect()}
    assert owners == {i: max((f for c, f, _ in right if c == k and f <= t), default=None) for i, k, t, _ in data}
    cut, summary = bucketed(df, ["k"], truncate_ns(F.col("t"), day), ["t", "id"], {"_v": F.sum("v")}, "test", split_rows)
    sizes = {r["_kb"]: r["count"] for r in cut.groupBy("_kb").count().collect()}
    assert max(sizes.values()) <= 0.1 * len(data) and sum(sizes.values()) == len(data)
    assert {r["_kb"]: r["_rows"] for r in summary.collect()} == sizes


def _spy(monkeypatch):
    """Names of the tables that the ordered operators stage."""
    from devmetrics.operators import sequence

    staged, real = [], sequence._materialize
    monkeypatch.setattr(sequence, "_materialize", lambda df, name: staged.append(name) or real(df, name))
    return staged


def test_no_pass_for_splitting_when_nothing_is_hot(spark, rows, monkeypatch):
    staged = _spy(monkeypatch)
    df = spark.createDataFrame(rows, "id long, k string, t long, v double")
    previous_row(df, ["k"], "t", "id", ["v"], 3600 * S, split_rows=1000).count()
    assert staged == ["previous-row-buckets"]  # one row per key and bucket, needed anyway
    previous_row(df, ["k"], "t", "id", ["v"], 3600 * S, split_rows=10).count()
    assert staged[1:] == ["previous-row-buckets", "previous-row-hot"]


@pytest.mark.parametrize("split_rows", [None, 20])
def test_rows_of_one_instant_are_cut(spark, split_rows):
    """Most rows at one time: cut by the tie-break; sums, previous rows and as-of matches stay exact."""
    from devmetrics.operators.sequence import bucketed, running_sum

    data = [(i, "hot", 7 * S if i % 10 else i * S, i % 5 - 2) for i in range(1000)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "id long, k string, t long, v long").repartition(5)
    day = F.call_function("div", F.col("t"), F.lit(86400 * S))
    if split_rows:
        cut, _ = bucketed(df, ["k"], day, ["t", "id"], {}, "test", split_rows)
        assert cut.groupBy("_kb").count().agg({"count": "max"}).first()[0] <= 0.1 * len(data)
    in_order = sorted(data, key=lambda r: (r[2], r[0]))
    got = {r.id: r.run for r in running_sum(df, ["t", "id"], "v", day, "run", super_bucket=day, split_rows=split_rows).collect()}
    acc = 0
    for r in in_order:
        acc += r[3]
        assert got[r[0]] == acc
    prev = {r.id: r.prev_id for r in previous_row(df, ["k"], "t", "id", ["id"], 86400 * S, split_rows=split_rows).collect()}
    assert prev == {r[0]: (in_order[i - 1][0] if i else None) for i, r in enumerate(in_order)}
    right = [("hot", t * S, o) for t, o in [(0, "a"), (7, "c"), (7, "b"), (7, None), (9, "x"), (9, "d"), (2000, "z")]]
    for order in (right, right[::-1]):
        r = spark.createDataFrame(order, "k string, from_t long, owner string")
        owners = {x.id: x.owner for x in asof_join(df, r, ["k"], "t", "from_t", ["owner"], 86400 * S, split_rows=split_rows, tiebreak="id").collect()}
        assert owners == {i: "x" if t >= 9 * S else "c" if t >= 7 * S else "a" for i, _, t, _ in data}


def test_running_totals_of_several_columns(spark, rows):
    from devmetrics.operators.sequence import running_totals

    df = spark.createDataFrame(rows, "id long, k string, t long, v double")
    out = running_totals(df, ["t", "id"], {"n": "id", "s": "v"}, F.call_function("div", F.col("t"), F.lit(3600 * S)), ("k",), split_rows=30)
    got, acc = {r.id: (r.n, r.s) for r in out.collect()}, {}
    for i, k, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
        n, s = acc.get(k, (0, 0.0))
        acc[k] = n + i, s + v
        assert got[i] == acc[k]


@pytest.mark.parametrize("split_rows", [None, 40, 10_000])
def test_rolling_mean_of_a_hot_gpu(spark, split_rows):
    """One GPU with a third of all rows in one day, many at one time, some values that decimals don't hold."""
    from devmetrics.operators import enrich

    rnd = random.Random(6)
    width = 600 * S
    data = []
    for i in range(1500):
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None])
        t = (rnd.choice([500, 40_000]) if i % 9 == 0 else rnd.randrange(3 * 86400)) * S if g != "hot" or i % 2 else rnd.randrange(20_000) * S
        v = rnd.choice([None, 0.1, 2.5, 1e-3, rnd.random(), rnd.random() * 1e5, *([1e9, 1e-30] if i % 50 == 0 else [])])
        data.append((i, g, "m", t, v))
    df = spark.createDataFrame(data, "persist_key long, gpu_id string, metric_name string, timestamp_ns long, value double")
    out = enrich.rolling_mean(df, width, 86400 * S, split_rows=split_rows)
    got = {r.persist_key: (r.rolling_mean, r.window_points) for r in out.collect()}
    assert len(got) == len(data) and out.columns == [*df.columns, "rolling_mean", "window_points"]
    for i, g, _, t, _ in data:
        inside = [x[4] for x in data if x[1] == g and t - width < x[3] <= t]
        values = [v for v in inside if v is not None]
        assert got[i][1] == len(inside)
        if not values:
            assert got[i][0] is None
        else:  # near 1e9 the double totals of a day are good to about 1e-6
            assert got[i][0] == pytest.approx(sum(values) / len(values), rel=1e-12, abs=1e-6 if any(v in (1e9, 1e-30) for v in values) else 0)


def test_rolling_mean_tasks(spark, monkeypatch):
    """One GPU with a third of all rows in one day: no staged group and no window holds a tenth of the rows."""
    from devmetrics.operators import enrich, sequence

    largest, real = [], sequence.bucketed

    def spied(*args, **kwargs):
        rows, summary = real(*args, **kwargs)
        largest.append(rows.groupBy("_kb").count().agg({"count": "max"}).first()[0])
        return rows, summary

    monkeypatch.setattr(sequence, "bucketed", spied)
    data = [(i, "hot" if i % 3 == 0 else f"g{i % 50}", "m", (i % 1000) * S + i, 1.0) for i in range(3000)]
    df = spark.createDataFrame(data, "persist_key long, gpu_id string, metric_name string, timestamp_ns long, value double")
    out = enrich.rolling_mean(df, 100 * S, 86400 * S, split_rows=100)
    assert {r.rolling_mean for r in out.collect()} == {1.0} and len(largest) == 2 and max(largest) < 300


def test_a_model_listed_twice(spark):
    from devmetrics.operators import enrich

    points = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "persist_key long, model_name string")
    tiers = spark.createDataFrame([("A", "gold"), ("A", "bronze"), ("A", "gold"), ("C", "x")], "model_name_csv string, tier string")
    got = {r.persist_key: r.tier for r in enrich.map_sla_tier(points, tiers).collect()}
    assert got == {1: "bronze", 2: "standard", 3: "standard"} and enrich.map_sla_tier(points, tiers).count() == 3


def test_running_sum_of_ties(spark):
    """Rows that tie on every order column: totals carried to later buckets are those of all rows."""
    from devmetrics.operators.sequence import running_sum

    df = spark.createDataFrame([(t // 4, 1) for t in range(200)], "t long, v long")
    out = running_sum(df, ["t"], "v", F.call_function("div", F.col("t"), F.lit(5)), "run").groupBy("t").agg(F.max("run").alias("m")).collect()
    assert {r.t: r.m for r in out} == {t: 4 * (t + 1) for t in range(50)}


def test_rolling_agg(spark, rows):
    width = 2 * 3600 * S
    df = spark.createDataFrame(rows, "id long, k string, t long, v double")
    out = rolling_agg(df, ["k"], "t", width, {"n": F.count(F.lit(1)), "s": F.sum("v")}, bucket_ns=3 * 3600 * S)
    got = {r.id: (r.n, r.s) for r in out.collect()}
    assert len(got) == len(rows)
    for r in rows:
        win = [x for x in rows if x[1] == r[1] and r[2] - width < x[2] <= r[2]]
        assert got[r[0]] == (len(win), sum(x[3] for x in win))


def test_asof_join(spark, rows):
    rnd = random.Random(5)
    right = [(k, rnd.randrange(0, 20 * 3600) * S, f"o{i}") for i, k in enumerate(["hot"] * 40 + ["a"] * 5)]
    left = spark.createDataFrame(rows, "id long, k string, t long, v double")
    r = spark.createDataFrame(right, "k string, from_t long, owner string")
    got = {x.id: x.owner for x in asof_join(left, r, ["k"], "t", "from_t", ["owner"], bucket_ns=3600 * S).collect()}
    for row in rows:
        cands = [x for x in right if x[0] == row[1] and x[1] <= row[2]]
        assert got[row[0]] == (max(cands, key=lambda x: x[1])[2] if cands else None)


def test_running_sum_two_levels_matches_brute_force(spark):
    from devmetrics.operators.sequence import running_sum

    rnd = random.Random(11)
    rows = [(i, rnd.choice(["p", "q", None]), rnd.randrange(0, 5000), rnd.randrange(-3, 4)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, part string, t long, v long")
    for sup in (None, F.call_function("div", F.col("t"), F.lit(1000))):
        for partition in ((), ("part",)):
            out = running_sum(df, ["t", "id"], "v", F.call_function("div", F.col("t"), F.lit(50)), "run",
                              partition=partition, super_bucket=sup)
            got = {r.id: r.run for r in out.collect()}
            acc = {}
            expected = {}
            for i, p, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
                k = p if partition else None
                acc[k] = acc.get(k, 0) + v
                expected[i] = acc[k]
            assert got == expected

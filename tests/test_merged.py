"""Merged tables: what a merge rewrites, what readers see, and cells held against the points themselves."""

import os
import random

import pytest
from pyspark.sql import functions as F

from devmetrics.functions.values import NS_PER_DAY as DAY
from devmetrics.functions.values import NS_PER_HOUR as HOUR
from devmetrics.functions.values import NS_PER_MINUTE as MINUTE
from devmetrics.operators import aggregates as agg
from devmetrics.sources.merged import MergedTable
from devmetrics.streaming import rollups

POINT = ("measurement string, gpu_id string, timestamp_ns long, tags map<string,string>, fields struct<metric_name:string,value:double>, "
         "persist_key long")


def _points(spark, rows):
    """rows: (gpu, time, value, sequence)"""
    return spark.createDataFrame([("m", g, t, {"gpu_id": g or "-"}, ("temp", v), k) for g, t, v, k in rows], POINT)


def _table(spark, tmp_dir):
    return rollups.points_table(f"{tmp_dir}/store", rollups.dated(_points(spark, [("a", 0, 0.0, 0)])).schema)


def _seen(df):
    return sorted((r.gpu_id, r.timestamp_ns, r.fields.value) for r in df.collect())


def _add(spark, table, n, rows):
    table.write_batch(rollups.dated(_points(spark, rows)), n)


def test_a_merge_rewrites_touched_days_only(spark, tmp_dir):
    table = _table(spark, tmp_dir)
    _add(spark, table, 0, [("a", d * DAY + i, 1.0, i) for d in range(5) for i in range(4)])
    assert len(table.merge_new(spark)) == 5
    before = table.manifest(spark).folders()
    _add(spark, table, 1, [("a", 2 * DAY + 1, 2.0, 0), ("b", 2 * DAY, 3.0, 1)])
    assert table.merge_new(spark) == ["measurement=m/date=1970-01-03"]
    after = table.manifest(spark).folders()
    assert {f for f in after if after[f] != before.get(f)} == {"measurement=m/date=1970-01-03"}
    want = {("a", d * DAY + i): 1.0 for d in range(5) for i in range(4)} | {("a", 2 * DAY + 1): 2.0, ("b", 2 * DAY): 3.0}
    assert _seen(table.read(spark)) == sorted((*k, v) for k, v in want.items())
    assert table.merge_new(spark) == []


@pytest.mark.parametrize("seed", [1])
def test_any_split_into_merges_gives_the_last_write(spark, tmp_dir, seed):
    """The last batch wins, within it the last sequence, whatever is merged and whatever is merged while reading."""
    rnd, table, want = random.Random(seed), _table(spark, tmp_dir), {}
    for n in range(6):
        rows = [(rnd.choice("ab"), rnd.randrange(3) * DAY + rnd.randrange(3), float(rnd.randrange(100)), k) for k in range(20)]
        _add(spark, table, n, rows)
        if rnd.random() < 0.3:
            _add(spark, table, n, rows)  # replayed
        want |= {(g, t): v for g, t, v, _ in rows}
        if rnd.random() < 0.5:
            table.merge_new(spark)
        assert _seen(table.read(spark)) == sorted((*k, v) for k, v in want.items())
    day = rollups.read_merged_points(spark, table, DAY, 2 * DAY, "m")
    assert _seen(day) == sorted((*k, v) for k, v in want.items() if DAY <= k[1] < 2 * DAY)


def test_a_crash_before_the_commit_leaves_the_old_view(spark, tmp_dir, monkeypatch):
    table = _table(spark, tmp_dir)
    _add(spark, table, 0, [("a", 1, 1.0, 0)])
    table.merge_new(spark)
    _add(spark, table, 1, [("a", 1, 2.0, 0)])

    def crash(self, files, manifest):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(MergedTable, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.merge_new(spark)
    assert _seen(table.read(spark, fresh=False)) == [("a", 1, 1.0)] and _seen(table.read(spark)) == [("a", 1, 2.0)]
    assert len(os.listdir(f"{tmp_dir}/store/merged")) >= 2
    old = table.manifest(spark).version
    assert table.merge_new(spark) and table.manifest(spark).version == old + 1
    table.vacuum(spark, keep=1)
    runs = [r for r in os.listdir(f"{tmp_dir}/store/merged") if r.startswith("run=")]
    assert runs == [f"run={r}" for r in set(table.manifest(spark).folders().values())]
    assert [b for b in os.listdir(f"{tmp_dir}/store/batches") if b.startswith("batch_id")] == []
    assert _seen(table.read(spark)) == [("a", 1, 2.0)]


def test_a_batch_cut_short_is_not_read_and_two_merges_do_not_both_commit(spark, tmp_dir):
    table = _table(spark, tmp_dir)
    _add(spark, table, 0, [("a", 1, 1.0, 0)])
    _add(spark, table, 1, [("a", 2, 1.0, 0)])
    os.remove(f"{tmp_dir}/store/batches/batch_id=1/_SUCCESS")
    assert _seen(table.read(spark)) == [("a", 1, 1.0)]
    from devmetrics.sources.merged import Manifest, _Files

    table.merge_new(spark)
    with pytest.raises(Exception, match="FileAlreadyExists|already exists"):
        table._commit(_Files(spark, table.path), Manifest(1, 7, {}))
    assert table.manifest(spark).upto == 0


def test_odd_partition_values(spark, tmp_dir):
    table = _table(spark, tmp_dir)
    names = ["a b", "x=1/y", "1", "50%", None]
    rows = _points(spark, [("a", 5, 1.0, 0)]).drop("measurement")
    for n, name in enumerate(names):
        table.write_batch(rollups.dated(rows.withColumn("measurement", F.lit(name).cast("string"))), n)
        if n % 2:
            table.merge_new(spark)
    assert {r.measurement for r in table.read(spark).collect()} == set(names)
    assert [r.measurement for r in table.read(spark, lambda v: v["measurement"] == "x=1/y").collect()] == ["x=1/y"]


def test_nothing_written_yet(spark, tmp_dir):
    table = _table(spark, tmp_dir)
    assert table.merge_new(spark) == [] and table.read(spark).collect() == []
    table.write_batch(rollups.dated(_points(spark, [])), 0)
    assert table.merge_new(spark) == [] and table.manifest(spark).upto == 0 and table.read(spark).collect() == []


# --- cells

def _random_points(seed, n=400, days=4):
    rnd = random.Random(seed)
    centres = [rnd.randrange(days * DAY) for _ in range(12)]
    return [(rnd.choice(["a", "a", "a", "b", None]), max(0, rnd.choice(centres) + rnd.randrange(-HOUR, HOUR)), rnd.gauss(0, 1), i) for i in range(n)]


def _filled(spark, table, cells, rows, batches=8):
    random.Random(0).shuffle(rows)
    for n in range(batches):
        table.write_batch(cells(_points(spark, rows[n::batches])), n)
        if n in (2, 5):
            table.merge_new(spark)
    return table


def _sorted(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_cover():
    rnd = random.Random(5)
    for _ in range(200):
        a = rnd.randrange(3 * DAY)
        b = a + rnd.choice([0, 1, MINUTE, rnd.randrange(5 * DAY)])
        cells, ends = rollups.cover(a, b, rollups.LEVELS)
        pieces = sorted([(x, y) for _, x, y in cells] + ends)
        assert all(x % rollups.LEVELS[name] == 0 == y % rollups.LEVELS[name] for name, x, y in cells)
        assert all(y - x < 2 * MINUTE for x, y in ends) and len(cells) <= 5 and len(ends) <= 2
        assert [p for x, y in pieces for p in (x, y)][1:-1:2] == [p for x, y in pieces for p in (x, y)][2::2]
        assert (pieces[0][0], pieces[-1][1]) == (a, b) if a < b else not pieces


@pytest.mark.parametrize("every", [15 * MINUTE, DAY])
def test_counts_equal_those_of_the_points(spark, tmp_dir, every):
    rows = _random_points(every)
    pts = _points(spark, rows).cache()
    table = _filled(spark, rollups.count_table(f"{tmp_dir}/c", {"gpu_id": "string"}), lambda p: rollups.count_cells(p, ["gpu_id"]), list(rows), 4)
    asked = []
    for a, b in [(DAY, 3 * DAY), (17 * HOUR + 12_345_678, 3 * DAY + 7 * HOUR + 61 * 10**9 + 5), (HOUR + 5, HOUR + 9)]:
        got = rollups.counted_windows(spark, table, lambda x, y: asked.append((x, y)) or pts, every, a, b, create_empty=every >= DAY)
        assert _sorted(got) == _sorted(agg.window_count(pts, every, a, b, create_empty=every >= DAY)), (a, b)
    assert all(y - x < MINUTE for x, y in asked)
    with pytest.raises(ValueError):
        rollups.counted_windows(spark, table, lambda x, y: pts, MINUTE + 1, 0, DAY)


@pytest.mark.parametrize("threshold", [MINUTE, HOUR])
def test_coverage_equals_the_batch_forms(spark, tmp_dir, threshold):
    rows = _random_points(threshold + 1)
    pts = _points(spark, rows).cache()
    table = rollups.coverage_table(f"{tmp_dir}/s", {"gpu_id": "string"}, threshold)
    _filled(spark, table, lambda p: rollups.coverage_spans(p, ["gpu_id"], threshold), list(rows))
    got = rollups.silences(spark, table, threshold).where("gpu_id IS NOT NULL")
    assert _sorted(got) == _sorted(agg.gpu_silences(pts, threshold, DAY))
    for a, b in [(0, 4 * DAY), (DAY + 3 * HOUR, 2 * DAY + 20 * HOUR)]:
        got = rollups.gaps(spark, table, threshold, HOUR, a, b)
        assert _sorted(got) == _sorted(agg.continuity_gaps(pts, HOUR, a, b))
    with pytest.raises(ValueError):
        rollups.gaps(spark, table, threshold, HOUR, 1, DAY)


def test_sketches(spark, tmp_dir):
    """Unions over hours and batches: within the stated errors of the exact results, and of one sketch of all points."""
    n = 60_000
    rows = spark.range(n).select(
        F.lit("m").alias("measurement"), F.concat(F.lit("g"), F.pmod(F.xxhash64("id"), F.lit(9000))).alias("gpu_id"),
        (F.col("id") * (2 * DAY // n)).alias("timestamp_ns"), F.struct(F.lit("temp").alias("metric_name"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**6)) / 7.0).alias("value")).alias("fields"))
    table = rollups.sketch_table(f"{tmp_dir}/k", {}, ["gpu_id"])
    cells = lambda p: rollups.sketch_cells(p, [], ["gpu_id"], F.col("fields.value"), HOUR)
    for b in range(4):
        table.write_batch(cells(rows.where(F.pmod(F.xxhash64("timestamp_ns"), F.lit(4)) == b)), b)
        if b == 1:
            table.merge_new(spark)
    for a, z in [(None, None), (5 * HOUR, 31 * HOUR)]:
        part = rows if a is None else rows.where((F.col("timestamp_ns") >= a) & (F.col("timestamp_ns") < z))
        values = sorted(r[0] for r in part.select("fields.value").collect())
        found = rollups.read_sketches(spark, table, HOUR, [], ["gpu_id"], a, z).select(
            "points", rollups.distinct_estimate("gpu_id").alias("d"), *[rollups.quantile_estimate(q).alias(f"q{q}") for q in (0.5, 0.95, 0.99)]).first()
        exact = part.agg(F.count_distinct("gpu_id")).first()[0]
        whole = part.agg(F.hll_sketch_estimate(F.hll_sketch_agg("gpu_id", rollups.HLL_LOG2))).first()[0]
        assert found.points == len(values) and abs(found.d - exact) <= exact * rollups.DISTINCT_ERROR
        assert abs(found.d - whole) <= exact * rollups.DISTINCT_ERROR  # the estimators of a sketch and of a union differ
        for q in (0.5, 0.95, 0.99):
            v = found[f"q{q}"]
            below, upto = sum(x < v for x in values), sum(x <= v for x in values)
            assert below <= (q + rollups.RANK_ERROR) * len(values) and upto >= (q - rollups.RANK_ERROR) * len(values)
    with pytest.raises(ValueError):
        rollups.read_sketches(spark, table, HOUR, [], ["gpu_id"], 1, HOUR)


def test_sketches_of_nothing(spark, tmp_dir):
    table = rollups.sketch_table(f"{tmp_dir}/k", {"gpu_id": "string"}, ["series_id"])
    rows = _points(spark, [("a", 1, None, 0), ("b", 2, 1.5, 1)]).withColumn("series_id", F.when(F.col("gpu_id") == "b", F.lit("s")))
    table.write_batch(rollups.sketch_cells(rows, ["gpu_id"], ["series_id"], F.col("fields.value"), HOUR), 0)
    found = rollups.read_sketches(spark, table, HOUR, ["gpu_id"], ["series_id"]).select(
        "gpu_id", rollups.distinct_estimate("series_id").alias("d"), rollups.quantile_estimate(0.5).alias("q")).collect()
    assert {tuple(r) for r in found} == {("a", 0, None), ("b", 1, 1.5)}

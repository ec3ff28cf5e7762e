"""Streams compared with the batch operators on the same input."""

import os

from pyspark.sql import functions as F

from devmetrics.sources.csv import read_metrics_csv, split_valid_rejects
from devmetrics.streaming import streams

HEADER = "recorded,metric,gpu,board,serial,maker,series,rev,form,room,reading,tags\n"


def test_csv_stream_matches_batch(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for f in range(3):
        with open(f"{tmp_dir}/in/part{f}.csv", "w") as fh:
            fh.write(HEADER)
            for i in range(20):
                v = "NaN" if i == 7 else f"{i}.5"
                fh.write(f"{f * 100 + i},temp,{i % 4},d,u,a,b,c,d,ns,{v},rack=r{f}\n")
            fh.write(f"{f * 100 + 99},short\n")
    stream = streams.read_metrics_csv_stream(spark, f"{tmp_dir}/in", "node-x", event_time="recorded",
                                             max_files_per_trigger=1)
    q = streams.start_batches(stream, streams.batch_dir_writer(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.select("batch_id").distinct().count() == 3
    batch = read_metrics_csv(spark, f"{tmp_dir}/in", "node-x", event_time="recorded")
    cols = ["timestamp_ns", "metric_name", "gpu_id", "value", "labels_raw", "reject_reason"]
    assert sorted(got.select(cols).collect()) == sorted(batch.select(cols).collect())
    _, rejects = split_valid_rejects(batch)
    assert rejects.count() == 6


def _out_of_order(spark, tmp_dir, n=4):
    """sf0.001 events as a folder of files in no order of time."""
    from tests.conftest import SF_SMALL

    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(n, F.xxhash64("event_id")).write.parquet(f"{tmp_dir}/events.parquet")
    return f"{tmp_dir}/events.parquet"


def test_table_stream_reads_files_and_folders(spark, tmp_dir):
    from tests.conftest import SF_SMALL

    path = _out_of_order(spark, tmp_dir)
    for source, batches in ((path, 4), (f"{SF_SMALL}/events.parquet", 1)):
        out = f"{tmp_dir}/out{batches}"
        q = streams.start_batches(streams.table_stream(spark, source, 1), streams.batch_dir_writer(out), f"{out}-ckpt")
        q.awaitTermination()
        got = spark.read.parquet(out)
        assert got.count() == spark.read.parquet(source).count() and got.select("batch_id").distinct().count() == batches


def test_replayed_counts_are_not_added(spark, tmp_dir):
    S = 10**9
    batch = spark.createDataFrame([("a", 5 * S), ("a", 6 * S), ("b", 15 * S)], "gpu_id string, timestamp_ns long")
    write = streams.window_count_writer(f"{tmp_dir}/counts", 10 * S)
    for n in (0, 1, 1):
        write(batch, n)
    got = streams.summed_window_counts(spark, f"{tmp_dir}/counts").collect()
    assert sorted((r.gpu_id, r.window_start_ns, r.window_end_ns, r.points) for r in got) == [("a", 0, 10 * S, 4), ("b", 10 * S, 20 * S, 2)]


def test_late_rows_go_to_the_side(spark, tmp_dir):
    S = 10**9
    rows = lambda *t: spark.createDataFrame([(x * S,) for x in t], "timestamp_ns long")
    write = streams.late_rows_writer(f"{tmp_dir}/side", "timestamp_ns", 60 * S)
    for n, df in enumerate((rows(100, 500), rows(450, 430, 900), rows(839, 841))):
        write(df, n)
    got = spark.read.parquet(f"{tmp_dir}/side/late").collect()
    assert sorted((r.batch_id, r.timestamp_ns // S) for r in got) == [(1, 430), (2, 839)]


def test_fan_out_and_replay_idempotent(spark, tmp_dir):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    writer = streams.fan_out_writer([streams.batch_dir_writer(f"{tmp_dir}/a"), streams.batch_dir_writer(f"{tmp_dir}/b")])
    writer(df, 0)
    writer(df, 0)  # a replayed batch overwrites its own folder
    for sink in ("a", "b"):
        assert spark.read.parquet(f"{tmp_dir}/{sink}").count() == 10


def test_ingest_csv_stream_end_to_end(spark, tmp_dir):
    from devmetrics.sources.points_store import read_points

    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w") as fh:
        fh.write(HEADER)
        fh.write("1704067200000000000,temp,0,d,u,A100,PCIe,,,ns,25.5,rack=r1\n")
        fh.write("1704153600000000000,temp,1,d,u,,,,,ns,NaN,\n")
        fh.write("1704153600000000001,util,1,d,u,,,,,ns,80,zone=z\n")
    q = streams.ingest_csv_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/store", f"{tmp_dir}/ckpt", "host-1",
                                  event_time="recorded", rejects_path=f"{tmp_dir}/rejects", available_now=True)
    q.awaitTermination()
    pts = read_points(spark, f"{tmp_dir}/store", measurement="gpu_metrics")
    got = {r.timestamp_ns: (r.gpu_id, r.model_name, r.source_node, r.date) for r in pts.collect()}
    assert got == {1704067200000000000: ("0", "A100,PCIe,,", "host-1", __import__("datetime").date(2024, 1, 1)),
                   1704153600000000001: ("1", ",,,", "host-1", __import__("datetime").date(2024, 1, 2))}
    assert [r.reject_reason for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()] == ["not finite"]
    from devmetrics.operators.points import upsert_points

    latest = upsert_points(pts.drop("date"), seq_col=["batch_id", "persist_key"])
    assert latest.count() == 2


def test_expired_pending_scan_interval(spark):
    from devmetrics.operators import ledger

    S = 10**9
    d = spark.createDataFrame([("m", 1, 5 * S)], "message_id string, persist_key long, sent_ns long")
    a = spark.createDataFrame([], "message_id string, ack_ns long")
    # Timed out at 35 s, but the first scan tick after that is 40 s.
    assert ledger.expired_pending(d, a, 36 * S, 30 * S).count() == 1
    assert ledger.expired_pending(d, a, 36 * S, 30 * S, scan_interval_ns=10 * S).count() == 0
    assert ledger.expired_pending(d, a, 40 * S, 30 * S, scan_interval_ns=10 * S).count() == 1


def test_write_points_stream_matches_batch(spark, tmp_dir):
    from devmetrics.operators.points import build_points
    from devmetrics.plans import fixtures as fx
    from devmetrics.sources.points_store import read_points
    from tests.conftest import SF_SMALL

    stream_pts = build_points(fx.telemetry_from_events(streams.table_stream(spark, f"{SF_SMALL}/events.parquet")))
    q = streams.write_points_stream(stream_pts.drop("tags"), f"{tmp_dir}/store", f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination()
    got = read_points(spark, f"{tmp_dir}/store", measurement="gpu_metrics")
    batch = build_points(fx.telemetry(spark, SF_SMALL))
    cols = ["persist_key", "timestamp_ns", "gpu_id", "series_id"]
    assert sorted(got.select(cols).collect()) == sorted(batch.select(cols).collect())


def test_dedup_across_micro_batches(spark, tmp_dir):
    schema = "series_id string, timestamp_ns long, metric_name string, value double"
    base = 1704067200 * 10**9
    spark.createDataFrame([("s1", base, "temp", 1.0)], schema).coalesce(1).write.parquet(f"{tmp_dir}/in/f1")
    spark.createDataFrame([("s1", base, "temp", 1.0), ("s1", base + 10**9, "temp", 2.0)], schema) \
        .coalesce(1).write.parquet(f"{tmp_dir}/in/f2")
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
           .parquet(f"{tmp_dir}/in"))
    out = streams.dedup_stream(src, watermark="10 minutes")
    q = streams.start_batches(out, streams.batch_dir_writer(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.select("batch_id").distinct().count() >= 2  # the copy arrived in a later micro-batch
    assert sorted((r.timestamp_ns, r.value) for r in got.collect()) == [(base, 1.0), (base + 10**9, 2.0)]


def test_micro_batches_are_dealt_over_the_cores(spark, tmp_dir):
    """Of a table of one split, too, every core gets rows in each of four micro-batches."""
    from devmetrics.plans import catalog

    cores = spark.sparkContext.defaultParallelism
    spark.range(256 * cores).withColumnRenamed("id", "event_id").coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    dealt, seen = catalog._events_stream(spark, tmp_dir, f"{tmp_dir}/base").withColumn("task", F.spark_partition_id()), []
    write = lambda batch, n: seen.append(batch.agg(F.count_distinct("task"), F.count("*")).first())
    streams.start_batches(dealt, write, f"{tmp_dir}/check").awaitTermination()
    assert [tasks >= cores for tasks, _ in seen] == [True] * 4
    assert sum(n for _, n in seen) == 256 * cores

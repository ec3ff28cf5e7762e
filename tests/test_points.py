"""Point building, upsert, pivot and response shapes on small hand-made messages."""

from pyspark.sql import functions as F

from devmetrics.operators import depth, ledger
from devmetrics.operators.points import (build_points, legacy_projection, pivot_fields, to_entries, unpivot_fields,
                                         upsert_points)

TEL = ("persist_key long, timestamp_ns long, metric_name string, gpu_id string, device string, uuid string, "
       "model_name array<string>, namespace string, value double, labels_raw string")


def test_point_of_a_message(spark):
    tel = spark.createDataFrame([(1, 1700000000000000000, "gpu_temp", "0", "nvidia0", "uuid-123", ["A100", "PCIe"],
                                  "ai-prod", 75.5, "rack=R1,zone=z2")], TEL)
    p = build_points(tel).first()
    assert p.measurement == "gpu_metrics" and p.timestamp_ns == 1700000000000000000
    assert dict(p.tags) == {"rack": "R1", "zone": "z2", "gpu_id": "0", "device": "nvidia0", "uuid": "uuid-123",
                            "namespace": "ai-prod", "modelName": "A100,PCIe"}
    assert (p.fields.metric_name, p.fields.value) == ("gpu_temp", 75.5)
    assert p.series_id == "device=nvidia0,gpu_id=0,modelName=A100,PCIe,namespace=ai-prod,rack=R1,uuid=uuid-123,zone=z2"


def test_stream_messages_with_zero_time_get_arrival_time(spark):
    tel = spark.createDataFrame([(1, 0, "gpu_temp", "0", "", "", [], "", 72.5, "host=node1"),
                                 (2, 0, "gpu_util", "1", "", "", [], "", 88.0, "host=node2")], TEL)
    rows = build_points(tel, arrival_ns=F.lit(1_800_000_000_000_000_000)).orderBy("persist_key").collect()
    assert [r.timestamp_ns for r in rows] == [1_800_000_000_000_000_000] * 2
    assert [dict(r.tags) for r in rows] == [{"host": "node1", "gpu_id": "0"}, {"host": "node2", "gpu_id": "1"}]


def test_queue_sample_message(spark):
    tel = spark.createDataFrame([(1, 5, "m", "gpu0", "nvidia0", "uuid-test", ["A100"], "ns", 42.0, "host=test")], TEL)
    assert dict(build_points(tel).first().tags) == {"host": "test", "gpu_id": "gpu0", "device": "nvidia0",
                                                   "uuid": "uuid-test", "namespace": "ns", "modelName": "A100"}


def test_upsert_last_write_wins(spark):
    rows = [(1, 10, "temp", "0", "d", "u", [], "", 1.0, ""),
            (2, 10, "temp", "0", "d", "u", [], "", 2.0, ""),   # same key, later write
            (3, 10, "util", "0", "d", "u", [], "", 3.0, ""),   # same series and time, other metric
            (4, 10, "temp", "1", "d", "u", [], "", 4.0, "")]   # other series
    p = build_points(spark.createDataFrame(rows, TEL))
    metric = {(r.gpu_id, r.fields.metric_name): r.fields.value for r in upsert_points(p, key="metric").collect()}
    assert metric == {("0", "temp"): 2.0, ("0", "util"): 3.0, ("1", "temp"): 4.0}
    influx = {r.gpu_id: (r.fields.metric_name, r.fields.value) for r in upsert_points(p, key="influx").collect()}
    assert influx == {"0": ("util", 3.0), "1": ("temp", 4.0)}  # the store's rule: the metric is a field


def test_pivot_roundtrip_and_entries(spark):
    rows = [(1, 10, "temp", "0", "d", "u", [], "", 1.5, "k=v"), (2, 20, "util", "0", "d", "u", [], "", None, "")]
    p = build_points(spark.createDataFrame(rows, TEL))
    long_rows = unpivot_fields(p)
    assert long_rows.count() == 4
    back = {r.persist_key: (r.metric_name, r.value) for r in pivot_fields(long_rows).collect()}
    assert back == {1: ("temp", 1.5), 2: ("util", None)}
    e = to_entries(p).orderBy("timestamp_ns").collect()
    assert e[0].asDict() == {"timestamp_ns": 10, "measurement": "gpu_metrics", "gpu_id": "0", "metric_name": "temp", "value": 1.5,
                             "entry": '{"timestamp_ns":10,"measurement":"gpu_metrics","metric_name":"temp","value":1.5,'
                                      '"device":"d","gpu_id":"0","k":"v","uuid":"u"}'}
    assert '"k"' not in e[1].entry and '"value"' not in e[1].entry
    legacy = legacy_projection(p).orderBy("timestamp_ns").collect()
    assert legacy[1].value == 0.0 and legacy[1].device == "d"  # missing value -> zero value


def test_recovery_of_all_unacked(spark):
    e = spark.createDataFrame([(k, k, "enqueued") for k in range(500)], "persist_key long, enqueued_ns long, outcome string")
    d = spark.createDataFrame([], "message_id string, persist_key long, sent_ns long")
    a = spark.createDataFrame([], "message_id string, ack_ns long")
    backlog = ledger.unacked(e, d, a, 30 * 10**9, 10 * 10**9)
    assert backlog.count() == 500
    pos = depth.fifo_order(backlog.select("persist_key"), bucket_keys=64)
    assert sorted((r.persist_key, r.position) for r in pos.collect()) == [(k, k + 1) for k in range(500)]


def test_entries_carry_tags_that_nobody_listed(spark):
    import json

    rows = [(1, 10, "temp", "0", "", "", [], "", 1.5, 'shelf=S9,"q"=x,measurement=own,zone=é'), (2, 11, "temp", "0", "", "", [], "", 2.0, "")]
    got = [json.loads(r.entry) for r in to_entries(build_points(spark.createDataFrame(rows, TEL))).orderBy("timestamp_ns").collect()]
    assert got[0] == {"timestamp_ns": 10, "measurement": "gpu_metrics", "metric_name": "temp", "value": 1.5, "gpu_id": "0",
                      "shelf": "S9", '"q"': "x", "zone": "é"}  # a label named like a fixed column gives way
    assert got[1] == {"timestamp_ns": 11, "measurement": "gpu_metrics", "metric_name": "temp", "value": 2.0, "gpu_id": "0"}


def test_widen_tags(spark):
    from devmetrics.operators.points import widen_tags

    rows = [(1, 10, "temp", "0", "d", "u", [], "", 1.5, "k=v"), (2, 20, "util", "1", "d", "u", [], "", 2.0, "z=1")]
    p = build_points(spark.createDataFrame(rows, TEL)).select("persist_key", "tags")
    w = widen_tags(p, ("k", "z"))
    assert w.columns == ["persist_key", "tags", "k", "z"]
    assert {r.persist_key: (r.k, r.z) for r in w.collect()} == {1: ("v", None), 2: (None, "1")}

"""CSV ingest with rejects, backlog JSON recovery, points store round trip."""

import os

from pyspark.sql import functions as F


from devmetrics.operators.points import build_points
from devmetrics.sources.backlog import read_backlog, write_backlog
from devmetrics.sources.csv import read_metrics_csv, split_valid_rejects
from devmetrics.sources.points_store import read_points, write_points

HEADER = "recorded,metric,gpu,board,serial,maker,series,rev,form,room,reading,tags\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_rows_and_rejects(spark, tmp_dir):
    lines = [
        "123,heat,g4,board7,id-a,L4,SXM,,,lab,31.25,row=7",
        "124,load,g5,board8,id-b,L4,SXM,,,lab,12.0,row=7",
        "125,draw,g6,board9,id-c,L4,SXM,,,lab,220.0,row=8",
        '126,q,3,d,u,a,b,c,d,ns,+.5,"k=""v"",z=1"',
        "127,w,4,d,u,a,b,c,d,ns,1e3,x=1,extra",
        "",
        "128,short,5",
        "129,nan,6,d,u,a,b,c,d,ns,NaN,",
        "130,abc,7,d,u,a,b,c,d,ns,abc,",
        "131,sp,8,d,u,a,b,c,d,ns, 10.5,",
        "132,big,9,d,u,a,b,c,d,ns,1e999,",
    ]
    _write(f"{tmp_dir}/in/m.csv", HEADER + "\n".join(lines) + "\n")
    rows = read_metrics_csv(spark, f"{tmp_dir}/in", source_node="host1", event_time="recorded")
    valid, rejects = split_valid_rejects(rows)
    v = {r.timestamp_ns: r for r in valid.collect()}
    assert sorted(v) == [123, 124, 125, 126, 127]
    assert v[123].model_name == ["L4", "SXM", "", ""] and v[123].labels_raw == "row=7,source_node=host1"
    assert v[126].labels_raw == 'k="v",z=1,source_node=host1' and v[126].value == 0.5
    assert v[127].value == 1000.0 and v[127].labels_raw == "x=1,source_node=host1"
    rj = {r.timestamp_ns: r.reject_reason for r in rejects.collect()}
    assert rj == {128: "incomplete record", 129: "not finite", 130: "invalid value", 131: "invalid value",
                  132: "invalid value"}
    # Every input row is either valid or rejected (the blank line is skipped).
    assert valid.count() + rejects.count() == 10


def _both(spark, tmp_dir, text):
    _write(f"{tmp_dir}/in/m.csv", HEADER + text)
    return [read_metrics_csv(spark, f"{tmp_dir}/in", "h", event_time="recorded", multi_line=m) for m in (False, True)]


def test_csv_long_quoted_field(spark, tmp_dir):
    big = "k=" + "v" * 1_000_000 + '""'
    for rows in _both(spark, tmp_dir, f'1,m,0,d,u,a,b,c,d,ns,1.0,"{big}"\n'):
        r = rows.first()
        assert r.reject_reason is None and r.labels_raw == big.replace('""', '"') + ",source_node=h"


def test_csv_control_characters_are_kept(spark, tmp_dir):
    for rows in _both(spark, tmp_dir, "1,m,0,d,u,a,b,c,d,ns,1.0,a\u0001b\u0002c\n"):
        assert [(r.labels_raw, r.reject_reason) for r in rows.collect()] == [("a\u0001b\u0002c,source_node=h", None)]


def test_csv_quoted_line_feed(spark, tmp_dir):
    text = '1,m,0,d,u,a,b,c,d,ns,1.0,"k=v\nz=1"\n2,m,0,d,u,a,b,c,d,ns,2.0,x=1\n3,short\n4,m,0,d,u,a,b,c,d,ns,4.0,y,more,"q\nr"\n'
    by_line, by_record = _both(spark, tmp_dir, text)
    got = sorted((r.timestamp_ns or 0, r.labels_raw, r.reject_reason) for r in by_record.collect())
    assert got == [(1, "k=v\nz=1,source_node=h", None), (2, "x=1,source_node=h", None), (3, ",source_node=h", "incomplete record"),
                   (4, "y,source_node=h", None)]
    # by line, no part of a broken record passes as a message
    bad = {r.reject_reason for r in by_line.where("timestamp_ns is null or timestamp_ns in (1, 4)").collect()}
    assert bad == {"unclosed quote"}
    assert [r.timestamp_ns for r in by_line.where("reject_reason is null").collect()] == [2]
    assert by_line.where("reject_reason = 'unclosed quote' and value is not null").count() == 0


def test_csv_headers_of_many_files(spark, tmp_dir):
    for i in range(3):
        _write(f"{tmp_dir}/in/m{i}.csv", HEADER + f"{i},m,0,d,u,a,b,c,d,ns,1.0,x=1\n")
    rows = read_metrics_csv(spark, f"{tmp_dir}/in", "h", event_time="recorded")
    assert sorted((r.timestamp_ns, r.reject_reason) for r in rows.collect()) == [(i, None) for i in range(3)]


def test_backlog_zero_values_and_repeated_keys(spark, tmp_dir):
    _write(f"{tmp_dir}/backlog/a.json", '{"metric_name": "m"}\n{"persist_key": 3, "value": 1.5}\n{"persist_key": 3, "value": 1.5}\n{}\n')
    got = read_backlog(spark, f"{tmp_dir}/backlog", with_position=True).collect()
    assert sorted((r.persist_key, r.position, r.timestamp_ns, r.value, r.metric_name) for r in got if r.persist_key) == [
        (3, 3, 0, 1.5, ""), (3, 4, 0, 1.5, "")]
    assert sorted((r.position, r.value) for r in got if not r.persist_key) == [(1, 0.0), (2, 0.0)]
    assert sorted(r.metric_name for r in got if not r.persist_key) == ["", "m"]


def test_csv_arrival_time(spark, tmp_dir):
    _write(f"{tmp_dir}/in/m.csv", HEADER + "1,temp,0,d,u,a,b,c,d,ns,1.0,\n")
    r = read_metrics_csv(spark, f"{tmp_dir}/in", source_node="h").first()
    assert r.timestamp_ns > 1_700_000_000 * 10**9 and r.labels_raw == ",source_node=h"


def test_backlog_skips_corrupt(spark, tmp_dir):
    good = [(k, k * 10, "m", "g", "d", "u", ["A100"], "ns", 42.0, "host=test") for k in range(1, 6)]
    df = spark.createDataFrame(good, "persist_key long, timestamp_ns long, metric_name string, gpu_id string, "
                                     "device string, uuid string, model_name array<string>, namespace string, "
                                     "value double, labels_raw string")
    write_backlog(df, f"{tmp_dir}/backlog")
    _write(f"{tmp_dir}/backlog/zz-corrupt.json",
           '{"persist_key": 9, "timestamp": \n{"persist_key": 10, "timestamp": 1, "value": "high"}\n')
    back = read_backlog(spark, f"{tmp_dir}/backlog")
    assert sorted(r.persist_key for r in back.collect()) == [1, 2, 3, 4, 5]
    assert back.where("persist_key = 3").first().model_name == ["A100"]
    ordered = read_backlog(spark, f"{tmp_dir}/backlog", with_position=True)
    assert sorted((r.persist_key, r.position) for r in ordered.collect()) == [(k, k) for k in range(1, 6)]


def test_points_store_prunes_dates(spark, tmp_dir):
    day = 86400 * 10**9
    base = 1704067200 * 10**9
    tel = spark.createDataFrame(
        [(k, base + k * day // 2, "temp", str(k % 3), "d", "u", [], "ns", float(k), "") for k in range(10)],
        "persist_key long, timestamp_ns long, metric_name string, gpu_id string, device string, uuid string, "
        "model_name array<string>, namespace string, value double, labels_raw string")
    write_points(build_points(tel), f"{tmp_dir}/store", partitions=3)
    got = read_points(spark, f"{tmp_dir}/store", base + day, base + 3 * day, "gpu_metrics")
    assert sorted(r.persist_key for r in got.collect()) == [2, 3, 4, 5]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan
    # only the days of the range are listed: two folders of five
    assert len({f.split("date=")[1][:10] for f in got.inputFiles()}) == 2
    assert read_points(spark, f"{tmp_dir}/store", base + 90 * day, base + 91 * day, "gpu_metrics").count() == 0


def test_csv_failfast_mode(spark, tmp_dir):
    import pytest

    _write(f"{tmp_dir}/ok/m.csv", HEADER + "1,temp,0,d,u,a,b,c,d,ns,1.0,\n")
    assert read_metrics_csv(spark, f"{tmp_dir}/ok", "h", event_time="recorded", mode="failfast").count() == 1
    _write(f"{tmp_dir}/bad/m.csv", HEADER + "1,temp,0,d,u,a,b,c,d,ns,1.0,\n2,short\n")
    with pytest.raises(Exception, match="incomplete record"):
        read_metrics_csv(spark, f"{tmp_dir}/bad", "h", event_time="recorded", mode="failfast").collect()


def test_compaction_keeps_last_write(spark, tmp_dir):
    from devmetrics.sources.points_store import compact_points
    from devmetrics.streaming.streams import batch_dir_writer

    base = 1704067200 * 10**9
    schema = ("persist_key long, timestamp_ns long, metric_name string, gpu_id string, device string, uuid string, "
              "model_name array<string>, namespace string, value double, labels_raw string")
    first = spark.createDataFrame([(1, base, "temp", "0", "d", "u", [], "ns", 1.0, "")], schema)
    again = spark.createDataFrame([(1, base, "temp", "0", "d", "u", [], "ns", 2.0, ""),   # redelivered, corrected
                                   (2, base, "util", "0", "d", "u", [], "ns", 5.0, "")], schema)
    from devmetrics.functions.values import ns_to_utc_date

    w = batch_dir_writer(f"{tmp_dir}/store", ("measurement", "date"))
    for batch_id, df in enumerate([first, again]):
        w(build_points(df).withColumn("date", ns_to_utc_date(F.col("timestamp_ns"))), batch_id)
    assert spark.read.parquet(f"{tmp_dir}/store").count() == 3
    compact_points(spark, f"{tmp_dir}/store", f"{tmp_dir}/compacted")
    got = {r.fields.metric_name: r.fields.value for r in read_points(spark, f"{tmp_dir}/compacted").collect()}
    assert got == {"temp": 2.0, "util": 5.0}

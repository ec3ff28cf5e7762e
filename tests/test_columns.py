"""Scalar column functions against the reference's unit cases (labels, tags, values, times, identifiers, retry)."""

import pytest
from pyspark.sql import functions as F

from devmetrics.functions.labels import build_tags, parse_labels
from devmetrics.functions.times import check_identifier, parse_rfc3339_ns, rfc3339_to_ns, time_range_ns
from devmetrics.functions.values import (backoff_bound_ms, is_retryable, is_safe_identifier, ns_to_utc_date,
                                         parse_value)

LABEL_CASES = [
    ("row=7,hall=north", {"row": "7", "hall": "north"}),
    ("", {}),
    ("  row = 7 ,  hall= north ", {"row": "7", "hall": "north"}),
    ("spare", {"spare": ""}),
    ("b=1,a=x,b=2,c,a=,b=3,c=9", {"b": "3", "a": "", "c": "9"}),
    ("a=1,,b=2", {"a": "1", "b": "2"}),
    ("a=1,a=2", {"a": "2"}),
    ("a=b=c", {"a": "b=c"}),
    ("=v", {}),
    ("\tk = v\t,z=1", {"k": "v", "z": "1"}),
    ('k="v",z=1', {"k": '"v"', "z": "1"}),
]


def test_parse_labels(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LABEL_CASES)], "i int, t string")
    got = {r.i: dict(r.m) for r in df.select("i", parse_labels(F.col("t")).alias("m")).collect()}
    for i, (_, expected) in enumerate(LABEL_CASES):
        assert got[i] == expected, LABEL_CASES[i][0]


def test_many_labels_with_repeats(spark):
    """100,000 labels, each key twice: the last values, in seconds."""
    import time

    text = ",".join(f"k{i % 50_000}={i}" for i in range(100_000))
    df = spark.createDataFrame([(text,)], "t string")
    began = time.perf_counter()
    got = df.select(parse_labels(F.col("t")).alias("m")).select(F.size("m").alias("n"), F.element_at("m", "k7").alias("v")).first()
    assert (got.n, got.v) == (50_000, "50007") and time.perf_counter() - began < 30


def test_parse_labels_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert dict(df.select(parse_labels(F.col("t")).alias("m")).first().m) == {}


def test_build_tags_precedence(spark):
    df = spark.createDataFrame(
        [("row=7,hall=n", "g4", "board7", "id-a", "lab", ["L4", "SXM"]),
         ("gpu_id=label_gpu,namespace=from_label", "", "d", "u", "", []),
         ("", "1", "", "", "", ["", "", "", ""])],
        "labels string, gpu string, device string, uuid string, ns string, models array<string>",
    )
    tags = df.select(build_tags(parse_labels(F.col("labels")), F.col("gpu"), F.col("device"), F.col("uuid"),
                                F.col("ns"), F.col("models")).alias("t")).collect()
    assert dict(tags[0].t) == {"row": "7", "hall": "n", "gpu_id": "g4", "device": "board7", "uuid": "id-a",
                               "namespace": "lab", "modelName": "L4,SXM"}
    # An empty column leaves the same-named label standing; an empty model list adds no modelName.
    assert dict(tags[1].t) == {"gpu_id": "label_gpu", "namespace": "from_label", "device": "d", "uuid": "u"}
    # Four empty model names still join (the list is not empty).
    assert dict(tags[2].t) == {"gpu_id": "1", "modelName": ",,,"}


@pytest.mark.parametrize("text,ok", [
    ("10.5", True), ("+.5", True), ("1e3", True), ("-2.5E-3", True),
    ("NaN", False), ("abc", False), (" 10.5", False), ("1d", False), ("1e999", False), ("inf", False),
    ("", False), ("0x1p-2", False),
])
def test_parse_value(spark, text, ok):
    v = spark.createDataFrame([(text,)], "t string").select(parse_value(F.col("t")).alias("v")).first().v
    assert (v is not None) == ok


def test_rfc3339_column_and_driver(spark):
    cases = [
        ("2024-03-01T00:30:00Z", 1709253000 * 10**9),
        ("2024-03-01T00:30:00+03:45", 1709239500 * 10**9),
        ("2024-03-01T00:30:00.000000042Z", 1709253000 * 10**9 + 42),
        ("2024-03-01 00:30:00", None),
        ("yesterday", None),
        ("2024-02-30T00:30:00Z", None),
        ("2024-03-01T00:30:00", None),
    ]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = {r.t: r.ns for r in df.select("t", parse_rfc3339_ns(F.col("t")).alias("ns")).collect()}
    for text, expected in cases:
        assert got[text] == expected, text
        if expected is None:
            with pytest.raises(ValueError):
                rfc3339_to_ns(text)
        else:
            assert rfc3339_to_ns(text) == expected
    default = 1767225600 * 10**9  # 2026-01-01T00:00:00Z
    assert rfc3339_to_ns("", default) == default


def test_time_range_rules():
    now = 1767225600 * 10**9
    assert time_range_ns(None, None, now, 3600 * 10**9) == (now - 3600 * 10**9, now)
    with pytest.raises(ValueError):
        time_range_ns("2026-01-02T00:00:00Z", "2026-01-01T00:00:00Z", now, 1)
    with pytest.raises(ValueError):
        time_range_ns("2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z", now, 1)
    with pytest.raises(ValueError):
        time_range_ns("bad-time", None, now, 1)


SAFE = ["gpu0", "gpu_id_1", "gpu-001", "node1.local:0"]
UNSAFE = ["", '0" or "1"="1', '0") |> drop()', "gpu 0", "gpu@0", "gpu/0", "gpu0\n", "gpuÀ"]


def test_safe_identifier(spark):
    df = spark.createDataFrame([(s,) for s in SAFE + UNSAFE] + [(None,)], "s string")
    got = {r.s: r.ok for r in df.select("s", is_safe_identifier(F.col("s")).alias("ok")).collect()}
    assert all(got[s] for s in SAFE)
    assert not any(got[s] for s in UNSAFE)
    assert got[None] is False
    for s in SAFE:
        assert check_identifier(s) == s
    for s in UNSAFE:
        with pytest.raises(ValueError):
            check_identifier(s)


def test_retry_rules(spark):
    codes = ["ResourceExhausted", "Unavailable", "DeadlineExceeded", None, "InvalidArgument", "NotFound", "error"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r.r for r in df.select(is_retryable(F.col("c")).alias("r")).collect()]
    assert got == [True, True, True, False, False, False, False]
    b = spark.range(10).select(backoff_bound_ms(F.col("id"), 100, 2, 1000).alias("b")).collect()
    assert [r.b for r in b] == [100, 200, 400, 800, 1000, 1000, 1000, 1000, 1000, 1000]


def test_utc_date_is_zone_independent(spark):
    # 2024-01-01T03:00:00Z is still 2023-12-31 in New York (the session zone of these tests).
    d = spark.range(1).select(ns_to_utc_date(F.lit(1704078000 * 10**9)).alias("d")).first().d
    assert str(d) == "2024-01-01"


def test_ns_from_timestamp_ntz_ignores_daylight_saving(spark):
    from devmetrics.functions.values import ns_from_timestamp_ntz

    # July is daylight-saving time in the session zone (America/New_York); the result must still be UTC-based.
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:34:56.123456' AS ts, TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS old")
    r = df.select(ns_from_timestamp_ntz(F.col("ts")).alias("a"), ns_from_timestamp_ntz(F.col("old")).alias("b")).first()
    assert r.a == 1719837296123456000
    assert r.b == -500_000_000


def test_cluster_settings_for_100_tb():
    from devmetrics.session import cluster_settings

    s = cluster_settings(100 * 1024**4, total_cores=4000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409_600  # 100 TiB / 256 MiB
    assert cluster_settings(10 * 1024**3, total_cores=4000)["spark.sql.shuffle.partitions"] == "12000"
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_arrival_stamp_and_time_resolution(spark):
    from devmetrics.functions.values import ns_to_timestamp, resolve_time
    from devmetrics.sources.csv import stamp_arrival

    df = spark.range(1000).select(F.col("id").alias("timestamp_ns"))
    stamped = stamp_arrival(df)
    # One arrival value per query evaluation (B5), in ns, recent.
    vals = {r.timestamp_ns for r in stamped.collect()}
    assert len(vals) == 1 and next(iter(vals)) > 1_700_000_000 * 10**9
    r = spark.createDataFrame([(0,), (123,)], "t long").select(
        resolve_time(F.col("t"), F.lit(999)).alias("r")).collect()
    assert [x.r for x in r] == [999, 123]  # B11: zero means now
    # Ns -> microsecond timestamp, flooring (also before 1970).
    ts = spark.createDataFrame([(1_500,), (-1_500,)], "ns long").select(
        F.unix_micros(ns_to_timestamp(F.col("ns"))).alias("us")).collect()
    assert [x.us for x in ts] == [1, -2]

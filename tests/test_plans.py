"""Physical-plan guards for scale: what every registered batch query may and may not contain."""

import re

import pytest

from devmetrics.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

# Queries that run a stream or write files while being built; their final plan is a plain file scan.
EAGER = {"stream_ingest", "stream_dedup", "stream_window_count", "stream_ack_timeout", "csv_ingest",
         "backlog_roundtrip", "points_store_read", "stream_csv_ingest", "stream_csv_to_store", "stream_stats",
         "stream_open_deliveries", "stream_first_copies", "compacted_points", "rollup_window_count", "rollup_total_count",
         "coverage_silences", "coverage_gaps", "sketched_series", "sketched_quantiles"}
BATCH = sorted(set(QUERIES) - EAGER)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def _window_specs(plan: str) -> list[str]:
    # "Window [...], [partition cols], [order cols]" -> the partition list of each Window node
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)


@pytest.mark.parametrize("name", ["rolling_mean", "derivative", "gpu_silences", "attach_owner", "queue_depth",
                                  "fifo_order", "high_water"])
def test_ordered_operators_split_hot_keys(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    specs = _window_specs(plan)
    assert specs, plan
    # Windows over rows are partitioned by the (key, time bucket) struct `_kb` (or `_bucket` in the rolling window);
    # any other window runs over per-bucket summaries (key only, or unpartitioned for the prefix sum over bucket
    # totals), which are aggregated first.
    def splits(spec):
        return "_kb" in spec or "_bucket" in spec

    for spec in specs:
        if not splits(spec):
            assert "_tot" in plan or "_last" in plan, (name, spec)
    assert any(splits(s) for s in specs), (name, specs)


# (window_count and continuity_gaps stage their small aggregated counts; the pushed filter is in the staging job.)
@pytest.mark.parametrize("name", ["telemetry_by_gpu", "telemetry_by_gpu_closed", "list_gpus", "window_count_nonempty",
                                  "retention", "count_recent", "points_around"])
def test_time_range_reaches_the_scan(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*(GreaterThanOrEqual|LessThanOrEqual)\(ts,", plan), name


def _scan_columns(plan: str) -> list[list[str]]:
    return [[c.split("#")[0] for c in m.split(",")] for m in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_scan_reads_only_needed_columns(spark):
    # Dispatches need the key, time, metric and k (for redelivery); never the value or the user.
    for cols in _scan_columns(_plan(QUERIES["deliveries"](spark, SF_SMALL))):
        assert "value" not in cols and "event_id" in cols
    # The GPU list needs ids and labels only; the value column is never read.
    for cols in _scan_columns(_plan(QUERIES["list_gpus"](spark, SF_SMALL))):
        assert "value" not in cols


@pytest.mark.parametrize("name", ["queue_depth", "fifo_order"])
def test_only_super_bucket_totals_meet_in_one_task(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = _plan(QUERIES[name](spark, SF_SMALL)).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles, "expected the prefix over super-bucket totals"
    for i in singles:
        assert "HashAggregate(keys=[_super" in lines[i + 1], lines[i + 1]


@pytest.mark.parametrize("name", BATCH)
def test_outputs_are_flat_scalars(spark, name):
    from pyspark.sql.types import ArrayType, MapType, StructType

    schema = QUERIES[name](spark, SF_SMALL).schema
    nested = [f.name for f in schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    assert nested == [], f"{name}: nested output columns {nested}"


def _counts(spark, name) -> dict[str, int]:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return {"scans": plan.count("FileScan parquet"), "shuffles": plan.count("Exchange hashpartitioning"),
            "windows": len(re.findall(r"Window \[", plan)), "joins": len(re.findall(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)", plan))}


def test_passes_of_the_ledger_queries(spark):
    """Each table once: one shuffle by message, one by key. The ordered match of acks with their sending is a window
    (its running columns are one or two nodes over one sort)."""
    for name in ("queue_counters", "at_least_once_audit"):
        c = _counts(spark, name)
        assert c["scans"] <= 3 and c["shuffles"] <= 2 and c["joins"] == 0 and c["windows"] <= 2, (name, c)
    assert _counts(spark, "dead_letters")["shuffles"] <= 2
    for name in ("match_acks", "effective_acks", "ack_classes", "unknown_acks", "late_acks", "expired_pending", "requeue_time"):
        c = _counts(spark, name)
        assert c["scans"] <= 2 and c["shuffles"] == 1 and c["joins"] == 0, (name, c)
    c = _counts(spark, "unacked")
    assert c["scans"] <= 3 and c["joins"] == 1, c


def test_depth_has_one_window_over_events(spark):
    plan = _plan(QUERIES["queue_depth"](spark, SF_SMALL))
    over_rows = [s for s in _window_specs(plan) if "_kb" in s]
    assert len(over_rows) == 1, over_rows


def test_sender_queries_have_no_self_join(spark):
    assert _counts(spark, "sender_rollup")["joins"] == 0 and _counts(spark, "sender_rollup")["windows"] == 1
    c = _counts(spark, "retryable")
    assert c["windows"] == 0 and c["joins"] == 0

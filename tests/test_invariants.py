"""Invariants over the registered queries on the driver's sf0.01 tables."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def q(spark):
    qs = entry_mod.queries()
    return lambda name: qs[name](spark, SF_CHECK)


def test_acked_plus_unacked_is_accepted(q):
    audit = {r.check: r.value for r in q("at_least_once_audit").collect()}
    assert audit["effective_acked"] + audit["missing"] == audit["accepted"]
    assert audit["unique_acked"] >= audit["effective_acked"]
    assert audit["missing"] == q("unacked").count()
    assert audit["dispatches"] >= audit["dispatched_keys"]


def test_counters_are_consistent(q):
    c = {r.counter: r.value for r in q("queue_counters").collect()}
    assert c["acked"] + c["requeued"] + c["pending"] == c["dispatched"]
    assert c["queue"] == c["enqueued"] - c["dispatched"] + c["requeued"]
    classes = {r.ack_class: r.acks for r in q("ack_classes").collect()}
    assert sum(classes.values()) == 10_610 and classes["unknown"] == q("unknown_acks").count()
    assert classes["effective"] == q("effective_acks").count() == q("requeue_time").where("acked_in_time").count()
    assert classes["late"] == q("late_acks").count()


def test_every_ingested_row_is_valid_or_rejected(q):
    rows = q("csv_ingest")
    assert rows.count() == 10_000
    assert rows.where("reject_reason IS NULL AND value IS NULL").count() == 0
    assert rows.where("reject_reason IS NOT NULL AND value IS NOT NULL").count() == 0


def test_depth_never_negative_and_ends_balanced(q):
    d = q("queue_depth")
    assert d.where("depth < 0").count() == 0
    accepts = d.where("kind = 'accept'").count()
    pops = d.where("kind = 'dispatch'").count()
    last = d.orderBy("event_ns", "delta", "persist_key", "kind", ascending=False).first()
    assert last.depth == accepts - pops


def test_fixture_figures(q):
    # Values listed in FIXTURES.md section 1.2 (sf0.01), computed there from the same view definitions.
    assert q("list_gpus").count() == 151
    assert q("telemetry_by_gpu").count() == 30
    assert q("distinct_source_nodes").count() == 8
    m = q("match_acks")
    assert m.where("on_time").count() == 4217 and m.where("NOT on_time").count() == 5389
    assert m.where("latency_ns = 30000000000").count() == 80
    assert q("requeue_time").where("acked_in_time").count() == 4559
    assert q("unknown_acks").count() == 100
    assert q("invalid_acks").count() == 20
    assert q("unacked").count() == 5296
    assert q("dead_letters").count() == 1735
    assert q("sink_rollup").first().processed == 10_464
    assert q("expired_pending").count() == 3782
    assert q("deliveries").where("deliveries = 2").count() == 3618
    assert q("queue_depth").agg({"depth": "max"}).first()[0] == 28
    s = {r.outcome: r.messages for r in q("sender_totals").collect()}
    assert s["sent"] == 5525 and sum(s.values()) == 14743


def test_asof_owner_figure_on_raw_gpu_id(spark):
    from devmetrics.functions.values import NS_PER_DAY
    from devmetrics.operators.enrich import attach_owner
    from devmetrics.plans import fixtures as fx

    tel = fx.telemetry(spark, SF_CHECK).select("persist_key", "gpu_id", "timestamp_ns")
    owned = attach_owner(tel, fx.assignments(spark, SF_CHECK), bucket_ns=NS_PER_DAY)
    assert owned.where("owner IS NOT NULL").count() == 9792


def test_upsert_key_figures_on_raw_gpu_id(spark):
    from pyspark.sql import functions as F

    from devmetrics.functions.values import NS_PER_HOUR, truncate_ns
    from devmetrics.operators.points import upsert_points
    from devmetrics.plans import fixtures as fx

    tel = fx.telemetry(spark, SF_CHECK)
    pts = tel.select("persist_key", F.lit("gpu_metrics").alias("measurement"),
                     truncate_ns(F.col("timestamp_ns"), NS_PER_HOUR).alias("timestamp_ns"),
                     F.create_map(F.lit("gpu_id"), F.col("gpu_id")).alias("tags"),
                     F.struct("metric_name", "value").alias("fields"))
    assert upsert_points(pts, key="influx").count() == 9572
    assert upsert_points(pts, key="metric").count() == 9910

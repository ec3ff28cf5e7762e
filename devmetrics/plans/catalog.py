"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole driver tables. Those that write
and read back (sources, sinks, streams) or stage a small aggregate run jobs while they are built; the others are lazy.

Outputs are flat scalar columns (times as LONG ns, counts as LONG) so they compare value for value with the DuckDB
oracles in ``devmetrics.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devmetrics.functions.labels import parse_labels, series_key, tag_value
from devmetrics.functions.times import parse_rfc3339_ns
from devmetrics.functions.values import (NS_PER_DAY, NS_PER_HOUR, NS_PER_MINUTE, backoff_bound_ms, is_retryable,
                                         is_safe_identifier, parse_value, truncate_ns, value_reject_reason)
from devmetrics.operators import aggregates as agg
from devmetrics.operators import depth, enrich, ledger, reads, sender
from devmetrics.operators.points import build_points, pivot_fields, series_id, sorted_tags, unpivot_fields, upsert_points, widen_tags
from devmetrics.plans import params as P
from devmetrics.session import scratch_path
from devmetrics.streaming import carried, rollups, streams
from devmetrics.plans import fixtures as fx
from devmetrics.sources.backlog import read_backlog, write_backlog
from devmetrics.sources.csv import quote_csv_field, read_metrics_csv, stamp_arrival
from devmetrics.sources.points_store import read_points, write_points

IDENTITY_TAGS = ("gpu_id", "device", "uuid", "namespace", "modelName")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def points(spark: SparkSession, sf_dir: str, start_ns: int | None = None, stop_ns: int | None = None) -> DataFrame:
    """Points of the driver's events; a known time range is pushed to the scan (the read operators still apply the
    exact ns range)."""
    return build_points(fx.telemetry(spark, sf_dir, start_ns, stop_ns))


@query
def telemetry_by_gpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 flagship: one GPU's points in [start, end), last write wins, open response rows."""
    return reads.telemetry_by_gpu(points(spark, sf_dir, P.START_NS, P.END_NS), P.FLAGSHIP_GPU, P.FLAGSHIP_START, P.FLAGSHIP_END)


@query
def list_gpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct effective GPU ids of the last 30 days."""
    return reads.list_gpus(points(spark, sf_dir, P.NOW_NS - 30 * NS_PER_DAY, P.NOW_NS), P.NOW_NS, days=30)


# --- reads, tags, points -------------------------------------------------------------------------------------------

@query
def telemetry_by_gpu_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B17 + B26 + F1: legacy read, inclusive optional range, five fixed columns."""
    return reads.telemetry_by_gpu_closed(points(spark, sf_dir, P.START_NS, P.END_NS + 1), P.FLAGSHIP_GPU,
                                         P.FLAGSHIP_START, P.FLAGSHIP_END)


@query
def labels_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every parsed label of every message (repeated keys resolved, last wins)."""
    t = fx.telemetry(spark, sf_dir)
    return t.select("persist_key", F.explode(parse_labels(F.col("labels_raw"))).alias("label_key", "label_value"))


@query
def tags_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 + B30: all effective tags of every point, as JSON in the order of their keys, plus the series text."""
    p = points(spark, sf_dir)
    return p.select("persist_key", F.to_json(sorted_tags(F.col("tags"))).alias("tags"), "series_id")


@query
def tags_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen label keys as columns (null when absent)."""
    return widen_tags(points(spark, sf_dir), ("k", "flag", "expr")).select("persist_key", "k", "flag", "expr")


def _hourly_identity_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points restamped to the hour and tagged only with the GPU identity tags, so that writes collide.

    The identity tags are the promoted tag columns, so the restricted map is built from them directly and the full
    tag map is never computed (Catalyst prunes it)."""
    p = points(spark, sf_dir)
    promoted = {"gpu_id": "gpu_id", "device": "device", "uuid": "uuid", "namespace": "namespace",
                "modelName": "model_name"}
    ident = F.map_filter(F.create_map(*[x for k in IDENTITY_TAGS for x in (F.lit(k), F.col(promoted[k]))]),
                         lambda k, v: v.isNotNull())
    return p.select("persist_key", "measurement",
                    truncate_ns(F.col("timestamp_ns"), NS_PER_HOUR).alias("timestamp_ns"),
                    ident.alias("tags"), "fields")


def _upsert_output(df: DataFrame) -> DataFrame:
    return df.select(
        *[tag_value(F.col("tags"), k).alias(k) for k in IDENTITY_TAGS], "timestamp_ns",
        F.col("fields.metric_name").alias("metric_name"), F.col("fields.value").alias("value"), "persist_key",
    )


@query
def upsert_influx_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9, literal store rule: one point per (measurement, tag set, time), last write wins."""
    return _upsert_output(upsert_points(_hourly_identity_points(spark, sf_dir), key="influx"))


@query
def upsert_metric_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9, default rule: the key also holds the metric name."""
    return _upsert_output(upsert_points(_hourly_identity_points(spark, sf_dir), key="metric"))


@query
def pivot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B24 then B23: points -> one row per field -> one row per point again (no loss, typed values)."""
    p = points(spark, sf_dir)
    back = pivot_fields(unpivot_fields(p))
    return back.select("persist_key", "timestamp_ns", "metric_name", "value", series_id(F.col("tags")).alias("series_id"))


@query
def fields_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's long shape, one row per point and field, typed value columns."""
    long_rows = unpivot_fields(points(spark, sf_dir))
    return long_rows.select("persist_key", "timestamp_ns", "_field", "_value_string", "_value_double")


# --- counts, windows, gaps, retention -------------------------------------------------------------------------------

@query
def distinct_source_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct source_node tag values."""
    return agg.distinct_tag(points(spark, sf_dir), "source_node")


@query
def source_node_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 as a size: number of distinct source nodes (exact; ``approx=True`` for a sketch)."""
    return agg.distinct_tag_count(points(spark, sf_dir), "source_node")


@query
def count_by_source_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per source node (balance check)."""
    return agg.count_by_tag(points(spark, sf_dir), "source_node")


@query
def tag_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: tag keys present in the points."""
    return agg.tag_keys(points(spark, sf_dir))


@query
def count_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per series over the day before END."""
    p = points(spark, sf_dir, P.END_NS - NS_PER_DAY, P.END_NS).withColumn("_series", series_key(F.col("tags")))
    return agg.count_recent(p, P.END_NS, minutes=24 * 60, by=("_series", "series_id")).drop("_series")


@query
def window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts per GPU over [START, END), empty windows included."""
    return agg.window_count(points(spark, sf_dir, P.START_NS, P.END_NS), NS_PER_HOUR, P.START_NS, P.END_NS,
                            by=("gpu_id",))


@query
def window_count_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 without empty windows."""
    return agg.window_count(points(spark, sf_dir, P.START_NS, P.END_NS), NS_PER_HOUR, P.START_NS, P.END_NS,
                            by=("gpu_id",), create_empty=False)


@query
def window_count_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 in the store's literal form: daily counts per full series (tag set) over [START, END), empty windows
    included (series x windows rows: the query's feature)."""
    p = points(spark, sf_dir, P.START_NS, P.END_NS).withColumn("_series", series_key(F.col("tags")))
    counts = agg.window_count(p, NS_PER_DAY, P.START_NS, P.END_NS, by=("_series", "series_id"))
    return counts.drop("_series")  # grouped by the injective key; the readable text rides along


@query
def continuity_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged runs of empty hourly windows per GPU over [START, END)."""
    return agg.continuity_gaps(points(spark, sf_dir, P.START_NS, P.END_NS), NS_PER_HOUR, P.START_NS, P.END_NS,
                               by=("gpu_id",))


@query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points kept by a 30-day retention at NOW."""
    kept = reads.apply_retention(points(spark, sf_dir, P.NOW_NS - 30 * NS_PER_DAY), P.NOW_NS, days=30)
    return kept.select("persist_key", "timestamp_ns")


# --- delivery ledger -----------------------------------------------------------------------------------------------

def _ledger(spark: SparkSession, sf_dir: str):
    tel = fx.telemetry(spark, sf_dir)
    return tel, fx.enqueues(tel), fx.dispatches(tel), fx.acks(tel)


@query
def match_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries matched with their first ack, latency, on time within 30 s."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.match_acks(d, a, P.ACK_TIMEOUT_NS)


@query
def unknown_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acks for ids never dispatched."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.unknown_acks(d, a)


@query
def ack_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 in full: every ack is effective, repeated, late, unknown or invalid."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.ack_classes(d, a, *P.SCAN)


@query
def effective_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries completed by an ack before their requeue tick."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.effective_acks(d, a, *P.SCAN)


@query
def invalid_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acks with an empty id."""
    _, _, _, a = _ledger(spark, sf_dir)
    return ledger.invalid_acks(a)


@query
def unacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted messages that no ack completed in time (what a restart recovers)."""
    _, e, d, a = _ledger(spark, sf_dir)
    return ledger.unacked(e, d, a, *P.SCAN).select("persist_key", "enqueued_ns")


@query
def expired_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: deliveries not acked by NOW and older than the 30 s timeout."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.expired_pending(d, a, P.NOW_NS, P.ACK_TIMEOUT_NS)


@query
def requeue_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: requeue scan tick per delivery (10 s scans from t0 = 0) and whether the ack beat it."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.requeue_times(d, a, P.ACK_TIMEOUT_NS, P.SCAN_INTERVAL_NS)


@query
def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries per durable key."""
    _, _, d, _ = _ledger(spark, sf_dir)
    return ledger.deliveries(d)


@query
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys delivered at least twice and never effectively acked."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.dead_letters(d, a, P.MAX_DELIVERIES, *P.SCAN)


@query
def queue_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue's counters at an instant as (counter, value) rows."""
    _, e, d, a = _ledger(spark, sf_dir)
    return ledger.queue_counters(e, d, a, P.COUNTERS_NS, *P.SCAN)


@query
def sink_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed / write failed / ack failed over the collector's log."""
    return ledger.sink_rollup(fx.sink_log(fx.telemetry(spark, sf_dir)))


@query
def at_least_once_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted vs. acked vs. dispatched."""
    _, e, d, a = _ledger(spark, sf_dir)
    return ledger.at_least_once_audit(e, d, a, *P.SCAN)


@query
def reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of refused sends, in percent."""
    _, e, _, _ = _ledger(spark, sf_dir)
    return ledger.reject_rate(e)


@query
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-rank p50/p95/p99 ack latency per delivery round (first or second), from counts per distinct
    latency."""
    _, _, d, a = _ledger(spark, sf_dir)
    m = ledger.match_acks(d, a, P.ACK_TIMEOUT_NS).withColumn("delivery", F.substring("message_id", 1, 2))
    return ledger.exact_percentiles(m, "delivery", "latency_ns", {"p50_ns": 0.5, "p95_ns": 0.95, "p99_ns": 0.99},
                                    F.call_function("div", F.col("latency_ns"), F.lit(1_000_000_000)))


@query
def stamped_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 as an invariant: every message's time replaced by its arrival, which is one instant no earlier than any
    recorded time; the other columns are untouched."""
    tel = fx.telemetry(spark, sf_dir)
    both = stamp_arrival(tel.withColumn("recorded_ns", F.col("timestamp_ns")))
    return both.select("persist_key", "recorded_ns", (F.col("timestamp_ns") > F.col("recorded_ns")).alias("arrived_later"))


@query
def resolved_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without a time (every 11th, set to 0) get the arrival time, all others keep theirs."""
    tel = fx.telemetry(spark, sf_dir).withColumn(
        "timestamp_ns", F.when(F.col("persist_key") % 11 == 0, F.lit(0).cast("long")).otherwise(F.col("timestamp_ns")))
    return build_points(tel, arrival_ns=F.lit(P.NOW_NS)).select("persist_key", "timestamp_ns")


def _depth(spark: SparkSession, sf_dir: str, with_refusals: bool = False) -> DataFrame:
    """Depth with consumer lag: each accepted message is popped k minutes after it was accepted."""
    tel, e, _, _ = _ledger(spark, sf_dir)
    # Derived row by row from the accepted messages (the pop time is a function of the message): no join.
    pops = fx.accepted(tel).select(
        "persist_key", (F.col("timestamp_ns") + F.col("k") * NS_PER_MINUTE).alias("sent_ns"))
    return depth.queue_depth(depth.depth_events(e, pops, with_refusals=with_refusals), split_rows=P.SPLIT_ROWS)


@query
def queue_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-list depth after every accept and pop."""
    return _depth(spark, sf_dir).select("persist_key", "event_ns", "delta", "kind", "depth")


@query
def queue_depth_requeues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 with its third leg: +1 per accept and per requeue tick, -1 per delivery."""
    _, e, d, a = _ledger(spark, sf_dir)
    events = depth.depth_events(e, d, ledger.requeues(d, a, *P.SCAN))
    return depth.queue_depth(events, split_rows=P.SPLIT_ROWS).select("persist_key", "event_ns", "delta", "kind", "depth")


@query
def partitioned_queue_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 + E1: depth of each of 4 queues when messages are spread by GPU id (numeric ids modulo 4; messages
    without a numeric id form their own queue), same consumer-lag model as ``queue_depth``."""
    tel = fx.telemetry(spark, sf_dir)
    part = enrich.partition_of("gpu_id", 4, method="integer").alias("partition")
    acc = fx.accepted(tel)
    accepts = acc.select("persist_key", F.col("timestamp_ns").alias("event_ns"), F.lit(1).alias("delta"),
                         F.lit("accept").alias("kind"), part)
    pops = acc.select("persist_key", (F.col("timestamp_ns") + F.col("k") * NS_PER_MINUTE).alias("event_ns"),
                      F.lit(-1).alias("delta"), F.lit("dispatch").alias("kind"), part)
    d = depth.queue_depth(accepts.unionByName(pops), partition=("partition",), split_rows=P.SPLIT_ROWS)
    return d.select("partition", "persist_key", "event_ns", "delta", "kind", "depth")


@query
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepts that leave the queue (max 25) at 80 % or more."""
    hw = depth.high_water(_depth(spark, sf_dir), P.QUEUE_MAX, P.HIGH_WATER_PCT)
    return hw.where("high_water").select("persist_key", "event_ns", "depth", "fill_pct")


@query
def saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepts a queue of 25 would have refused."""
    s = depth.saturated(_depth(spark, sf_dir), P.QUEUE_MAX)
    return s.where("would_reject").select("persist_key", "event_ns", "depth")


@query
def saturation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 vs. the record: sends per recorded outcome and predicted refusal by a queue of 25."""
    return depth.saturation_check(_depth(spark, sf_dir, with_refusals=True), P.QUEUE_MAX)


@query
def fifo_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovery order of the durable backlog (C3), by durable key."""
    _, e, d, a = _ledger(spark, sf_dir)
    backlog = ledger.unacked(e, d, a, *P.SCAN).select("persist_key")
    return depth.fifo_order(backlog, bucket_keys=1000, materialize=True)


@query
def requeue_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``requeues`` ledger derived from E5 (message, key, requeue time, reason)."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.requeues(d, a, P.ACK_TIMEOUT_NS, P.SCAN_INTERVAL_NS)


@query
def ready_after_requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the ready list at an instant: durable keys that wait for a (further) delivery."""
    _, e, d, a = _ledger(spark, sf_dir)
    return ledger.ready_after_requeue(e, d, a, P.END_NS, *P.SCAN)


@query
def late_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acks that came after their delivery's requeue tick (ignored by the queue)."""
    _, _, d, a = _ledger(spark, sf_dir)
    return ledger.late_acks(d, a, P.ACK_TIMEOUT_NS, P.SCAN_INTERVAL_NS)


# --- sender --------------------------------------------------------------------------------------------------------

@query
def retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry decision for every status code in the attempts ledger."""
    return fx.attempt_codes(spark, sf_dir).distinct().select("code", is_retryable(F.col("code")).alias("retryable"))


@query
def backoff_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wait bound (ms) before every retry number seen in the ledger (100 ms, x2, max 5 s)."""
    return fx.attempt_numbers(spark, sf_dir).select("attempt", backoff_bound_ms(F.col("attempt")).alias("bound_ms"))


@query
def sender_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome per message with 5 retries."""
    return sender.sender_rollup(fx.attempts(spark, sf_dir), P.MAX_RETRIES)


@query
def sender_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 totals: messages sent / dropped / pending."""
    return sender.sender_totals(sender.sender_rollup(fx.attempts(spark, sf_dir), P.MAX_RETRIES))


# --- enrichment (second wave) --------------------------------------------------------------------------------------

def _flat_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir)
    return p.select("persist_key", "timestamp_ns", "gpu_id", "namespace", "model_name", "source_node",
                    F.col("fields.metric_name").alias("metric_name"), F.col("fields.value").alias("value"))


@query
def attach_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: owner of the GPU at each point's time (as-of join on assignments)."""
    p = _flat_points(spark, sf_dir).select("persist_key", "gpu_id", "timestamp_ns")
    return enrich.attach_owner(p, fx.assignments(spark, sf_dir), bucket_ns=NS_PER_DAY, split_rows=P.SPLIT_ROWS)


@query
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: trailing 6-hour mean per GPU and metric."""
    p = _flat_points(spark, sf_dir).select("persist_key", "gpu_id", "metric_name", "timestamp_ns", "value")
    r = enrich.rolling_mean(p, P.ROLLING_WIDTH_NS, bucket_ns=NS_PER_DAY, split_rows=P.SPLIT_ROWS)
    return r.select("persist_key", "gpu_id", "metric_name", "timestamp_ns",
                    # 9 decimals: exact means of 2-decimal values over small windows end within 8 decimals, so
                    # summation-order noise cannot flip the rounding.
                    F.round("rolling_mean", 9).alias("rolling_mean"), "window_points")


@query
def allow_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: points of allowed namespaces only."""
    p = _flat_points(spark, sf_dir).select("persist_key", "namespace")
    return enrich.allow_namespaces(p, fx.allowlist(spark))


@query
def sla_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: SLA tier per point from its model list, default tier otherwise."""
    p = _flat_points(spark, sf_dir).select("persist_key", "model_name")
    return enrich.map_sla_tier(p, fx.model_tiers(spark))


@query
def derivative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: change per second against the previous point of the same GPU and metric."""
    p = _flat_points(spark, sf_dir).select("persist_key", "gpu_id", "metric_name", "timestamp_ns", "value")
    d = enrich.derivative(p, bucket_ns=NS_PER_DAY, split_rows=P.SPLIT_ROWS)
    return d.select("persist_key", "gpu_id", "metric_name", "timestamp_ns", "prev_timestamp_ns",
                    F.round("per_second", 6).alias("per_second"))


@query
def gpu_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: last point per GPU at NOW and whether it is silent for more than a day."""
    return agg.gpu_down(_flat_points(spark, sf_dir), P.NOW_NS, NS_PER_DAY)


@query
def gpu_silences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: closed silences longer than two days per GPU."""
    return agg.gpu_silences(points(spark, sf_dir), 2 * NS_PER_DAY, bucket_ns=NS_PER_DAY, split_rows=P.SPLIT_ROWS)


@query
def latest_by_gpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: latest point per GPU and metric."""
    return agg.latest_by_gpu(points(spark, sf_dir))


@query
def points_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: GPU 7's points within 12 hours of 2024-01-15T00:00:00Z."""
    half = 12 * NS_PER_HOUR
    p = reads.points_around(points(spark, sf_dir, P.AROUND_NS - half, P.AROUND_NS + half + 1), P.FLAGSHIP_GPU,
                            P.AROUND_NS, minutes=12 * 60)
    return p.select("persist_key", "timestamp_ns", F.col("fields.metric_name").alias("metric_name"),
                    F.col("fields.value").alias("value"))


@query
def partition_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: points per partition with numeric GPU ids spread over 16 partitions."""
    return enrich.partition_depth(points(spark, sf_dir), 16, method="integer")


@query
def partition_depth_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 by hash: points spread over 16 partitions; every GPU id is in one partition only."""
    p = points(spark, sf_dir).withColumn("partition", enrich.partition_of("gpu_id", 16))
    per_gpu = p.groupBy("gpu_id").agg(F.count(F.lit(1)).alias("points"), F.count_distinct("partition").alias("partitions"),
                                      F.count_if((F.col("partition") < 0) | (F.col("partition") >= 16)).alias("out_of_range"))
    return per_gpu


@query
def write_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily write rate per source node."""
    return agg.write_rate(points(spark, sf_dir), NS_PER_DAY, by=("source_node",)).withColumn(
        "points_per_second", F.round("points_per_second", 9))


# --- sources and sinks ---------------------------------------------------------------------------------------------

def _value_text(key, value):
    """The value column as text, with NaN, junk, overflow and a leading space mixed in by key."""
    return (
        F.when(key % 37 == 0, F.lit("NaN")).when(key % 41 == 0, F.lit("n/a")).when(key % 43 == 0, F.lit("1e999"))
        .when(key % 47 == 0, F.concat(F.lit(" "), value.cast("string")))
        .otherwise(value.cast("string"))
    )


def _csv_lines(tel: DataFrame) -> DataFrame:
    """Telemetry rendered as quoted CSV lines (recorded ns time first), with bad values and short rows mixed in."""
    key = F.col("persist_key")
    value_text = _value_text(key, F.col("value"))
    models = [F.coalesce(F.get(F.col("model_name"), i), F.lit("")) for i in range(4)]
    fields = [F.col("timestamp_ns").cast("string"), F.col("metric_name"), F.col("gpu_id"), F.col("device"),
              F.col("uuid"), *models, F.col("namespace"), value_text, F.col("labels_raw")]
    quoted = [quote_csv_field(f) for f in fields]
    line = F.when(key % 53 == 0, F.concat_ws(",", *quoted[:3])).otherwise(F.concat_ws(",", *quoted))
    return tel.select(line.alias("value"))


@query
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + B1-B6: telemetry written as CSV text to the shared folder, read back positionally; every row is either
    a canonical message or a reject with its reason."""
    path = scratch_path(spark, "csv-ingest")
    _csv_lines(fx.telemetry(spark, sf_dir)).write.mode("overwrite").text(path)
    rows = read_metrics_csv(spark, path, source_node="node-a", event_time="recorded", header=False)
    return rows.select("timestamp_ns", "metric_name", "gpu_id", F.array_join("model_name", ",").alias("model_names"),
                       "namespace", "value", "labels_raw", "reject_reason")


@query
def backlog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 then A3: the un-acked backlog (C3) written as JSON lines and recovered, with its recovery position."""
    tel, e, d, a = _ledger(spark, sf_dir)
    backlog = tel.join(ledger.unacked(e, d, a, *P.SCAN).select("persist_key"), "persist_key", "left_semi")
    path = scratch_path(spark, "backlog")
    write_backlog(backlog, path)
    back = read_backlog(spark, path, with_position=True)
    return back.select("persist_key", "position", "timestamp_ns", "metric_name", "gpu_id",
                       F.array_join("model_name", ",").alias("model_names"), "namespace", "value", "labels_raw")


@query
def points_store_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 then A7: points written to the date-partitioned store and GPU 7's [START, END) read back."""
    path = scratch_path(spark, "points")
    write_points(points(spark, sf_dir), path)
    p = read_points(spark, path, P.START_NS, P.END_NS, measurement="gpu_metrics")
    return reads.filter_gpu(p, P.FLAGSHIP_GPU).select(
        "persist_key", "timestamp_ns", F.col("fields.metric_name").alias("metric_name"),
        F.col("fields.value").alias("value"), "series_id")


@query
def entries_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship's response rows as JSON objects with every tag that is present."""
    return telemetry_by_gpu(spark, sf_dir).select("timestamp_ns", "entry")


@query
def safe_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct tag value and document source, checked as a safe identifier."""
    p = points(spark, sf_dir)
    vals = p.select(F.explode(F.map_values("tags")).alias("candidate"))
    srcs = fx.table(spark, sf_dir, "documents").select(F.col("source").alias("candidate"))
    return vals.unionByName(srcs).distinct().select("candidate", is_safe_identifier(F.col("candidate")).alias("is_safe"))


def rfc3339_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written four ways: with fraction and Z, with a +05:30 offset, with a space, without a zone."""
    e = fx.table(spark, sf_dir, "events")
    ts = F.col("ts")
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_id") % 4 == 1,
              F.concat(F.date_format(ts + F.expr("INTERVAL 330 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
        .when(F.col("event_id") % 4 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return e.select("event_id", text.alias("text"))


@query
def rfc3339_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict RFC 3339 parse of event-time texts to exact ns (null when refused)."""
    t = rfc3339_texts(spark, sf_dir)
    return t.select("event_id", "text", parse_rfc3339_ns(F.col("text")).alias("parsed_ns"))


# --- streaming (run to completion with availableNow, output read back from the batch folders) ----------------------

def _run_stream(spark: SparkSession, df: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    base = scratch_path(spark, name)
    out = f"{base}/out"
    q = streams.start_batches(df, streams.batch_dir_writer(out), f"{base}/checkpoint", output_mode)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.IntegerType())])
    return spark.read.schema(schema).parquet(out)


def _events_stream(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """The events as files in no order of time, a quarter of them per micro-batch. A file is one row group, which one
    task reads, and a batch has few files, so its rows are dealt over the cores before anything is built from them."""
    events = fx.table(spark, sf_dir, "events")
    n = _file_count(events)
    events.repartition(n, F.xxhash64("event_id")).write.mode("overwrite").parquet(f"{base}/events")
    stream = streams.table_stream(spark, f"{base}/events", max_files_per_trigger=n // 4)
    return stream.repartition(max(n // 4, spark.sparkContext.defaultParallelism), "event_id")


def _file_count(df: DataFrame) -> int:
    """As many files as the scan has splits, a multiple of four."""
    last = df.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0]
    return 4 * (1 + (last or 0) // 4)


def _run(df: DataFrame, writer, checkpoint: str) -> None:
    q = streams.start_batches(df, writer, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 + A6 (+ I6 statistics): events stream -> points -> idempotent batch folders, read back. Reads the table as
    it is: a file or a folder of files."""
    tel = fx.telemetry_from_events(streams.table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    flat = streams.ingest_stream(tel).select("persist_key", "timestamp_ns", "gpu_id", "device", "namespace", "source_node", "series_id")
    return _run_stream(spark, flat, "stream-ingest").drop("batch_id")


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery writes its message's point (a redelivery repeats it), over four micro-batches out of order;
    one per key is read."""
    base = scratch_path(spark, "stream-dedup")
    tel = fx.telemetry_from_events(_events_stream(spark, sf_dir, base))
    both = build_points(tel).unionByName(build_points(fx.redelivered(tel))).select(
        "persist_key", "timestamp_ns", "series_id", F.col("fields.metric_name").alias("metric_name"))
    _run(both, streams.batch_dir_writer(f"{base}/out"), f"{base}/checkpoint")
    return streams.dedup_at_read(spark, f"{base}/out").select("persist_key", "timestamp_ns", "series_id", "metric_name")


@query
def stream_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: hourly counts per GPU, kept per micro-batch (four, out of order) and summed at read."""
    base = scratch_path(spark, "stream-window-count")
    pts = build_points(fx.telemetry_from_events(_events_stream(spark, sf_dir, base)))
    _run(pts, streams.window_count_writer(f"{base}/out", NS_PER_HOUR), f"{base}/checkpoint")
    return streams.summed_window_counts(spark, f"{base}/out")


@query
def stream_ack_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries not acked within 30 s; both sides arrive over four micro-batches out of order."""
    base = scratch_path(spark, "stream-ack-timeout")
    tel = fx.telemetry_from_events(_events_stream(spark, sf_dir, base))

    def both(batch: DataFrame, batch_id: int) -> None:
        streams.batch_dir_writer(f"{base}/dispatches")(fx.dispatches(batch), batch_id)
        streams.batch_dir_writer(f"{base}/acks")(fx.acks(batch), batch_id)

    _run(tel, streams.fan_out_writer([both]), f"{base}/checkpoint")
    return streams.ack_timeout_at_read(spark, f"{base}/dispatches", f"{base}/acks", P.ACK_TIMEOUT_NS)


@query
def stream_open_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 with carried state: deliveries not acked within 30 s, from the open deliveries that each of four micro-batches
    out of order hands to the next."""
    base = scratch_path(spark, "stream-open-deliveries")
    tel = fx.telemetry_from_events(_events_stream(spark, sf_dir, base))
    carry = carried.open_deliveries_writer(f"{base}/open", P.ACK_TIMEOUT_NS)
    _run(tel, lambda batch, n: carry(carried.ledger_rows(fx.dispatches(batch), fx.acks(batch)), n), f"{base}/checkpoint")
    return carried.open_deliveries(spark, f"{base}/open", P.ACK_TIMEOUT_NS)


@query
def stream_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 before the sink: every delivery writes its message's point (a redelivery repeats it), over four micro-batches
    out of order; only the first copy of each point reaches the sink."""
    base = scratch_path(spark, "stream-first-copies")
    tel = fx.telemetry_from_events(_events_stream(spark, sf_dir, base))
    both = build_points(tel).unionByName(build_points(fx.redelivered(tel))).select(
        "persist_key", "timestamp_ns", "series_id", F.col("fields.metric_name").alias("metric_name"))
    _run(both, carried.first_copies_writer(f"{base}/keys", streams.batch_dir_writer(f"{base}/out"), buckets=1), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query
def stream_csv_to_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 from end to end: CSV files as they arrive -> rejects and points -> store, both read back."""
    base = scratch_path(spark, "stream-csv-store")
    lines = _csv_lines(fx.telemetry(spark, sf_dir))
    n = _file_count(lines)
    lines.repartition(n).write.mode("overwrite").text(f"{base}/in")
    q = streams.ingest_csv_stream(spark, f"{base}/in", f"{base}/store", f"{base}/checkpoint", "node-a", event_time="recorded",
                                  rejects_path=f"{base}/rejects", available_now=True, header=False, max_files_per_trigger=n // 4)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    pts = spark.read.parquet(f"{base}/store").select("timestamp_ns", F.col("fields.metric_name").alias("metric_name"),
                                                     F.col("fields.value").alias("value"), "source_node",
                                                     F.lit(None).cast("string").alias("reject_reason"))
    bad = spark.read.parquet(f"{base}/rejects").select("timestamp_ns", "metric_name", "value",
                                                       F.lit(None).cast("string").alias("source_node"), "reject_reason")
    return pts.unionByName(bad)


@query
def stream_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the telemetry CSV lines of ``csv_ingest`` as files arriving in a folder, ingested by a file stream one
    file per trigger; the batch folders hold the same rows as the batch ingest."""
    base = scratch_path(spark, "stream-csv")
    lines = _csv_lines(fx.telemetry(spark, sf_dir))
    n = _file_count(lines)
    lines.repartition(n).write.mode("overwrite").text(f"{base}/in")
    rows = streams.read_metrics_csv_stream(spark, f"{base}/in", "node-a", event_time="recorded", header=False,
                                           max_files_per_trigger=n // 4)
    flat = rows.select("timestamp_ns", "metric_name", "gpu_id", F.array_join("model_name", ",").alias("model_names"),
                       "namespace", "value", "labels_raw", "reject_reason")
    return _run_stream(spark, flat, "stream-csv-out").drop("batch_id")


@query
def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I6 + K12: one stream fanned out to two sinks (points folders and per-batch counters); totals summed from
    the counter folder."""
    base = scratch_path(spark, "stream-stats")
    pts = streams.ingest_stream(fx.telemetry_from_events(_events_stream(spark, sf_dir, base))).select(
        "persist_key", "timestamp_ns", "gpu_id", "series_id")
    writer = streams.fan_out_writer([
        streams.batch_dir_writer(f"{base}/points"),
        streams.counting_writer(f"{base}/stats", [F.count(F.lit(1)).alias("points"),
                                                  F.count_if(F.col("gpu_id").isNull()).alias("points_without_gpu")]),
    ])
    q = streams.start_batches(pts, writer, f"{base}/checkpoint")
    q.awaitTermination()
    stats = spark.read.schema("points long, points_without_gpu long, batch_id int").parquet(f"{base}/stats")
    return stats.agg(F.coalesce(F.sum("points"), F.lit(0)).cast("long").alias("points"),
                     F.coalesce(F.sum("points_without_gpu"), F.lit(0)).cast("long").alias("points_without_gpu"))


# --- merged tables: batches folded in behind a manifest ------------------------------------------------------------

GPU = {"gpu_id": "string"}


def _batched(spark: SparkSession, sf_dir: str, name: str, tables: dict, rows_of) -> dict:
    """Runs the events in four micro-batches out of order into merged tables; the first two batches are merged, the
    others are left to be merged while reading. ``rows_of``: from a batch's telemetry, the rows of each table."""
    base = scratch_path(spark, name)
    made = {k: make(f"{base}/{k}") for k, make in tables.items()}

    def write(batch: DataFrame, n: int) -> None:
        for k, rows in rows_of(batch).items():
            made[k].write_batch(rows, n)
            if n == 1:
                made[k].merge_new(batch.sparkSession)

    _run(fx.telemetry_from_events(_events_stream(spark, sf_dir, base)), streams.fan_out_writer([write]), f"{base}/checkpoint")
    return made


def _plain_points(tel: DataFrame) -> DataFrame:
    cols = ["measurement", "persist_key", "timestamp_ns", "gpu_id", "source_node", "tags", "fields", "series_id"]
    return rollups.dated(build_points(tel).select(*cols))


@query
def compacted_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + D9: every delivery writes its message's point (a redelivery repeats it), in batches out of order; merges keep
    the last write of each point, day by day, and the rest is merged while reading."""
    schema = _plain_points(fx.telemetry(spark, sf_dir)).schema
    copies = lambda tel: {"points": _plain_points(tel).unionByName(_plain_points(fx.redelivered(tel)))}
    made = _batched(spark, sf_dir, "compacted-points", {"points": lambda p: rollups.points_table(p, schema)}, copies)
    return made["points"].read(spark).select("persist_key", "timestamp_ns", "series_id", F.col("fields.metric_name").alias("metric_name"))


@query
def rollup_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 from stored counts: hourly counts per GPU over a range that begins and ends within a minute, empty windows
    included; the points are read for those two minutes only."""
    made = _batched(spark, sf_dir, "rollup-counts", {"counts": lambda p: rollups.count_table(p, GPU)},
                    lambda tel: {"counts": rollups.count_cells(build_points(tel), ["gpu_id"])})
    return rollups.counted_windows(spark, made["counts"], lambda a, b: points(spark, sf_dir, a, b), NS_PER_HOUR,
                                   P.UNALIGNED_START_NS, P.UNALIGNED_END_NS)


@query
def rollup_total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 with one window over the whole range, from days, hours, minutes and the points of the two ends."""
    made = _batched(spark, sf_dir, "rollup-totals", {"counts": lambda p: rollups.count_table(p, GPU)},
                    lambda tel: {"counts": rollups.count_cells(build_points(tel), ["gpu_id"])})
    whole = 400 * NS_PER_DAY * 100  # one window holds all of the data's time
    return rollups.counted_windows(spark, made["counts"], lambda a, b: points(spark, sf_dir, a, b), whole,
                                   P.UNALIGNED_START_NS, P.UNALIGNED_END_NS, create_empty=False)


def _coverage(spark: SparkSession, sf_dir: str, name: str, threshold_ns: int):
    made = _batched(spark, sf_dir, name, {"spans": lambda p: rollups.coverage_table(p, GPU, threshold_ns)},
                    lambda tel: {"spans": rollups.coverage_spans(build_points(tel), ["gpu_id"], threshold_ns)})
    return made["spans"]


@query
def coverage_silences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 from stored coverage: closed silences longer than two days per GPU."""
    spans = rollups.silences(spark, _coverage(spark, sf_dir, "coverage", 2 * NS_PER_DAY), 2 * NS_PER_DAY)
    return spans.where(F.col("gpu_id").isNotNull())


@query
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 from stored coverage: merged runs of empty hourly windows per GPU over [START, END)."""
    return rollups.gaps(spark, _coverage(spark, sf_dir, "coverage-gaps", NS_PER_HOUR), NS_PER_HOUR, NS_PER_HOUR, P.START_NS, P.END_NS)


def _sketches(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Sketches per metric and hour, unioned to one row per metric."""
    columns, distinct = {"metric_name": "string"}, ["series_id"]
    pts = lambda tel: build_points(tel).withColumn("metric_name", F.col("fields.metric_name"))
    made = _batched(spark, sf_dir, name, {"cells": lambda p: rollups.sketch_table(p, columns, distinct)},
                    lambda tel: {"cells": rollups.sketch_cells(pts(tel), ["metric_name"], distinct, F.col("fields.value"), NS_PER_HOUR)})
    return rollups.read_sketches(spark, made["cells"], NS_PER_HOUR, ["metric_name"], distinct)


@query
def sketched_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 from stored sketches: the number of series per metric, counted exactly, and whether the union of the hourly
    sketches is within the stated error of it."""
    exact = points(spark, sf_dir).groupBy(F.col("fields.metric_name").alias("metric_name")).agg(F.count_distinct("series_id").alias("series"))
    found = _sketches(spark, sf_dir, "sketched-series").select(F.col("metric_name").alias("_m"), rollups.distinct_estimate("series_id").alias("_e"))
    near = F.abs(F.col("_e") - F.col("series")) <= F.greatest(F.lit(1.0), F.col("series") * rollups.DISTINCT_ERROR)
    return exact.join(found, F.col("metric_name").eqNullSafe(F.col("_m"))).select("metric_name", "series", near.alias("within_error"))


@query
def sketched_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K11 from stored sketches: p50, p95 and p99 of every metric's values, checked by their true rank: the share of
    values below and up to the returned one is within the stated error of the quantile."""
    quantiles = F.explode(F.array(*[F.struct(F.lit(p).alias("percent"), rollups.quantile_estimate(p / 100).alias("_v")) for p in (50, 95, 99)]))
    found = _sketches(spark, sf_dir, "sketched-quantiles").select(F.col("metric_name").alias("_m"), quantiles.alias("_q")).select("_m", "_q.*")
    rows = points(spark, sf_dir).select(F.col("fields.metric_name").alias("metric_name"), F.col("fields.value").alias("_value"))
    rows = rows.where(F.col("_value").isNotNull()).join(found, F.col("metric_name").eqNullSafe(F.col("_m")))
    ranked = rows.groupBy("metric_name", "percent").agg(
        F.count(F.lit(1)).alias("points"), F.count_if(F.col("_value") < F.col("_v")).alias("_below"),
        F.count_if(F.col("_value") <= F.col("_v")).alias("_upto"))
    slack = F.greatest(F.lit(1.0), F.col("points") * rollups.RANK_ERROR)
    at = F.col("points") * F.col("percent") / 100
    return ranked.select("metric_name", F.col("percent").cast("int").alias("percent"), "points",
                         ((F.col("_below") <= at + slack) & (F.col("_upto") >= at - slack)).alias("within_error"))


@query
def parse_value_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 + B4: the metric value texts of ``csv_ingest`` parsed strictly, each with its reject reason."""
    tel = fx.telemetry(spark, sf_dir)
    text = _value_text(F.col("persist_key"), F.col("value"))
    return tel.select("persist_key", text.alias("value_text")).select(
        "persist_key", "value_text", parse_value(F.col("value_text")).alias("value"),
        value_reject_reason(F.col("value_text")).alias("reject_reason"))

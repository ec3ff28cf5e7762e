"""DuckDB oracle SQL for the registered queries (same column names and types as the Spark plans)."""

from __future__ import annotations

from devmetrics.plans import params as P
from devmetrics.plans.oracle_views import with_views

ORACLE: dict[str, str] = {}


def oracle(name: str, views: tuple[str, ...], body: str) -> None:
    ORACLE[name] = with_views(views, body)


# Every tag of a point, from the long form, as JSON members in the order of the keys.
_TAG_MEMBERS = """(SELECT string_agg(to_json(g.k)::VARCHAR || ':' || to_json(g.v)::VARCHAR, ',' ORDER BY g.k)
  FROM tags_long g WHERE g.persist_key = points.persist_key)"""
_ENTRY = f"""left(json_object('timestamp_ns', timestamp_ns, 'measurement', measurement, 'metric_name', metric_name, 'value', value)::VARCHAR, -1)
  || coalesce(',' || {_TAG_MEMBERS}, '') || '}}'"""

oracle("telemetry_by_gpu", ("points",), f"""
SELECT timestamp_ns, measurement, gpu_id, metric_name, value, {_ENTRY} AS entry
FROM points
WHERE timestamp_ns >= {P.START_NS} AND timestamp_ns < {P.END_NS} AND measurement = 'gpu_metrics'
  AND gpu_id = '{P.FLAGSHIP_GPU}'
QUALIFY row_number() OVER (PARTITION BY measurement, series_id, timestamp_ns, metric_name ORDER BY persist_key DESC) = 1
ORDER BY timestamp_ns, metric_name, value
""")

oracle("list_gpus", ("points",), f"""
SELECT DISTINCT gpu_id FROM points
WHERE timestamp_ns >= {P.NOW_NS} - 30 * 86400000000000 AND timestamp_ns < {P.NOW_NS}
  AND measurement = 'gpu_metrics' AND gpu_id IS NOT NULL AND gpu_id <> ''
""")

HOUR = 3_600_000_000_000
_FIRST_W = P.START_NS - P.START_NS % HOUR
_LAST_W = (P.END_NS - 1) - (P.END_NS - 1) % HOUR

oracle("telemetry_by_gpu_closed", ("points",), f"""
SELECT timestamp_ns, coalesce(metric_name, '') AS metric_name, coalesce(gpu_id, '') AS gpu_id,
       coalesce(device, '') AS device, coalesce(value, 0.0) AS value
FROM points WHERE gpu_id = '{P.FLAGSHIP_GPU}' AND timestamp_ns >= {P.START_NS} AND timestamp_ns <= {P.END_NS}
ORDER BY timestamp_ns, metric_name, value
""")

oracle("labels_exploded", ("label_kv",), """
SELECT persist_key, k AS label_key, v AS label_value FROM label_kv
""")

oracle("tags_effective", ("points",), f"""
SELECT persist_key, '{{' || coalesce({_TAG_MEMBERS}, '') || '}}' AS tags, series_id FROM points
""")

oracle("tags_widened", ("points",), """
SELECT persist_key, tag_k AS k, tag_flag AS flag, tag_expr AS expr FROM points
""")

_IDENT = 'gpu_id, device, uuid, namespace, model_name AS "modelName"'
oracle("upsert_influx_key", ("points",), f"""
SELECT {_IDENT}, timestamp_ns - timestamp_ns % {HOUR} AS timestamp_ns, metric_name, value, persist_key
FROM points
QUALIFY row_number() OVER (PARTITION BY gpu_id, device, uuid, namespace, model_name, timestamp_ns - timestamp_ns % {HOUR}
                           ORDER BY persist_key DESC) = 1
""")

oracle("upsert_metric_key", ("points",), f"""
SELECT {_IDENT}, timestamp_ns - timestamp_ns % {HOUR} AS timestamp_ns, metric_name, value, persist_key
FROM points
QUALIFY row_number() OVER (PARTITION BY gpu_id, device, uuid, namespace, model_name, timestamp_ns - timestamp_ns % {HOUR},
                           metric_name ORDER BY persist_key DESC) = 1
""")

oracle("pivot_roundtrip", ("points",), """
SELECT persist_key, timestamp_ns, metric_name, value, series_id FROM points
""")

oracle("distinct_source_nodes", ("points",), """
SELECT DISTINCT source_node FROM points WHERE source_node IS NOT NULL
""")

oracle("count_by_source_node", ("points",), """
SELECT source_node, count(*) AS points FROM points GROUP BY source_node
""")

oracle("tag_keys", ("tags_long",), """
SELECT DISTINCT k AS tag_key FROM tags_long
""")

oracle("count_recent", ("points",), f"""
SELECT series_id, count(*) AS points FROM points
WHERE timestamp_ns >= {P.END_NS - 24 * HOUR} AND timestamp_ns < {P.END_NS}
GROUP BY series_id
""")

_GRID = f"""
rng AS (SELECT gpu_id, timestamp_ns FROM points WHERE timestamp_ns >= {P.START_NS} AND timestamp_ns < {P.END_NS}),
grid AS (SELECT s.gpu_id, r.range AS w FROM (SELECT DISTINCT gpu_id FROM rng) s, range({_FIRST_W}, {_LAST_W + 1}, {HOUR}) r),
counts AS (SELECT gpu_id, timestamp_ns - timestamp_ns % {HOUR} AS w, count(*) AS n FROM rng GROUP BY ALL),
filled AS (SELECT g.gpu_id, g.w, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN counts c
           ON g.gpu_id IS NOT DISTINCT FROM c.gpu_id AND g.w = c.w)
"""

oracle("window_count", ("points",), f"""
, {_GRID.strip()}
SELECT gpu_id, greatest(w, {P.START_NS}) AS window_start_ns, least(w + {HOUR}, {P.END_NS}) AS window_end_ns,
       CAST(n AS BIGINT) AS points FROM filled
""")

oracle("window_count_nonempty", ("points",), f"""
, {_GRID.strip()}
SELECT gpu_id, greatest(w, {P.START_NS}) AS window_start_ns, least(w + {HOUR}, {P.END_NS}) AS window_end_ns,
       CAST(n AS BIGINT) AS points FROM filled WHERE n > 0
""")

oracle("continuity_gaps", ("points",), f"""
, {_GRID.strip()}
SELECT gpu_id, greatest(min(w), {P.START_NS}) AS gap_start_ns, least(max(w) + {HOUR}, {P.END_NS}) AS gap_end_ns,
       CAST(count(*) AS BIGINT) AS empty_windows
FROM (SELECT gpu_id, w, w - row_number() OVER (PARTITION BY gpu_id ORDER BY w) * {HOUR} AS grp FROM filled WHERE n = 0)
GROUP BY gpu_id, grp
""")

oracle("retention", ("points",), f"""
SELECT persist_key, timestamp_ns FROM points WHERE timestamp_ns >= {P.NOW_NS - 30 * 24 * HOUR}
""")

# --- delivery ledger -----------------------------------------------------------------------------------------------
_L = ("telemetry", "enqueues", "dispatches", "acks")
# A delivery's first ack is looked for among those since its sending: before it the id isn't pending, and the ack is unknown.
_FA = (", fa AS (SELECT a.message_id, min(a.ack_ns) AS ack_ns FROM acks a JOIN dispatches d ON a.message_id = d.message_id AND a.ack_ns >= d.sent_ns "
       "WHERE a.message_id <> '' GROUP BY a.message_id)")
_UNKNOWN = "a.message_id <> '' AND NOT EXISTS (SELECT 1 FROM dispatches d WHERE d.message_id = a.message_id AND d.sent_ns <= a.ack_ns)"
_TICK = f"(((sent_ns + {P.ACK_TIMEOUT_NS}) // {P.SCAN_INTERVAL_NS}) + 1) * {P.SCAN_INTERVAL_NS}"

oracle("match_acks", _L, f"""
{_FA}
SELECT d.message_id, d.persist_key, d.sent_ns, fa.ack_ns, fa.ack_ns - d.sent_ns AS latency_ns,
       fa.ack_ns - d.sent_ns <= {P.ACK_TIMEOUT_NS} AS on_time
FROM dispatches d JOIN fa ON d.message_id = fa.message_id
""")

oracle("unknown_acks", _L, f"""
SELECT message_id, ack_ns FROM acks a WHERE {_UNKNOWN}
""")

oracle("invalid_acks", _L, """
SELECT message_id, ack_ns FROM acks WHERE message_id IS NULL OR message_id = ''
""")

# An ack finds its delivery pending from the sending until the scan tick that requeues it; only then is the durable
# copy deleted. Any other ack changes nothing.
_IN_TIME = f"a.message_id = d.message_id AND a.ack_ns >= d.sent_ns AND a.ack_ns < {_TICK}"
_EFF = f", eff AS (SELECT d.message_id, d.persist_key, min(a.ack_ns) AS ack_ns FROM dispatches d JOIN acks a ON {_IN_TIME} GROUP BY ALL)"
_EFF_KEYS = "SELECT persist_key FROM eff"

oracle("effective_acks", _L, f"""
{_EFF}
SELECT message_id, persist_key, ack_ns FROM eff
""")

oracle("ack_classes", _L, f"""
{_EFF},
since AS (SELECT a.message_id, count(*) AS n FROM acks a JOIN dispatches d ON a.message_id = d.message_id AND a.ack_ns >= d.sent_ns GROUP BY 1)
SELECT 'effective' AS ack_class, count(*) AS acks FROM eff
UNION ALL SELECT 'repeated', coalesce(sum(n - 1), 0)::BIGINT FROM since JOIN eff USING (message_id)
UNION ALL SELECT 'late', coalesce(sum(n), 0)::BIGINT FROM since WHERE message_id NOT IN (SELECT message_id FROM eff)
UNION ALL SELECT 'unknown', count(*) FROM acks a WHERE {_UNKNOWN}
UNION ALL SELECT 'invalid', count(*) FROM acks WHERE coalesce(message_id, '') = ''
""")

oracle("unacked", _L, f"""
{_EFF}
SELECT persist_key, enqueued_ns FROM enqueues WHERE outcome = 'enqueued' AND persist_key NOT IN ({_EFF_KEYS})
""")

oracle("expired_pending", _L, f"""
SELECT message_id, persist_key, sent_ns FROM dispatches d
WHERE NOT EXISTS (SELECT 1 FROM acks a WHERE a.message_id = d.message_id AND a.ack_ns >= d.sent_ns AND a.ack_ns <= {P.NOW_NS})
  AND {P.NOW_NS} - sent_ns > {P.ACK_TIMEOUT_NS}
""")

oracle("requeue_time", _L, f"""
{_FA}
SELECT d.message_id, d.persist_key, d.sent_ns, {_TICK} AS requeue_tick_ns, fa.ack_ns AS first_ack_ns,
       coalesce(fa.ack_ns < {_TICK}, false) AS acked_in_time, NOT coalesce(fa.ack_ns < {_TICK}, false) AS requeued
FROM dispatches d LEFT JOIN fa ON d.message_id = fa.message_id
""")

oracle("deliveries", _L, """
SELECT persist_key, count(*) AS deliveries FROM dispatches GROUP BY persist_key
""")

_ACKED_KEYS = "SELECT DISTINCT d.persist_key FROM dispatches d JOIN acks a ON a.message_id = d.message_id WHERE a.message_id <> ''"

oracle("dead_letters", _L, f"""
{_EFF}
SELECT persist_key, count(*) AS deliveries FROM dispatches
WHERE persist_key NOT IN ({_EFF_KEYS})
GROUP BY persist_key HAVING count(*) >= {P.MAX_DELIVERIES}
""")

oracle("queue_counters", _L, f"""
, e AS (SELECT * FROM enqueues WHERE enqueued_ns <= {P.COUNTERS_NS}), d AS (SELECT * FROM dispatches WHERE sent_ns <= {P.COUNTERS_NS}),
a AS (SELECT * FROM acks WHERE ack_ns <= {P.COUNTERS_NS}),
ok AS (SELECT DISTINCT d.message_id, d.persist_key FROM d JOIN a ON {_IN_TIME}),
open AS (SELECT *, {_TICK} AS tick FROM d WHERE message_id NOT IN (SELECT message_id FROM ok)),
c AS (
SELECT (SELECT count(*) FROM e WHERE outcome = 'enqueued') AS enqueued, (SELECT count(*) FROM e WHERE outcome = 'rejected') AS rejected,
  (SELECT count(*) FROM e WHERE outcome = 'invalid') AS invalid, (SELECT count(*) FROM e WHERE outcome = 'closed') AS closed,
  (SELECT count(*) FROM e WHERE outcome = 'persist_failed') AS persist_failed, (SELECT count(*) FROM d) AS dispatched,
  (SELECT count(*) FROM ok) AS acked, (SELECT count(*) FROM open WHERE tick <= {P.COUNTERS_NS}) AS requeued,
  (SELECT count(*) FROM open WHERE tick > {P.COUNTERS_NS}) AS pending,
  (SELECT count(*) FROM a WHERE {_UNKNOWN}) AS unknown_acks,
  (SELECT count(*) FROM a WHERE message_id = '') AS invalid_acks,
  (SELECT count(*) FROM e WHERE outcome = 'enqueued' AND persist_key NOT IN (SELECT persist_key FROM ok)) AS recovered),
w AS (SELECT *, enqueued - dispatched + requeued AS queue FROM c)
SELECT counter, value FROM w UNPIVOT (value FOR counter IN (enqueued, rejected, invalid, closed, persist_failed, dispatched, acked,
  requeued, pending, unknown_acks, invalid_acks, recovered, queue))
""")

oracle("sink_rollup", _L, f"""
, sl AS (SELECT t.metric_name <> 'error' AS write_ok, (t.metric_name <> 'error') AND d.message_id IN (SELECT message_id FROM acks) AS ack_ok
         FROM dispatches d JOIN telemetry t ON d.persist_key = t.persist_key)
SELECT count(*) FILTER (WHERE write_ok) AS processed, count(*) FILTER (WHERE NOT write_ok) AS write_failed,
       count(*) FILTER (WHERE write_ok AND NOT ack_ok) AS ack_failed FROM sl
""")

oracle("at_least_once_audit", _L, f"""
{_EFF}, acc AS (SELECT persist_key FROM enqueues WHERE outcome = 'enqueued')
SELECT 'accepted' AS "check", count(*) AS value FROM acc
UNION ALL SELECT 'dispatched_keys', count(DISTINCT persist_key) FROM dispatches
UNION ALL SELECT 'dispatches', count(*) FROM dispatches
UNION ALL SELECT 'unique_acked', count(*) FROM acc WHERE persist_key IN ({_ACKED_KEYS})
UNION ALL SELECT 'effective_acked', count(*) FROM acc WHERE persist_key IN ({_EFF_KEYS})
UNION ALL SELECT 'missing', count(*) FROM acc WHERE persist_key NOT IN ({_EFF_KEYS})
UNION ALL SELECT 'never_dispatched', count(*) FROM acc WHERE persist_key NOT IN (SELECT persist_key FROM dispatches)
""")

oracle("reject_rate", _L, """
SELECT count(*) AS attempts, count(*) FILTER (WHERE outcome = 'rejected') AS rejected,
       round(avg(CASE WHEN outcome = 'rejected' THEN 1.0 ELSE 0.0 END) * 100, 6) AS reject_rate_pct
FROM enqueues
""")

oracle("latency_percentiles", _L, f"""
{_FA}
SELECT substr(d.message_id, 1, 2) AS delivery, count(*) AS acked,
       quantile_disc(fa.ack_ns - d.sent_ns, 0.5) AS p50_ns, quantile_disc(fa.ack_ns - d.sent_ns, 0.95) AS p95_ns,
       quantile_disc(fa.ack_ns - d.sent_ns, 0.99) AS p99_ns
FROM dispatches d JOIN fa ON d.message_id = fa.message_id GROUP BY 1
""")

_DEPTH = f"""
, ev AS (SELECT persist_key, enqueued_ns AS event_ns, 1 AS delta, 'accept' AS kind FROM enqueues WHERE outcome = 'enqueued'
         UNION ALL
         SELECT e.persist_key, e.enqueued_ns + t.k * 60000000000, -1, 'dispatch'
         FROM enqueues e JOIN telemetry t ON e.persist_key = t.persist_key WHERE e.outcome = 'enqueued'),
dep AS (SELECT persist_key, event_ns, delta, kind,
        CAST(sum(delta) OVER (ORDER BY event_ns, delta, persist_key, kind ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth
        FROM ev)
"""

oracle("queue_depth", _L, f"""
{_DEPTH}
SELECT persist_key, event_ns, CAST(delta AS INTEGER) AS delta, kind, depth FROM dep
""")

oracle("high_water", _L, f"""
{_DEPTH}
SELECT persist_key, event_ns, depth, depth * 100 // {P.QUEUE_MAX} AS fill_pct FROM dep
WHERE kind = 'accept' AND depth * 100 // {P.QUEUE_MAX} >= {P.HIGH_WATER_PCT}
""")

oracle("saturation", _L, f"""
{_DEPTH}
SELECT persist_key, event_ns, depth FROM dep WHERE kind = 'accept' AND depth - 1 >= {P.QUEUE_MAX}
""")

oracle("fifo_order", _L, f"""
{_EFF}
SELECT persist_key, CAST(row_number() OVER (ORDER BY persist_key) AS BIGINT) AS position
FROM enqueues WHERE outcome = 'enqueued' AND persist_key NOT IN ({_EFF_KEYS})
""")

# --- sender --------------------------------------------------------------------------------------------------------
oracle("retryable", ("attempts",), """
SELECT DISTINCT code, coalesce(code IN ('ResourceExhausted', 'Unavailable', 'DeadlineExceeded'), false) AS retryable
FROM attempts
""")

oracle("backoff_bound", ("attempts",), """
SELECT DISTINCT attempt, least(100.0 * pow(2.0, attempt), 5000.0) AS bound_ms FROM attempts
""")

_ROLLUP = f"""
, term AS (SELECT message_key, attempt, code FROM attempts WHERE attempt <= {P.MAX_RETRIES}
           AND (code = 'OK' OR (code NOT IN ('ResourceExhausted', 'Unavailable', 'DeadlineExceeded') AND code <> 'LogicalFailure')
                OR attempt = {P.MAX_RETRIES})),
first_term AS (SELECT message_key, min(attempt) AS attempt, arg_min(code, attempt) AS code FROM term GROUP BY message_key),
roll AS (SELECT m.message_key,
           CASE WHEN f.message_key IS NULL THEN 'pending' WHEN f.code = 'OK' THEN 'sent' ELSE 'dropped' END AS outcome,
           f.attempt + 1 AS attempts_used, f.code AS final_code
         FROM (SELECT DISTINCT message_key FROM attempts WHERE attempt <= {P.MAX_RETRIES}) m
         LEFT JOIN first_term f ON m.message_key = f.message_key)
"""

oracle("sender_rollup", ("attempts",), f"""
{_ROLLUP}
SELECT message_key, outcome, CAST(attempts_used AS BIGINT) AS attempts_used, final_code FROM roll
""")

oracle("sender_totals", ("attempts",), f"""
{_ROLLUP}
SELECT outcome, count(*) AS messages FROM roll GROUP BY outcome
""")

# --- enrichment (second wave) --------------------------------------------------------------------------------------
DAY = 24 * HOUR

oracle("attach_owner", ("points", "assignments"), """
SELECT p.persist_key, p.gpu_id, p.timestamp_ns, a.owner, a.from_ns
FROM points p ASOF LEFT JOIN assignments a ON p.gpu_id = a.gpu_id AND p.timestamp_ns >= a.from_ns
""")

oracle("rolling_mean", ("points",), f"""
SELECT persist_key, gpu_id, metric_name, timestamp_ns,
  round(avg(value) OVER w, 9) AS rolling_mean, count(*) OVER w AS window_points
FROM points
WINDOW w AS (PARTITION BY gpu_id, metric_name ORDER BY timestamp_ns
             RANGE BETWEEN {P.ROLLING_WIDTH_NS - 1} PRECEDING AND CURRENT ROW)
""")

oracle("allow_namespaces", ("points",), """
SELECT persist_key, namespace FROM points WHERE namespace IN ('ns1', 'ns2')
""")

oracle("sla_tier", ("points",), """
SELECT persist_key, model_name,
  CASE model_name WHEN 'A100,PCIe' THEN 'gold' WHEN 'H100,SXM5' THEN 'platinum' ELSE 'standard' END AS tier
FROM points
""")

oracle("derivative", ("points",), """
SELECT persist_key, gpu_id, metric_name, timestamp_ns, prev_ts AS prev_timestamp_ns,
  round(CASE WHEN timestamp_ns <> prev_ts THEN (value - prev_v) / ((timestamp_ns - prev_ts) / 1e9) END, 6) AS per_second
FROM (SELECT *, lag(timestamp_ns) OVER w AS prev_ts, lag(value) OVER w AS prev_v FROM points
      WINDOW w AS (PARTITION BY gpu_id, metric_name ORDER BY timestamp_ns, persist_key))
""")

oracle("gpu_down", ("points",), f"""
SELECT gpu_id, max(timestamp_ns) AS last_seen_ns, {P.NOW_NS} - max(timestamp_ns) AS silent_ns,
       {P.NOW_NS} - max(timestamp_ns) > {DAY} AS is_down
FROM points WHERE gpu_id IS NOT NULL GROUP BY gpu_id
""")

oracle("gpu_silences", ("points",), f"""
SELECT gpu_id, prev_ts AS silent_from_ns, timestamp_ns AS silent_to_ns, timestamp_ns - prev_ts AS silent_ns
FROM (SELECT gpu_id, timestamp_ns, lag(timestamp_ns) OVER (PARTITION BY gpu_id ORDER BY timestamp_ns, persist_key) AS prev_ts
      FROM points WHERE gpu_id IS NOT NULL)
WHERE timestamp_ns - prev_ts > {2 * DAY}
""")

oracle("latest_by_gpu", ("points",), """
SELECT gpu_id, metric_name, timestamp_ns, value, persist_key FROM points WHERE gpu_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY gpu_id, metric_name ORDER BY timestamp_ns DESC, persist_key DESC) = 1
""")

oracle("points_around", ("points",), f"""
SELECT persist_key, timestamp_ns, metric_name, value FROM points
WHERE gpu_id = '{P.FLAGSHIP_GPU}' AND timestamp_ns BETWEEN {P.AROUND_NS - 12 * HOUR} AND {P.AROUND_NS + 12 * HOUR}
""")

oracle("partition_depth", ("points",), """
SELECT CAST(TRY_CAST(gpu_id AS BIGINT) % 16 AS BIGINT) AS partition, count(*) AS points FROM points GROUP BY 1
""")

oracle("write_rate", ("points",), f"""
SELECT source_node, timestamp_ns - timestamp_ns % {DAY} AS bucket_ns, count(*) AS points,
       round(count(*) / {DAY / 1e9}, 9) AS points_per_second
FROM points GROUP BY 1, 2
""")

# --- sources and sinks ---------------------------------------------------------------------------------------------
_FLOAT_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"

oracle("csv_ingest", ("telemetry",), f"""
, src AS (
  SELECT persist_key, timestamp_ns, metric_name, gpu_id, model_name_csv, namespace, labels_raw,
    CASE WHEN persist_key % 37 = 0 THEN 'NaN' WHEN persist_key % 41 = 0 THEN 'n/a' WHEN persist_key % 43 = 0 THEN '1e999'
         WHEN persist_key % 47 = 0 THEN ' ' || CAST(value AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS vtext
  FROM telemetry),
parsed AS (
  SELECT *, CASE WHEN regexp_full_match(vtext, '{_FLOAT_RE}') THEN TRY_CAST(vtext AS DOUBLE) END AS v FROM src)
SELECT timestamp_ns,
  metric_name, gpu_id,
  CASE WHEN persist_key % 53 = 0 THEN ',,,'
       WHEN model_name_csv = '' THEN ',,,' ELSE model_name_csv || ',,' END AS model_names,
  CASE WHEN persist_key % 53 = 0 THEN '' ELSE namespace END AS namespace,
  CASE WHEN persist_key % 53 = 0 OR NOT isfinite(v) THEN NULL ELSE v END AS value,
  CASE WHEN persist_key % 53 = 0 THEN '' ELSE labels_raw END || ',source_node=node-a' AS labels_raw,
  CASE WHEN persist_key % 53 = 0 THEN 'incomplete record'
       WHEN regexp_full_match(lower(vtext), '[+-]?(inf|infinity|nan)') THEN 'not finite'
       WHEN NOT regexp_full_match(vtext, '{_FLOAT_RE}') THEN 'invalid value'
       WHEN v IS NULL OR NOT isfinite(v) THEN 'invalid value' END AS reject_reason
FROM parsed
""")

oracle("backlog_roundtrip", _L, f"""
{_EFF}
SELECT persist_key, CAST(row_number() OVER (ORDER BY persist_key) AS BIGINT) AS position, timestamp_ns, metric_name, gpu_id,
  CASE WHEN model_name_csv = '' THEN '' ELSE model_name_csv END AS model_names, namespace, value, labels_raw
FROM telemetry WHERE persist_key IN (SELECT persist_key FROM enqueues WHERE outcome = 'enqueued')
  AND persist_key NOT IN ({_EFF_KEYS})
""")

oracle("points_store_read", ("points",), f"""
SELECT persist_key, timestamp_ns, metric_name, value, series_id FROM points
WHERE timestamp_ns >= {P.START_NS} AND timestamp_ns < {P.END_NS} AND gpu_id = '{P.FLAGSHIP_GPU}'
""")

oracle("entries_json", ("points",), f"""
SELECT timestamp_ns, {_ENTRY} AS entry
FROM points
WHERE timestamp_ns >= {P.START_NS} AND timestamp_ns < {P.END_NS} AND gpu_id = '{P.FLAGSHIP_GPU}'
""")

oracle("safe_identifiers", ("tags_long",), """
SELECT candidate, regexp_full_match(candidate, '[A-Za-z0-9_.:-]+') AS is_safe
FROM (SELECT v AS candidate FROM tags_long UNION SELECT source FROM documents)
""")

oracle("rfc3339_checks", (), r"""
, t AS (
  SELECT event_id, CASE event_id % 4
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
    WHEN 1 THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+05:30'
    WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS text
  FROM events)
SELECT event_id, text,
  CASE WHEN regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})')
       THEN epoch_us(TRY_CAST(text AS TIMESTAMPTZ)) * 1000 END AS parsed_ns
FROM t
""")

# --- streaming: same results as the batch forms --------------------------------------------------------------------
oracle("stream_ingest", ("points",), """
SELECT persist_key, timestamp_ns, gpu_id, device, namespace, source_node, series_id FROM points
""")

oracle("stream_dedup", ("points",), """
SELECT persist_key, timestamp_ns, series_id, metric_name FROM points
""")

oracle("stream_window_count", ("points",), f"""
SELECT gpu_id, timestamp_ns - timestamp_ns % {HOUR} AS window_start_ns,
       timestamp_ns - timestamp_ns % {HOUR} + {HOUR} AS window_end_ns, count(*) AS points
FROM points GROUP BY 1, 2, 3
""")

oracle("stream_ack_timeout", _L, f"""
SELECT d.message_id, d.persist_key, d.sent_ns, 'timeout' AS reason FROM dispatches d
WHERE NOT EXISTS (SELECT 1 FROM acks a WHERE a.message_id = d.message_id AND a.message_id <> ''
                  AND a.ack_ns >= d.sent_ns AND a.ack_ns <= d.sent_ns + {P.ACK_TIMEOUT_NS})
""")

ORACLE["stream_open_deliveries"] = ORACLE["stream_ack_timeout"]
ORACLE["stream_first_copies"] = ORACLE["stream_dedup"]
ORACLE["compacted_points"] = ORACLE["stream_dedup"]
ORACLE["coverage_silences"] = ORACLE["gpu_silences"]
ORACLE["coverage_gaps"] = ORACLE["continuity_gaps"]

_U0, _U1 = P.UNALIGNED_START_NS, P.UNALIGNED_END_NS

oracle("rollup_window_count", ("points",), f"""
, rng AS (SELECT gpu_id, timestamp_ns - timestamp_ns % {HOUR} AS w FROM points WHERE timestamp_ns >= {_U0} AND timestamp_ns < {_U1}),
grid AS (SELECT g.gpu_id, r.range AS w FROM (SELECT DISTINCT gpu_id FROM rng) g,
         range({_U0 - _U0 % HOUR}, {(_U1 - 1) - (_U1 - 1) % HOUR + 1}, {HOUR}) r)
SELECT g.gpu_id, greatest(g.w, {_U0}) AS window_start_ns, least(g.w + {HOUR}, {_U1}) AS window_end_ns, count(rng.w) AS points
FROM grid g LEFT JOIN rng ON g.gpu_id IS NOT DISTINCT FROM rng.gpu_id AND g.w = rng.w GROUP BY ALL
""")

oracle("rollup_total_count", ("points",), f"""
SELECT gpu_id, CAST({_U0} AS BIGINT) AS window_start_ns, CAST({_U1} AS BIGINT) AS window_end_ns, count(*) AS points
FROM points WHERE timestamp_ns >= {_U0} AND timestamp_ns < {_U1} GROUP BY gpu_id
""")

oracle("sketched_series", ("points",), """
SELECT metric_name, count(DISTINCT series_id) AS series, true AS within_error FROM points GROUP BY metric_name
""")

oracle("sketched_quantiles", ("points",), """
SELECT metric_name, percent, count(value) AS points, true AS within_error
FROM points, (VALUES (50), (95), (99)) q(percent) WHERE value IS NOT NULL GROUP BY ALL
""")

# --- ledger shapes and long form -------------------------------------------------------------------------------------
oracle("requeue_ledger", _L, f"""
{_FA}
SELECT d.message_id, d.persist_key, {_TICK} AS requeued_ns, 'timeout' AS reason
FROM dispatches d LEFT JOIN fa ON d.message_id = fa.message_id
WHERE NOT coalesce(fa.ack_ns < {_TICK}, false)
""")

oracle("ready_after_requeue", _L, f"""
, d AS (SELECT *, {_TICK} AS tick FROM dispatches WHERE sent_ns <= {P.END_NS}),
done AS (SELECT DISTINCT d.persist_key FROM d JOIN acks a ON a.message_id = d.message_id AND a.ack_ns >= d.sent_ns AND a.ack_ns < d.tick
         WHERE a.ack_ns <= {P.END_NS}),
latest AS (SELECT persist_key, arg_max(tick, sent_ns) AS tick FROM d GROUP BY persist_key)
SELECT e.persist_key, CASE WHEN l.tick IS NULL THEN 'backlog' ELSE 'requeue' END AS source, coalesce(l.tick, e.enqueued_ns) AS ready_ns
FROM enqueues e LEFT JOIN latest l USING (persist_key)
WHERE e.outcome = 'enqueued' AND e.enqueued_ns <= {P.END_NS} AND e.persist_key NOT IN (SELECT persist_key FROM done)
  AND (l.tick IS NULL OR l.tick <= {P.END_NS})
""")

oracle("late_acks", _L, f"""
{_EFF}
SELECT a.message_id, a.ack_ns, {_TICK} AS requeue_tick_ns
FROM acks a JOIN dispatches d ON a.message_id = d.message_id AND a.ack_ns >= d.sent_ns
WHERE a.message_id <> '' AND d.message_id NOT IN (SELECT message_id FROM eff)
""")

oracle("fields_long", ("points",), """
SELECT persist_key, timestamp_ns, 'metric_name' AS _field, metric_name AS _value_string,
       CAST(NULL AS DOUBLE) AS _value_double FROM points
UNION ALL
SELECT persist_key, timestamp_ns, 'value', CAST(NULL AS VARCHAR), value FROM points
""")

# The stream reads the same files as the batch ingest, so the expected rows are the same.
ORACLE["stream_csv_ingest"] = ORACLE["csv_ingest"]

oracle("stream_stats", ("points",), """
SELECT count(*) AS points, count(*) FILTER (WHERE gpu_id IS NULL) AS points_without_gpu FROM points
""")

oracle("parse_value_rejects", ("telemetry",), f"""
, src AS (
  SELECT persist_key,
    CASE WHEN persist_key % 37 = 0 THEN 'NaN' WHEN persist_key % 41 = 0 THEN 'n/a' WHEN persist_key % 43 = 0 THEN '1e999'
         WHEN persist_key % 47 = 0 THEN ' ' || CAST(value AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS vtext
  FROM telemetry),
parsed AS (SELECT *, CASE WHEN regexp_full_match(vtext, '{_FLOAT_RE}') THEN TRY_CAST(vtext AS DOUBLE) END AS v FROM src)
SELECT persist_key, vtext AS value_text, CASE WHEN isfinite(v) THEN v END AS value,
  CASE WHEN regexp_full_match(lower(vtext), '[+-]?(inf|infinity|nan)') THEN 'not finite'
       WHEN NOT regexp_full_match(vtext, '{_FLOAT_RE}') THEN 'invalid value'
       WHEN v IS NULL OR NOT isfinite(v) THEN 'invalid value' END AS reject_reason
FROM parsed
""")

oracle("source_node_count", ("points",), """
SELECT count(DISTINCT source_node) AS distinct_source_node FROM points
""")

oracle("saturation_check", _L, f"""
, ev AS (SELECT persist_key, enqueued_ns AS event_ns, 1 AS delta, 'accept' AS kind FROM enqueues WHERE outcome = 'enqueued'
         UNION ALL
         SELECT e.persist_key, e.enqueued_ns + t.k * 60000000000, -1, 'dispatch'
         FROM enqueues e JOIN telemetry t ON e.persist_key = t.persist_key WHERE e.outcome = 'enqueued'
         UNION ALL
         SELECT persist_key, enqueued_ns, 0, 'refusal' FROM enqueues WHERE outcome = 'rejected'),
dep AS (SELECT kind, delta, sum(delta) OVER (ORDER BY event_ns, delta, persist_key, kind ROWS UNBOUNDED PRECEDING) AS depth
        FROM ev)
SELECT CASE WHEN kind = 'accept' THEN 'enqueued' ELSE 'rejected' END AS recorded,
       depth - delta >= {P.QUEUE_MAX} AS predicted_reject, count(*) AS sends
FROM dep WHERE kind IN ('accept', 'refusal') GROUP BY 1, 2
""")

oracle("partitioned_queue_depth", ("telemetry",), """
, acc AS (SELECT persist_key, timestamp_ns, k, CAST(TRY_CAST(gpu_id AS BIGINT) % 4 AS BIGINT) AS partition
          FROM telemetry WHERE persist_key % 50 <> 0 AND persist_key % 333 <> 0),
ev AS (SELECT partition, persist_key, timestamp_ns AS event_ns, 1 AS delta, 'accept' AS kind FROM acc
       UNION ALL SELECT partition, persist_key, timestamp_ns + k * 60000000000, -1, 'dispatch' FROM acc)
SELECT partition, persist_key, event_ns, CAST(delta AS INTEGER) AS delta, kind,
  CAST(sum(delta) OVER (PARTITION BY partition ORDER BY event_ns, delta, persist_key, kind
                        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth
FROM ev
""")

oracle("window_count_series", ("points",), f"""
, rng AS (SELECT series_id, timestamp_ns - timestamp_ns % {DAY} AS w FROM points WHERE timestamp_ns >= {P.START_NS} AND timestamp_ns < {P.END_NS}),
grid AS (SELECT s.series_id, r.range AS w FROM (SELECT DISTINCT series_id FROM rng) s,
         range({P.START_NS - P.START_NS % DAY}, {(P.END_NS - 1) - (P.END_NS - 1) % DAY + 1}, {DAY}) r)
SELECT g.series_id, greatest(g.w, {P.START_NS}) AS window_start_ns, least(g.w + {DAY}, {P.END_NS}) AS window_end_ns,
       count(rng.w) AS points
FROM grid g LEFT JOIN rng ON g.series_id IS NOT DISTINCT FROM rng.series_id AND g.w = rng.w GROUP BY ALL
""")

oracle("stamped_arrivals", ("telemetry",), """
SELECT persist_key, timestamp_ns AS recorded_ns, true AS arrived_later FROM telemetry
""")

oracle("resolved_times", ("telemetry",), f"""
SELECT persist_key, CASE WHEN persist_key % 11 = 0 THEN {P.NOW_NS} ELSE timestamp_ns END AS timestamp_ns FROM telemetry
""")

oracle("queue_depth_requeues", _L, f"""
{_FA},
ev AS (SELECT persist_key, enqueued_ns AS event_ns, 1 AS delta, 'accept' AS kind FROM enqueues WHERE outcome = 'enqueued'
       UNION ALL SELECT persist_key, sent_ns, -1, 'dispatch' FROM dispatches
       UNION ALL SELECT d.persist_key, {_TICK}, 1, 'requeue' FROM dispatches d LEFT JOIN fa ON d.message_id = fa.message_id
       WHERE NOT coalesce(fa.ack_ns < {_TICK}, false))
SELECT persist_key, event_ns, CAST(delta AS INTEGER) AS delta, kind,
       CAST(sum(delta) OVER (ORDER BY event_ns, delta, persist_key, kind ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth
FROM ev
""")

oracle("partition_depth_hash", ("points",), """
SELECT gpu_id, count(*) AS points, CAST(1 AS BIGINT) AS partitions, CAST(0 AS BIGINT) AS out_of_range FROM points GROUP BY gpu_id
""")

# Messages and rejects of the CSV rules (csv_ingest); the node added on ingest is the last of a repeated label, so it wins.
ORACLE["stream_csv_to_store"] = f"""WITH ingested AS (
{ORACLE["csv_ingest"]}
)
SELECT timestamp_ns, metric_name, value, CASE WHEN reject_reason IS NULL THEN 'node-a' END AS source_node, reject_reason FROM ingested"""

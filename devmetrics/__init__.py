"""devmetrics: device-metric and delivery-ledger analytics on Spark DataFrames and Structured Streaming.

The main entry points, by what the reference does:

- ingest: ``read_metrics_csv``, ``split_valid_rejects``, ``read_metrics_csv_stream``, ``ingest_csv_stream``
- points: ``build_points``, ``upsert_points``, ``write_points``, ``read_points``, ``write_points_stream``
- reads: ``telemetry_by_gpu``, ``list_gpus``, ``to_entries``, ``entries_to_json``
- counts: ``window_count``, ``continuity_gaps``, ``count_recent``, ``distinct_tag``, ``tag_keys``
- delivery: ``match_acks``, ``unacked``, ``expired_pending``, ``requeue_times``, ``queue_counters``,
  ``queue_depth``, ``sender_rollup``, ``read_backlog``, ``write_backlog``
- enrichment: ``attach_owner``, ``rolling_mean``, ``derivative``, ``latest_by_gpu``
"""

from devmetrics.operators.aggregates import continuity_gaps, count_recent, distinct_tag, latest_by_gpu, tag_keys, window_count
from devmetrics.operators.depth import depth_events, queue_depth
from devmetrics.operators.enrich import attach_owner, derivative, rolling_mean
from devmetrics.operators.ledger import expired_pending, match_acks, queue_counters, requeue_times, unacked
from devmetrics.operators.points import build_points, to_entries, upsert_points
from devmetrics.operators.reads import list_gpus, telemetry_by_gpu
from devmetrics.operators.sender import sender_rollup
from devmetrics.sources.backlog import read_backlog, write_backlog
from devmetrics.sources.csv import read_metrics_csv, split_valid_rejects
from devmetrics.sources.points_store import entries_to_json, read_points, write_points
from devmetrics.streaming.streams import ingest_csv_stream, read_metrics_csv_stream, write_points_stream

__version__ = "0.1.0"

__all__ = [
    "attach_owner", "build_points", "continuity_gaps", "count_recent", "depth_events", "derivative",
    "distinct_tag", "entries_to_json", "expired_pending", "ingest_csv_stream", "latest_by_gpu", "list_gpus",
    "match_acks", "queue_counters", "queue_depth", "read_backlog", "read_metrics_csv", "read_metrics_csv_stream",
    "read_points", "requeue_times", "rolling_mean", "sender_rollup", "split_valid_rejects", "tag_keys",
    "telemetry_by_gpu", "to_entries", "unacked", "upsert_points", "window_count", "write_backlog", "write_points",
    "write_points_stream",
]

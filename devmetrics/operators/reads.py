"""Range, equality and lookback reads, the GPU list and the flagship per-GPU read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.times import check_identifier, time_range_ns
from devmetrics.functions.values import NS_PER_DAY, NS_PER_HOUR, NS_PER_MINUTE, non_empty
from devmetrics.operators.points import DEFAULT_MEASUREMENT, to_entries, upsert_points


def filter_measurement(points: DataFrame, measurement: str = DEFAULT_MEASUREMENT) -> DataFrame:
    """B14."""
    return points.where(F.col("measurement") == measurement)


def filter_gpu(points: DataFrame, gpu_id: str) -> DataFrame:
    """Equality on the effective ``gpu_id`` tag (promoted column, so it reaches the Parquet scan)."""
    return points.where(F.col("gpu_id") == gpu_id)


def time_range(df: DataFrame, start_ns: int, end_ns: int, col: str = "timestamp_ns") -> DataFrame:
    """B16 filter: half-open ``[start, end)``; arguments checked with ``time_range_ns`` first."""
    if not end_ns > start_ns:
        raise ValueError("end_time must be after start_time")
    return df.where((F.col(col) >= start_ns) & (F.col(col) < end_ns))


def time_range_closed(df: DataFrame, start_ns: int | None = None, end_ns: int | None = None,
                      col: str = "timestamp_ns") -> DataFrame:
    """B17 (legacy): both ends optional and inclusive."""
    if start_ns is not None:
        df = df.where(F.col(col) >= start_ns)
    if end_ns is not None:
        df = df.where(F.col(col) <= end_ns)
    return df


def lookback(df: DataFrame, now_ns: int, days: int = 30, col: str = "timestamp_ns") -> DataFrame:
    """Points of the last ``days`` days up to ``now`` (``now`` is a parameter, so results repeat)."""
    return df.where((F.col(col) >= now_ns - days * NS_PER_DAY) & (F.col(col) < now_ns))


def apply_retention(df: DataFrame, now_ns: int, days: int = 30, col: str = "timestamp_ns") -> DataFrame:
    """Drop points older than the retention period (a plain filter; on the points store it prunes whole
    ``date`` partitions)."""
    return df.where(F.col(col) >= now_ns - days * NS_PER_DAY)


def list_gpus(points: DataFrame, now_ns: int, days: int = 30, measurement: str = DEFAULT_MEASUREMENT) -> DataFrame:
    """Distinct non-empty effective ``gpu_id`` of the last ``days`` days (partial + final hash aggregate)."""
    recent = filter_measurement(lookback(points, now_ns, days), measurement)
    return recent.select("gpu_id").where(non_empty(F.col("gpu_id"))).distinct()


def order_by_time(df: DataFrame, *tie_breakers: str) -> DataFrame:
    """ascending time with tie-breakers so the order is total (a range-partitioned sort, not one task)."""
    return df.orderBy("timestamp_ns", *tie_breakers)


def telemetry_by_gpu(points: DataFrame, gpu_id: str, start: str | int | None = None,
                     end: str | int | None = None, now_ns: int | None = None,
                     measurement: str = DEFAULT_MEASUREMENT, upsert_key: str = "metric") -> DataFrame:
    """F2, the flagship read: identifier and time checks on the driver (B19, B16), then range, measurement and GPU
    filters, last-write-wins (D9), open response rows (B21), ordered by time (F1)."""
    check_identifier(gpu_id)
    if now_ns is None and (start in (None, "") or end in (None, "")):
        raise ValueError("now_ns is required when start or end defaults to now")
    s, e = time_range_ns(start, end, now_ns or 0, NS_PER_HOUR)
    pts = filter_gpu(filter_measurement(time_range(points, s, e), measurement), gpu_id)
    latest = upsert_points(pts, key=upsert_key)
    return order_by_time(to_entries(latest), "metric_name", "value")


def telemetry_by_gpu_closed(points: DataFrame, gpu_id: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """B17 + B26 + F1: the legacy read: inclusive optional range, five fixed columns, ordered by time."""
    from devmetrics.functions.times import rfc3339_to_ns
    from devmetrics.operators.points import legacy_projection

    s = rfc3339_to_ns(start) if start else None
    e = rfc3339_to_ns(end) if end else None
    pts = time_range_closed(points.where(F.col("gpu_id") == gpu_id), s, e)
    return order_by_time(legacy_projection(pts), "metric_name", "value")


def points_around(points: DataFrame, gpu_id: str, t_ns: int, minutes: int = 5) -> DataFrame:
    """K8: one GPU's points within ``minutes`` either side of an instant (closed range)."""
    check_identifier(gpu_id)
    half = minutes * NS_PER_MINUTE
    return time_range_closed(filter_gpu(points, gpu_id), t_ns - half, t_ns + half)

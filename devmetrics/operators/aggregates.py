"""Counts over points: distinct tags, tag keys, per-tag counts, recent counts, epoch-aligned windows, continuity gaps,
latest point, write rate, silent GPUs (D2-D7, K6, K7, K13).

All are hash aggregates with map-side partial aggregation, so a hot tag value is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from devmetrics.functions.values import NS_PER_MINUTE, NS_PER_SECOND, truncate_ns
from devmetrics.operators.reads import time_range
from devmetrics.operators.sequence import previous_row
from devmetrics.session import materialize


def distinct_tag(points: DataFrame, key: str) -> DataFrame:
    """Distinct values of one tag (points without the tag are skipped)."""
    return points.select(F.col("tags").getItem(key).alias(key)).where(F.col(key).isNotNull()).distinct()


def distinct_tag_count(points: DataFrame, key: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """D2 as a size: number of distinct values of one tag; ``approx`` uses a fixed-size HyperLogLog++ sketch
    (memory independent of the number of values) instead of an exact distinct aggregate."""
    v = F.col("tags").getItem(key)
    n = F.approx_count_distinct(v, rsd) if approx else F.count_distinct(v)
    return points.agg(n.cast("long").alias(f"distinct_{key}"))


def tag_keys(points: DataFrame) -> DataFrame:
    """D3: the set of tag keys present."""
    return points.select(F.explode(F.map_keys("tags")).alias("tag_key")).distinct()


def count_by_tag(points: DataFrame, key: str) -> DataFrame:
    """Points per value of one tag (balance check); points without the tag count under null."""
    return points.groupBy(F.col("tags").getItem(key).alias(key)).agg(F.count(F.lit(1)).alias("points"))


def count_recent(points: DataFrame, now_ns: int, minutes: int = 5, by: Sequence[str] = ("series_id",)) -> DataFrame:
    """Points per group in ``[now - minutes, now)``."""
    recent = time_range(points, now_ns - minutes * NS_PER_MINUTE, now_ns)
    return recent.groupBy(*by).agg(F.count(F.lit(1)).alias("points"))


def _window_bounds(start_ns: int, stop_ns: int, every_ns: int) -> tuple[int, int]:
    first = start_ns - start_ns % every_ns
    last = (stop_ns - 1) - (stop_ns - 1) % every_ns
    return first, last


def window_count(points: DataFrame, every_ns: int, start_ns: int, stop_ns: int, by: Sequence[str] = ("gpu_id",),
                 create_empty: bool = True) -> DataFrame:
    """Points per group in tumbling windows aligned to the epoch, clipped to ``[start, stop)``.

    Output: ``by``, ``window_start_ns`` and ``window_end_ns`` (clipped; the end is the row's time, as the store
    stamps it), ``points``. With ``create_empty`` every group having a point in range gets every window, empty ones
    with 0: the grid rows (groups x windows, bounded by the range / ``every``) are unioned with the counts and
    summed in one aggregate, so there is no join.
    """
    rng = time_range(points, start_ns, stop_ns)
    ones = rng.select(*by, truncate_ns(F.col("timestamp_ns"), every_ns).alias("_w"), F.lit(1).cast("long").alias("_n"))
    counts = ones.groupBy(*by, "_w").agg(F.sum("_n").alias("points"))
    return filled_windows(counts, every_ns, start_ns, stop_ns, by, create_empty)


def filled_windows(counts: DataFrame, every_ns: int, start_ns: int, stop_ns: int, by: Sequence[str], create_empty: bool) -> DataFrame:
    """Counts per group and window start (``by``, ``_w``, points) as the rows of ``window_count``."""
    if create_empty:
        # The grid's groups come from the counts (one row per group and non-empty window), so the points are read
        # once; the grid rows (groups x windows) are summed with the counts in one small aggregate, no join.
        first, last = _window_bounds(start_ns, stop_ns, every_ns)
        counts = materialize(counts, "window-counts")  # small (groups x windows); read twice, computed once
        grid = counts.select(*by).distinct().select(
            *by, F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(every_ns))).alias("_w"),
            F.lit(0).cast("long").alias("points"),
        )
        counts = counts.unionByName(grid).groupBy(*by, "_w").agg(F.sum("points").alias("points"))
    return counts.select(
        *by,
        F.greatest(F.col("_w"), F.lit(start_ns)).alias("window_start_ns"),
        F.least(F.col("_w") + every_ns, F.lit(stop_ns)).alias("window_end_ns"),
        "points",
    )


def continuity_gaps(points: DataFrame, every_ns: int, start_ns: int, stop_ns: int,
                    by: Sequence[str] = ("gpu_id",)) -> DataFrame:
    """Runs of consecutive empty windows (lost data) per group, merged: ``gap_start_ns``, ``gap_end_ns``
    (clipped window bounds) and ``empty_windows``.

    Works on non-empty window starts only: for each one the previous non-empty window of the group (a lag over
    one row per window, not per point), with virtual windows just before the first and after the last window so
    leading and trailing gaps appear too.
    """
    rng = time_range(points, start_ns, stop_ns)
    nonempty = rng.select(*by, truncate_ns(F.col("timestamp_ns"), every_ns).alias("_first")).distinct()
    return empty_runs(nonempty.withColumn("_last", F.col("_first")), every_ns, start_ns, stop_ns, by)


def empty_runs(full: DataFrame, every_ns: int, start_ns: int, stop_ns: int, by: Sequence[str]) -> DataFrame:
    """The runs between runs of non-empty windows (``by``, ``_first``, ``_last``, which meet at their ends at most) as the
    rows of ``continuity_gaps``."""
    first, last = _window_bounds(start_ns, stop_ns, every_ns)
    full = materialize(full, "nonempty-windows")  # small (groups x windows); read twice, computed once
    edge = F.explode(F.array(F.lit(first - every_ns), F.lit(last + every_ns)))
    edges = full.select(*by).distinct().select(*by, edge.alias("_first")).withColumn("_last", F.col("_first"))
    w = Window.partitionBy(*by).orderBy("_first", "_last")
    steps = full.unionByName(edges).select(*by, F.lag("_last").over(w).alias("_prev"), "_first")
    gaps = steps.where(F.col("_first") - F.col("_prev") > every_ns)
    return gaps.select(
        *by,
        F.greatest(F.col("_prev") + every_ns, F.lit(start_ns)).alias("gap_start_ns"),
        F.least(F.col("_first"), F.lit(stop_ns)).alias("gap_end_ns"),
        (F.call_function("div", F.col("_first") - F.col("_prev"), F.lit(every_ns)) - 1).cast("long").alias("empty_windows"),
    )


def latest_by_gpu(points: DataFrame) -> DataFrame:
    """K7: the latest point of every GPU and metric (ties in time broken by the ingest sequence)."""
    latest = points.where(F.col("gpu_id").isNotNull()).groupBy("gpu_id", F.col("fields.metric_name").alias("metric_name")).agg(
        F.max_by(F.struct("timestamp_ns", F.col("fields.value").alias("value"), "persist_key"),
                 F.struct("timestamp_ns", "persist_key")).alias("_l")
    )
    return latest.select("gpu_id", "metric_name", "_l.timestamp_ns", "_l.value", "_l.persist_key")


def write_rate(points: DataFrame, every_ns: int, by: Sequence[str] = ("source_node",)) -> DataFrame:
    """Points per second in each epoch-aligned bucket, per group (for example per source node)."""
    counts = points.groupBy(*by, truncate_ns(F.col("timestamp_ns"), every_ns).alias("bucket_ns")).agg(
        F.count(F.lit(1)).alias("points")
    )
    return counts.withColumn("points_per_second", F.col("points") / F.lit(every_ns / NS_PER_SECOND))


def gpu_down(points: DataFrame, now_ns: int, threshold_ns: int) -> DataFrame:
    """K6 (state now): last point per GPU and whether it has been silent longer than the threshold."""
    last = points.where(F.col("gpu_id").isNotNull()).groupBy("gpu_id").agg(F.max("timestamp_ns").alias("last_seen_ns"))
    return last.select(
        "gpu_id", "last_seen_ns", (F.lit(now_ns) - F.col("last_seen_ns")).alias("silent_ns"),
        (F.lit(now_ns) - F.col("last_seen_ns") > threshold_ns).alias("is_down"),
    )


def gpu_silences(points: DataFrame, threshold_ns: int, bucket_ns: int, materialize_input: bool = False, split_rows: int | None = None) -> DataFrame:
    """K6 (history): closed silences, i.e. consecutive points of one GPU further apart than the threshold."""
    p = points.where(F.col("gpu_id").isNotNull()).select("gpu_id", "timestamp_ns", "persist_key")
    withprev = previous_row(p, ["gpu_id"], "timestamp_ns", "persist_key", [], bucket_ns, materialize=materialize_input, split_rows=split_rows)
    gaps = withprev.where(F.col("timestamp_ns") - F.col("prev_timestamp_ns") > threshold_ns)
    return gaps.select(
        "gpu_id", F.col("prev_timestamp_ns").alias("silent_from_ns"), F.col("timestamp_ns").alias("silent_to_ns"),
        (F.col("timestamp_ns") - F.col("prev_timestamp_ns")).alias("silent_ns"),
    )

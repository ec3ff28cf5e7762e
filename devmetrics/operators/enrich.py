"""Enrichment of points named by the reference's documents (K1-K5, K9).

Joins with parameter tables (allowlists, model tiers) carry no hint: Spark broadcasts a side by its measured size.
Per-GPU ordered work goes through ``devmetrics.operators.sequence``, which splits a hot GPU by time bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.values import NS_PER_SECOND, truncate_ns
from devmetrics.operators.sequence import asof_join, previous_row, rolling_agg, rolling_sums
from devmetrics.session import materialize


def attach_owner(points: DataFrame, assignments: DataFrame, bucket_ns: int, key: str = "gpu_id", split_rows: int | None = None) -> DataFrame:
    """K1: who owned the GPU at each point's time: the latest assignment at or before it (as-of join), or null. Of
    assignments of one time, the owner who is last in the order of names."""
    a = assignments.select(F.col("gpu_id").alias(key), "from_ns", "owner")
    tiebreak = "persist_key" if "persist_key" in points.columns else None
    return asof_join(points, a, [key], "timestamp_ns", "from_ns", ["owner"], bucket_ns, split_rows=split_rows, tiebreak=tiebreak)


def rolling_mean(points: DataFrame, width_ns: int, bucket_ns: int, keys: tuple[str, ...] = ("gpu_id", "metric_name"),
                 split_rows: int | None = None) -> DataFrame:
    """K2: mean of the trailing ``width`` (``(t - width, t]``) per GPU and metric, and the number of points in it.

    A window over the rows of a (GPU, metric, bucket) holds them in one task and adds up every range anew. With
    ``split_rows``, GPUs and metrics that have more rows than that in a bucket take ``rolling_sums`` instead, whose
    largest task doesn't depend on them; the others stay as they are. (Both give the mean of the same values; the
    order of addition may show in the last digit.)"""
    means = {"rolling_mean": F.avg("value"), "window_points": F.count(F.lit(1))}
    plain = lambda rows: rolling_agg(rows, list(keys), "timestamp_ns", width_ns, means, bucket_ns)
    if not split_rows:
        return plain(points)
    key = F.struct(*[F.col(k) for k in keys])
    counts = points.groupBy(key.alias("_key"), truncate_ns(F.col("timestamp_ns"), max(bucket_ns, width_ns))).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(counts.where(F.col("_n") > split_rows).select("_key").distinct(), "rolling-hot")
    if hot.isEmpty():
        return plain(points)
    rows = points.withColumn("_key", key)
    busy = rows.join(hot, "_key", "left_semi")
    sums = rolling_sums(busy, keys, "timestamp_ns", "value", width_ns, bucket_ns, split_rows)
    sums = sums.select(F.struct(*[F.col(k) for k in keys], "timestamp_ns").alias("_at"), F.col("_mean").alias("rolling_mean"), F.col("_points").alias("window_points"))
    found = busy.withColumn("_at", F.struct(*[F.col(k) for k in keys], "timestamp_ns")).join(sums, "_at")
    rest = plain(rows.join(hot, "_key", "left_anti").select(*points.columns))
    return rest.unionByName(found.select(*rest.columns))


def allow_namespaces(points: DataFrame, allowlist: DataFrame) -> DataFrame:
    """K3: points whose namespace is on the allowlist (left semi join)."""
    return points.join(allowlist.select("namespace").distinct(), "namespace", "left_semi")


def map_sla_tier(points: DataFrame, model_tiers: DataFrame, default_tier: str = "standard",
                 model_col: str = "model_name") -> DataFrame:
    """K4: SLA tier by model list; models not in the table get the default tier. A model that is listed more than
    once has the tier that comes first in the order of names: every point stays one row."""
    tiers = model_tiers.groupBy(F.col("model_name_csv").alias(model_col)).agg(F.min("tier").alias("tier"))
    joined = points.join(tiers, model_col, "left")
    return joined.withColumn("tier", F.coalesce(F.col("tier"), F.lit(default_tier)))


def derivative(points: DataFrame, bucket_ns: int, keys: tuple[str, ...] = ("gpu_id", "metric_name"),
               tiebreak: str = "persist_key", split_rows: int | None = None) -> DataFrame:
    """K5: change per second against the previous point of the same GPU and metric; null for the first point and
    when both points share a time."""
    p = previous_row(points, list(keys), "timestamp_ns", tiebreak, ["value"], bucket_ns, split_rows=split_rows)
    dt = F.col("timestamp_ns") - F.col("prev_timestamp_ns")
    rate = F.when(dt != 0, (F.col("value") - F.col("prev_value")) / (dt / F.lit(float(NS_PER_SECOND))))
    return p.withColumn("per_second", rate)


def partition_of(col: str, n: int, method: str = "hash") -> F.Column:
    """K9: stable partition number of a key: ``hash`` = xxhash64 of the key modulo ``n``; ``integer`` = the key read
    as an integer modulo ``n`` (null when it is not one)."""
    if method == "hash":
        return F.pmod(F.xxhash64(F.col(col)), F.lit(n))
    if method == "integer":
        return F.pmod(F.col(col).try_cast("long"), F.lit(n))
    raise ValueError("method must be 'hash' or 'integer'")


def partition_depth(points: DataFrame, n: int, key: str = "gpu_id", method: str = "hash") -> DataFrame:
    """K9: points per partition when keys are spread over ``n`` partitions."""
    return points.groupBy(partition_of(key, n, method).alias("partition")).agg(F.count(F.lit(1)).alias("points"))

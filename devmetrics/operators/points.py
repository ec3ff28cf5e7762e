"""Messages -> points, last-write-wins upsert, and the entry / pivot shapes of a read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devmetrics.functions.labels import (build_tags, effective_model_tag, effective_tag, label_entries,
                                         labels_from_entries, series_key)
from devmetrics.functions.values import resolve_time

DEFAULT_MEASUREMENT = "gpu_metrics"

# Tags are also promoted to real columns beside the map (gpu_id, device, uuid, namespace, model_name, source_node):
# map values are not pruned or pushed down to Parquet, columns are.


def build_fields(metric_name: Column, value: Column) -> Column:
    """The two fields every point carries."""
    return F.struct(metric_name.alias("metric_name"), value.alias("value"))


def series_id(tags: Column) -> Column:
    """Readable text of a tag set (``k1=v1,k2=v2`` sorted by key); for output and display only -- it is not
    injective (values may hold ',' or '='), so grouping uses ``series_key``."""
    return F.array_join(F.transform(F.sort_array(F.map_entries(tags)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def build_points(telemetry: DataFrame, measurement: str = DEFAULT_MEASUREMENT, arrival_ns: Column | None = None) -> DataFrame:
    """One point per message: measurement, tags (B7 + B8), fields (B10) and time.

    ``persist_key`` is kept as the ingest sequence used by last-write-wins. A narrow projection: no shuffle.
    """
    staged = telemetry.select("*", label_entries(F.col("labels_raw")).alias("_kv"))
    kv = F.col("_kv")
    tags = build_tags(
        labels_from_entries(kv), F.col("gpu_id"), F.col("device"), F.col("uuid"), F.col("namespace"),
        F.col("model_name"),
    )
    # Promoted tags come straight from the entries, so a query reading only them never builds the map.
    promoted = [effective_tag(kv, t, F.col(t)).alias(t) for t in ("gpu_id", "device", "uuid", "namespace")]
    promoted += [effective_model_tag(kv, F.col("model_name")).alias("model_name"),
                 F.try_element_at(F.filter(kv, lambda e: e["k"] == "source_node"), F.lit(-1))["v"].alias("source_node")]
    pts = staged.select(
        F.col("persist_key"),
        F.lit(measurement).alias("measurement"),
        resolve_time(F.col("timestamp_ns"), arrival_ns).alias("timestamp_ns"),
        tags.alias("tags"),
        build_fields(F.col("metric_name"), F.col("value")).alias("fields"),
        *promoted,
    )
    return pts.select("*", series_id(F.col("tags")).alias("series_id"))


def upsert_points(points: DataFrame, key: str = "metric", seq_col: str | Sequence[str] = "persist_key",
                  time_col: str = "timestamp_ns", tag_col: str = "tags") -> DataFrame:
    """One point per (measurement, tag set, time) -- plus ``fields.metric_name`` when ``key='metric'`` --
    keeping the last write (highest ``seq_col``).

    ``key='influx'`` is the store's literal rule; ``key='metric'`` (default) also keeps different metrics written
    at the same instant apart. One sort by key and sequence: Spark keeps only the last row of each key per task before
    the shuffle, so repeated writes of a hot key collapse there, and again after it (5 to 10 % faster than ``max_by``
    over a struct, which sorts as well, at sf0.1 with one copy and with eight). ``seq_col`` may list several columns,
    compared in order (for example ``["batch_id", "persist_key"]`` for rows ingested by a stream).
    """
    if key not in ("metric", "influx"):
        raise ValueError("key must be 'metric' or 'influx'")
    keyed = points.withColumn("_series", series_key(F.col(tag_col)))
    keys = ["measurement", "_series", time_col]
    if key == "metric":
        keyed, keys = keyed.withColumn("_metric", F.col("fields.metric_name")), [*keys, "_metric"]
    seq = [seq_col] if isinstance(seq_col, str) else list(seq_col)
    last = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in seq])
    return keyed.withColumn("_n", F.row_number().over(last)).where(F.col("_n") == 1).select(*points.columns)


def sorted_tags(tags: Column) -> Column:
    """The tag map in the order of its keys."""
    return F.map_from_entries(F.sort_array(F.map_entries(tags)))


def entry_json(timestamp_ns: Column, measurement: Column, tags: Column, metric_name: Column, value: Column) -> Column:
    """B21 as text: one JSON object with the fixed columns first and then every tag that is present, in the order of
    its keys. Absent values are left out; a tag named like a fixed column gives way to it."""
    fixed = F.to_json(F.struct(timestamp_ns.alias("timestamp_ns"), measurement.alias("measurement"),
                               metric_name.alias("metric_name"), value.alias("value")))
    own = F.map_filter(tags, lambda k, v: v.isNotNull() & ~k.isin("timestamp_ns", "measurement", "metric_name", "value"))
    more = F.to_json(sorted_tags(own))
    return F.when(F.size(own) > 0, F.concat(F.substring(fixed, F.lit(1), F.length(fixed) - 1), F.lit(","),
                                            F.substring(more, F.lit(2), F.length(more)))).otherwise(fixed)


def to_entries(points: DataFrame) -> DataFrame:
    """Response rows: the fixed columns and ``entry``, the open row as JSON (whatever tags a point has)."""
    metric, value = F.col("fields.metric_name"), F.col("fields.value")
    return points.select(
        "timestamp_ns", "measurement", F.col("gpu_id"), metric.alias("metric_name"), value.alias("value"),
        entry_json(F.col("timestamp_ns"), F.col("measurement"), F.col("tags"), metric, value).alias("entry"))


def widen_tags(df: DataFrame, keys: Sequence[str], tag_col: str = "tags") -> DataFrame:
    """Each named tag key as its own column (null when absent). The keys are the caller's choice, so the schema
    is fixed before the job runs; an open key set stays in the map (``to_entries`` gives all of it)."""
    return df.select("*", *[F.col(tag_col).getItem(k).alias(k) for k in keys])


def unpivot_fields(points: DataFrame) -> DataFrame:
    """The store's long shape, one row per field: (persist_key, measurement, tags, timestamp_ns, _field,
    _value_string, _value_double). Typed value columns: no text round trip. One pass (explode), not a self-union."""
    fields = F.array(
        F.struct(F.lit("metric_name").alias("_field"), F.col("fields.metric_name").alias("_value_string"),
                 F.lit(None).cast("double").alias("_value_double")),
        F.struct(F.lit("value").alias("_field"), F.lit(None).cast("string").alias("_value_string"),
                 F.col("fields.value").alias("_value_double")),
    )
    return points.select("persist_key", "measurement", "tags", "timestamp_ns", F.explode(fields).alias("_f")).select(
        "persist_key", "measurement", "tags", "timestamp_ns", "_f._field", "_f._value_string", "_f._value_double")


def pivot_fields(long_df: DataFrame, row_key: Sequence[str] = ("persist_key",)) -> DataFrame:
    """One row per series and time with one column per field (known field list: no discovery job).

    Grouped by the series key, the time and ``row_key`` (the store's rows are unique per series and time; the extra
    key keeps writes that collided apart before upsert)."""
    return long_df.groupBy(
        "measurement", series_key(F.col("tags")).alias("_series"), "timestamp_ns", *row_key
    ).agg(
        F.first("tags").alias("tags"),
        F.max(F.when(F.col("_field") == "metric_name", F.col("_value_string"))).alias("metric_name"),
        F.max(F.when(F.col("_field") == "value", F.col("_value_double"))).alias("value"),
    ).drop("_series")


def legacy_projection(points: DataFrame) -> DataFrame:
    """The fixed five-column legacy row; a missing value becomes the type's zero value."""
    return points.select(
        F.col("timestamp_ns"),
        F.coalesce(F.col("fields.metric_name"), F.lit("")).alias("metric_name"),
        F.coalesce(F.col("gpu_id"), F.lit("")).alias("gpu_id"),
        F.coalesce(F.col("device"), F.lit("")).alias("device"),
        F.coalesce(F.col("fields.value"), F.lit(0.0)).alias("value"),
    )

"""Durable backlog as JSON lines (A3, A4): one object per un-acked message, the queue's recovery input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The backlog record's keys (lower case, snake case) and their types.
BACKLOG_SCHEMA = T.StructType([
    T.StructField("persist_key", T.LongType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("gpu_id", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("uuid", T.StringType()),
    T.StructField("model_name", T.ArrayType(T.StringType())),
    T.StructField("namespace", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("labels_raw", T.StringType()),
])
_CORRUPT = "_corrupt_record"


def write_backlog(telemetry: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: write messages as JSON objects with the backlog's key names."""
    telemetry.select(
        "persist_key", F.col("timestamp_ns").alias("timestamp"), "metric_name", "gpu_id", "device", "uuid",
        "model_name", "namespace", "value", "labels_raw",
    ).write.mode(mode).json(path)


def read_backlog(spark: SparkSession, path: str, with_position: bool = False) -> DataFrame:
    """A3: read backlog records, skipping corrupt lines and records with a value of a wrong type.

    Absent values are the type's zero value (0, 0.0, '', an empty list), as the record's plain fields have it.
    Returns canonical telemetry columns. Recovery order is ascending ``persist_key``; ``with_position`` adds it as
    a 1-based ``position`` (E4, a distributed running count). Records that repeat a key keep one row and one position
    each, in an order among them that isn't fixed."""
    parsed = spark.read.text(path).where(F.trim("value") != "").select(
        F.from_json("value", T.StructType([*BACKLOG_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())]),
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("r")
    ).select("r.*")
    good = parsed.where(F.col(_CORRUPT).isNull())
    zero = F.lit(0).cast("long")
    out = good.select(
        F.coalesce("persist_key", zero).alias("persist_key"), F.coalesce("timestamp", zero).alias("timestamp_ns"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("metric_name", "gpu_id", "device", "uuid")],
        F.coalesce(F.col("model_name"), F.array().cast("array<string>")).alias("model_name"),
        F.coalesce(F.col("namespace"), F.lit("")).alias("namespace"), F.coalesce("value", F.lit(0.0)).alias("value"),
        F.coalesce(F.col("labels_raw"), F.lit("")).alias("labels_raw"),
    )
    if with_position:
        from devmetrics.operators.depth import fifo_order

        out = fifo_order(out)
    return out

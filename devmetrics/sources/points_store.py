"""Points store on Parquet (A5, A7) and JSON response rows.

Layout: ``measurement=<m>/date=<UTC date>/`` partitions, rows sorted by (gpu_id, timestamp_ns) inside each file,
so a time range prunes whole date folders and a GPU filter skips row groups by min/max statistics. Writes are
append-only; duplicates (redelivery) are resolved at read time with last-write-wins (D9), which makes a retried
write harmless.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.functions.values import NS_PER_DAY, ns_to_utc_date


def write_points(points: DataFrame, path: str, mode: str = "append", partitions: int | None = None,
                 gpu_bloom_filter: bool = True) -> None:
    """A5: write points partitioned by measurement and UTC date.

    Range partitioning on (measurement, date, gpu_id, timestamp_ns) samples the keys, so a busy day or a hot GPU
    is split over several tasks (the time column breaks ties) instead of landing in one task per date. Rows are
    sorted by GPU and time inside each file, so row-group min/max statistics skip other GPUs; a Parquet bloom
    filter on ``gpu_id`` catches the rest of a point lookup (Parquet writes it where the column chunk is not fully
    dictionary-encoded -- with few GPUs per chunk the dictionary already serves the same purpose)."""
    keys = ["measurement", "date", "gpu_id", "timestamp_ns"]
    dated = points.withColumn("date", ns_to_utc_date(F.col("timestamp_ns")))
    ranged = dated.repartitionByRange(partitions, *keys) if partitions else dated.repartitionByRange(*keys)
    w = ranged.sortWithinPartitions(*keys).write.mode(mode).partitionBy("measurement", "date")
    if gpu_bloom_filter and "gpu_id" in points.columns:
        w = w.option("parquet.bloom.filter.enabled#gpu_id", "true")
    w.parquet(path)


def utc_date(ns: int) -> dt.date:
    return dt.date(1970, 1, 1) + dt.timedelta(days=ns // NS_PER_DAY)


def read_points(spark: SparkSession, path: str, start_ns: int | None = None, stop_ns: int | None = None,
                measurement: str | None = None) -> DataFrame:
    """Scan the store for ``[start, stop)`` and one measurement.

    With a measurement and both ends given, the ``date=`` folders of the range are named to the reader (a pattern
    per day under ``basePath``; days without points are skipped), so folders outside it aren't even listed. In any
    case the range is also stated on the ``date`` partition column, which prunes what is read (Catalyst can't derive
    it from the ns predicate)."""
    df = _days(spark, path, start_ns, stop_ns, measurement)
    if measurement is not None:
        df = df.where(F.col("measurement") == measurement)
    if start_ns is not None:
        df = df.where((F.col("date") >= F.lit(utc_date(start_ns))) & (F.col("timestamp_ns") >= start_ns))
    if stop_ns is not None:
        df = df.where((F.col("date") <= F.lit(utc_date(stop_ns - 1))) & (F.col("timestamp_ns") < stop_ns))
    return df


def _days(spark: SparkSession, path: str, start_ns: int | None, stop_ns: int | None, measurement: str | None) -> DataFrame:
    if measurement is None or start_ns is None or stop_ns is None or stop_ns <= start_ns:
        return spark.read.parquet(path)
    days = [utc_date(start_ns) + dt.timedelta(days=i) for i in range((utc_date(stop_ns - 1) - utc_date(start_ns)).days + 1)]
    jvm = spark.sparkContext._jvm
    folders = [f"{path}/measurement={measurement}/date={d}" for d in days]
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [f for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f))]
    if not there:
        return spark.read.parquet(path)
    return spark.read.option("basePath", path).parquet(*there)


def entries_to_json(df: DataFrame, cols: list[str] | None = None) -> Column:
    """One JSON object per row; absent (null) keys are omitted."""
    return F.to_json(F.struct(*(cols or df.columns)), {"ignoreNullFields": "true"})


def write_entries_json(df: DataFrame, path: str) -> None:
    """A8 as files: JSON lines, null keys omitted (an empty result writes no rows)."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def compact_points(spark: SparkSession, src: str, dst: str, key: str = "metric") -> None:
    """Store compaction: every point of ``src`` (batch folders from streams, repeated writes from redelivery)
    reduced to its last write (D9) and rewritten to a new store ``dst`` with the same layout. A batch job over a
    new directory: readers keep using ``src`` until they are pointed at ``dst``."""
    from devmetrics.operators.points import upsert_points

    pts = spark.read.parquet(src)
    seq = ["batch_id", "persist_key"] if "batch_id" in pts.columns else ["persist_key"]
    latest = upsert_points(pts.drop("date"), key=key, seq_col=seq)
    write_points(latest.drop("batch_id") if "batch_id" in latest.columns else latest, dst, mode="overwrite")

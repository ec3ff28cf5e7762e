"""Streams whose cost follows the micro-batch and what is still open, not all history.

State lives in tables, one version per micro-batch: batch ``n`` reads the version of the batch before it and writes its
own in overwrite mode. A replayed batch thus reads the same version and writes the same one again.

Files may arrive in any order. What can't be told without knowing how late they may be is kept by default, and dropped
only beyond a ``max_delay_ns`` that the caller states.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.functions.values import non_empty, ns_to_utc_date

LEDGER = "side string, message_id string, persist_key long, at_ns long"
DELIVERY, ACK = "delivery", "ack"
#: Parts of a day's keys; a batch reads those that its own keys fall into.
KEY_BUCKETS = 4


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were written to the end."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath().toString() for s in fs.listStatus(p)]
    return sorted(int(f.rpartition("=")[2]) for f in found if "/v=" in f and exists(spark, f"{f}/_SUCCESS"))


def ledger_rows(dispatches: DataFrame, acks: DataFrame) -> DataFrame:
    """Both sides of the ledger as one stream (or table), for ``open_deliveries_writer``."""
    d = dispatches.select(F.lit(DELIVERY).alias("side"), "message_id", "persist_key", F.col("sent_ns").alias("at_ns"))
    a = acks.select(F.lit(ACK).alias("side"), "message_id", F.lit(None).cast("long").alias("persist_key"), F.col("ack_ns").alias("at_ns"))
    return d.unionByName(a)


def open_deliveries_writer(path: str, timeout_ns: int, max_delay_ns: int | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer over ``ledger_rows`` that carries the open deliveries.

    A version (``path/state/v=n``) holds the deliveries without an ack within ``timeout`` of their sending so far, and
    the acks for which no delivery is open, as their delivery may be in a later file: version ``n`` is that before it,
    with the batch's rows, less what has found its match. An ack that comes too late for an open delivery has no effect.

    With ``max_delay_ns`` (no row arrives later than that, by event time, after the newest one) deliveries that no ack can
    complete any more go to ``path/expired/batch_id=n``, once, and acks that old are forgotten; without it, both stay
    and the result is exact for any order. A state of more than one version back is deleted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [v for v in _versions(spark, f"{path}/state") if v < batch_id]
        new = batch.where(non_empty(F.col("message_id"))).select("side", "message_id", "persist_key", "at_ns")
        rows = new.unionByName(spark.read.schema(LEDGER).parquet(f"{path}/state/v={before[-1]}")) if before else new
        rows = rows.persist()
        try:
            carry(batch, batch_id, rows, before)
        finally:
            rows.unpersist()

    def carry(batch: DataFrame, batch_id: int, rows: DataFrame, before: list[int]) -> None:
        spark = batch.sparkSession
        deliveries = rows.where(F.col("side") == DELIVERY).select("message_id", "persist_key", F.col("at_ns").alias("sent_ns"))
        acks = rows.where(F.col("side") == ACK).select("message_id", F.col("at_ns").alias("ack_ns"))
        in_time = (F.col("ack_ns") >= F.col("sent_ns")) & (F.col("ack_ns") <= F.col("sent_ns") + timeout_ns)
        done = deliveries.join(acks, "message_id").where(in_time).select("message_id")
        still = deliveries.join(done, "message_id", "left_anti")
        waiting = acks.join(deliveries.select("message_id"), "message_id", "left_anti")
        newest = None
        if max_delay_ns is not None:
            clock = f"{path}/clock"
            batch.agg(F.max("at_ns").alias("newest")).write.mode("overwrite").parquet(f"{clock}/batch_id={batch_id}")
            newest = spark.read.parquet(clock).where(F.col("batch_id") <= batch_id).agg(F.max("newest")).first()[0]
        if newest is not None:
            over = F.col("sent_ns") + timeout_ns + max_delay_ns < newest
            expired = still.where(over).select("message_id", "persist_key", "sent_ns")
            expired.write.mode("overwrite").parquet(f"{path}/expired/batch_id={batch_id}")
            still, waiting = still.where(~over), waiting.where(F.col("ack_ns") + max_delay_ns >= newest)
        state = ledger_rows(still, waiting)
        state.write.mode("overwrite").parquet(f"{path}/state/v={batch_id}")
        for old in before[:-1]:
            fs, p = _path(spark, f"{path}/state/v={old}")
            fs.delete(p, True)

    return write


def open_deliveries(spark: SparkSession, path: str, timeout_ns: int, as_of_ns: int | None = None) -> DataFrame:
    """Read side of I1: the deliveries that timed out by ``as_of`` (None: whenever), as (message_id, persist_key,
    sent_ns, reason): those expired, and those open in the last version."""
    last = _versions(spark, f"{path}/state")
    kinds = "message_id string, persist_key long, sent_ns long"
    found = spark.createDataFrame([], kinds)
    if last:
        state = spark.read.schema(LEDGER).parquet(f"{path}/state/v={last[-1]}").where(F.col("side") == DELIVERY)
        found = state.select("message_id", "persist_key", F.col("at_ns").alias("sent_ns"))
    if exists(spark, f"{path}/expired"):
        found = found.unionByName(spark.read.schema(kinds).parquet(f"{path}/expired").select("message_id", "persist_key", "sent_ns"))
    if as_of_ns is not None:
        found = found.where(F.lit(as_of_ns) - F.col("sent_ns") > timeout_ns)
    return found.select("message_id", "persist_key", "sent_ns", F.lit("timeout").alias("reason"))


def touched_segments(spark: SparkSession, path: str, places: Sequence[tuple[str, int]]) -> list[str]:
    """Folders of the key table that a batch with keys in ``places`` (date, bucket) reads."""
    def folders(parent: str) -> set[str]:
        fs, p = _path(spark, parent)
        return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()

    there = {d: folders(f"{path}/{d}") for d in folders(path) & {f"date={d}" for d, _ in places}}
    return [f"{path}/date={d}/bucket={b}" for d, b in places if f"bucket={b}" in there.get(f"date={d}", ())]


def first_copies_writer(path: str, sink: Callable[[DataFrame, int], None], key: Sequence[str] = ("series_id", "timestamp_ns", "metric_name"),
                        seq: str = "persist_key", buckets: int = KEY_BUCKETS) -> Callable[[DataFrame, int], None]:
    """I3, exact and before the sink: a ``foreachBatch`` writer that hands ``sink`` only rows whose key no earlier batch
    had (of copies within a batch, that with the least ``seq``). No watermark: copies may arrive whenever.

    Digests of the keys written so far are kept by date of the point and hash bucket, ``path/date=d/bucket=b/batch=n``;
    a batch reads only the folders that its own rows fall into, however many others there are. The sink is written
    first. A replayed batch doesn't look at its own digests, and writes the same rows and digests again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        text = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
        digest = F.md5(F.concat(*[text(c) for c in key]))
        rows = batch.select(F.struct(*batch.columns).alias("_r"), digest.alias("_key"), F.col(seq).alias("_seq"),
                            ns_to_utc_date(F.col("timestamp_ns")).cast("string").alias("_date"))
        first = rows.groupBy("_key", "_date").agg(F.min_by("_r", "_seq").alias("_r"))
        first = first.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")).persist()
        try:
            places = [(r[0], r[1]) for r in first.select("_date", "_bucket").distinct().collect()]  # days of the batch, times buckets
            known = touched_segments(spark, path, places)
            if known:
                seen = spark.read.schema("key string, batch int").option("basePath", path).parquet(*known)
                new = first.join(seen.where(F.col("batch") < batch_id).select(F.col("key").alias("_key")), "_key", "left_anti")
            else:
                new = first
            sink(new.select("_r.*"), batch_id)
            keys = new.select(F.col("_key").alias("key"), F.col("_date").alias("date"), F.col("_bucket").alias("bucket"), F.lit(batch_id).alias("batch"))
            (keys.repartition("date", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("date", "bucket", "batch").parquet(path))
        finally:
            first.unpersist()

    return write

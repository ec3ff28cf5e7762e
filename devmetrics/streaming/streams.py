"""Structured Streaming forms of ingest, delivery and counting.

Sources are file streams (new files are new data); sinks are ``foreachBatch`` writers that put each micro-batch
into its own ``batch_id=<n>`` folder in overwrite mode, so a replayed batch (after a lost executor or a restart)
replaces its own output instead of adding to it. The checkpoint commit plays the role of the ack: a batch counts
as delivered only once its files are written. Duplicates across batches are resolved at read time (D9).

Files arrive in any order, so no exact result here depends on a watermark: counts are kept per micro-batch and
summed at read (I4), duplicates are written and resolved at read (I3), deliveries and acks are stored as they come
and matched at read (I1). The watermark forms beside them bound their state and drop what comes later than that;
``late_rows_writer`` keeps such rows. Forms whose cost doesn't grow with history are in ``carried``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from devmetrics.functions.values import NS_PER_US, ns_to_timestamp, truncate_ns
from devmetrics.operators.points import build_points
from devmetrics.sources.csv import LINE_OPTIONS, map_record, parse_lines

EVENT_TIME = "event_time"


def table_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a file stream: a folder of files, or a single file."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    single = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isFile()
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if single:  # a file source takes folders: the file's own, with all other names filtered out
        folder, _, name = path.rstrip("/").rpartition("/")
        return r.option("pathGlobFilter", name).parquet(folder)
    return r.parquet(path)


def read_metrics_csv_stream(spark: SparkSession, directory: str, source_node: str, event_time: str = "arrival",
                            header: bool = True, max_files_per_trigger: int = 100) -> DataFrame:
    """A2: metric CSV files as they arrive in ``directory`` (the endless replay becomes new-file ingest)."""
    lines = (spark.readStream.schema("line STRING").options(header=str(header).lower(), **LINE_OPTIONS)
             .option("maxFilesPerTrigger", max_files_per_trigger).csv(directory))
    return map_record(parse_lines(lines), source_node, event_time)


def with_event_time(df: DataFrame, ns_col: str = "timestamp_ns") -> DataFrame:
    """Event-time column (microsecond TIMESTAMP) for watermarks; the ns column stays the key."""
    return df.withColumn(EVENT_TIME, ns_to_timestamp(F.col(ns_col)))


def batch_dir_writer(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Idempotent micro-batch sink: batch ``n`` always lands in ``path/batch_id=n`` (overwrite)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path}/batch_id={batch_id}")

    return write


def fan_out_writer(sinks: Sequence[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """One micro-batch to several sinks; the batch is persisted once so it is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def start_batches(df: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str,
                  output_mode: str = "append", available_now: bool = True, name: str | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query; ``available_now`` processes what is there and stops."""
    w = df.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).outputMode(output_mode)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def ingest_stream(telemetry: DataFrame, measurement: str = "gpu_metrics") -> DataFrame:
    """Canonical messages -> points, stateless (row by row), with stream statistics (I6) observed per batch."""
    pts = build_points(telemetry, measurement)
    return pts.observe("ingest_stats", F.count(F.lit(1)).alias("points"),
                       F.count_if(F.col("gpu_id").isNull()).alias("points_without_gpu"))


def dedup_at_read(spark: SparkSession, path: str, key: Sequence[str] = ("series_id", "timestamp_ns", "metric_name"),
                  seq: str = "persist_key") -> DataFrame:
    """I3, exact: the batch folders hold every copy; the last write per key (batch, then sequence) is kept, whatever
    order the copies came in."""
    rows = spark.read.parquet(path)
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), F.struct("batch_id", seq)).alias("_w"))
    return last.select("_w.*")


def dedup_stream(points: DataFrame, watermark: str = "10 minutes",
                 key: Sequence[str] = ("series_id", "timestamp_ns", "metric_name")) -> DataFrame:
    """I3 as an optimisation before the sink: a copy within the watermark gives no second row. Rows that come later
    than the watermark are dropped by Spark (``numRowsDroppedByWatermark`` of the progress counts them), so use it
    only where events arrive in order to within ``watermark``; ``dedup_at_read`` needs no such promise."""
    return with_event_time(points).withWatermark(EVENT_TIME, watermark).dropDuplicatesWithinWatermark(list(key))


def window_count_writer(path: str, every_ns: int, by: Sequence[str] = ("gpu_id",)) -> Callable[[DataFrame, int], None]:
    """I4, exact: each micro-batch's own counts per epoch-aligned window and group, into its batch folder. No state
    and no watermark: rows of any age count. Sum them with ``summed_window_counts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        start = truncate_ns(F.col("timestamp_ns"), every_ns)
        counts = batch.groupBy(*by, start.alias("window_start_ns")).agg(F.count(F.lit(1)).alias("points"))
        counts.select(*by, "window_start_ns", (F.col("window_start_ns") + every_ns).alias("window_end_ns"), "points",
                      F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def summed_window_counts(spark: SparkSession, path: str, by: Sequence[str] = ("gpu_id",)) -> DataFrame:
    """Read side of I4: one row per window and group over all batch folders."""
    return spark.read.parquet(path).groupBy(*by, "window_start_ns", "window_end_ns").agg(F.sum("points").alias("points"))


def window_count_stream(points: DataFrame, every: str = "1 hour", watermark: str = "1 hour",
                        by: Sequence[str] = ("gpu_id",)) -> DataFrame:
    """I4 with state, for live updates: counts per window in ``update`` mode. Rows later than the watermark are
    dropped (counted in the progress); exact counts come from ``window_count_writer``."""
    t = with_event_time(points).withWatermark(EVENT_TIME, watermark)
    return t.groupBy(F.window(EVENT_TIME, every).alias("w"), *by).agg(F.count(F.lit(1)).alias("points")).select(
        *by, (F.unix_micros(F.col("w.start")) * NS_PER_US).alias("window_start_ns"),
        (F.unix_micros(F.col("w.end")) * NS_PER_US).alias("window_end_ns"), "points")


def late_rows_writer(path: str, ns_col: str, delay_ns: int) -> Callable[[DataFrame, int], None]:
    """For use beside a watermark form (K12 fan-out): rows older than the newest event of earlier micro-batches less
    ``delay_ns`` -- those its watermark drops -- go to a side folder, ``path/late/batch_id=n``, and each batch's newest
    event to ``path/newest/batch_id=n``, from which a restart goes on."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.agg(F.max(ns_col).alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")
        seen = spark.read.parquet(f"{path}/newest").where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        late = batch.where(F.col(ns_col) < (seen - delay_ns)) if seen is not None else batch.limit(0)
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")

    return write


def ack_timeout_at_read(spark: SparkSession, dispatches_path: str, acks_path: str, timeout_ns: int) -> DataFrame:
    """I1, exact: deliveries without an ack within ``timeout`` of the sending, over all batch folders of both sides.
    Give the folders of the micro-batches up to now; whatever order files came in, the result is the same."""
    d, a = spark.read.parquet(dispatches_path), spark.read.parquet(acks_path)
    acked = (d.join(a.where(F.col("message_id") != "").select("message_id", "ack_ns"), "message_id")
             .where((F.col("ack_ns") >= F.col("sent_ns")) & (F.col("ack_ns") <= F.col("sent_ns") + timeout_ns)).select("message_id"))
    return d.join(acked, "message_id", "left_anti").select("message_id", "persist_key", "sent_ns", F.lit("timeout").alias("reason"))


def ack_timeout_stream(dispatches: DataFrame, acks: DataFrame, timeout: str = "30 seconds",
                       watermark: str = "1 minute") -> DataFrame:
    """I1 with state: deliveries with no ack within ``timeout`` of sending -> requeue rows as the watermark passes.

    Stream-stream left outer join on the id with ``sent <= ack <= sent + timeout``; watermarks on both sides bound
    the state. Rows that arrive later than the watermark are dropped from either side, so their deliveries may be
    missing or reported although acked: use it where files arrive in order to within ``watermark``, and
    ``ack_timeout_at_read`` for exact results."""
    d = dispatches.withColumn("sent_time", ns_to_timestamp(F.col("sent_ns"))).withWatermark("sent_time", watermark)
    a = (acks.where(F.col("message_id") != "").select(F.col("message_id").alias("ack_id"), "ack_ns")
         .withColumn("ack_time", ns_to_timestamp(F.col("ack_ns"))).withWatermark("ack_time", watermark))
    cond = (F.col("message_id") == F.col("ack_id")) & (F.col("ack_time") >= F.col("sent_time")) & (
        F.col("ack_time") <= F.col("sent_time") + F.expr(f"INTERVAL {timeout}"))
    j = d.join(a, cond, "leftOuter")
    return j.where(F.col("ack_id").isNull()).select("message_id", "persist_key", "sent_ns",
                                                   F.lit("timeout").alias("reason"))


def counting_writer(path: str, aggs: Sequence[F.Column]) -> Callable[[DataFrame, int], None]:
    """I6 (exact form): per micro-batch counters written as one row to ``path/batch_id=n`` (overwrite, so a replay
    does not count twice). Sum the folder for totals; ``observe`` metrics in ``recentProgress`` are for live
    monitoring only (the progress history is bounded)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.agg(*aggs).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}")

    return write


def write_points_stream(points: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Points stream -> store. Each micro-batch lands in ``path/batch_id=n`` (overwrite), partitioned like the
    batch store (measurement, UTC date); the checkpoint commit after the write is the acknowledgement, so a
    replayed batch rewrites its own folder and duplicates across batches are resolved at read time (D9)."""
    from devmetrics.functions.values import ns_to_utc_date

    dated = points.withColumn("date", ns_to_utc_date(F.col("timestamp_ns")))
    return start_batches(dated, batch_dir_writer(path, ("measurement", "date")), checkpoint,
                         available_now=available_now)


def ingest_csv_stream(spark: SparkSession, directory: str, path: str, checkpoint: str, source_node: str,
                      event_time: str = "arrival", measurement: str = "gpu_metrics", rejects_path: str | None = None,
                      available_now: bool = False, header: bool = True, max_files_per_trigger: int = 100) -> StreamingQuery:
    """CSV files as they arrive (A2) -> validation with rejects (B1-B6) -> points (B12) -> store.
    Rejected rows go to ``rejects_path`` (if given) from the same micro-batch (K12 fan-out), never to the store.
    ``persist_key`` is unique within a micro-batch only; read the store with ``upsert_points(...,
    seq_col=["batch_id", "persist_key"])`` (``batch_id`` comes from the folder names)."""
    from devmetrics.functions.values import ns_to_utc_date

    rows = read_metrics_csv_stream(spark, directory, source_node, event_time, header, max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = batch.where(F.col("reject_reason").isNull()).drop("reject_reason")
            pts = build_points(good.withColumn("persist_key", F.monotonically_increasing_id()), measurement)
            batch_dir_writer(path, ("measurement", "date"))(
                pts.withColumn("date", ns_to_utc_date(F.col("timestamp_ns"))), batch_id)
            if rejects_path:
                batch_dir_writer(rejects_path)(batch.where(F.col("reject_reason").isNotNull()), batch_id)
        finally:
            batch.unpersist()

    return start_batches(rows, write, checkpoint, available_now=available_now)

"""Session helpers: building a local session for tests/bench and finding the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "devmetrics") -> SparkSession:
    """Local session for tests and the bench. Cluster jobs should build their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a local session may fall back to a
    fresh folder of its own; a cluster session without the setting is an error, because a machine-local folder
    does not survive the loss of an executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder (HDFS/S3/...)")
        base = tempfile.mkdtemp(prefix="devmetrics-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared folder for one job's intermediate output."""
    base = shared_dir(spark)
    return f"{base}/devmetrics/{name}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> None:
    """Deletes what this library left in the shared folder. For the end of a job: results that still read from a
    staged table must have been written by then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/devmetrics")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Used where an intermediate result feeds two consumers: without it each consumer recomputes the whole lineage
    (Spark reuses an exchange only when both branches prune the same columns). The written table also cuts the
    lineage, so a lost executor does not replay the upstream joins. Never a machine-local folder on a cluster
    (see ``shared_dir``); never ``localCheckpoint``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    Initial shuffle partitions: enough for ``target_partition_bytes`` per partition of the *input* (shuffles here
    move at most about the input, usually far less after partial aggregation), at least 3 waves of the cluster's
    cores; AQE then coalesces small ones to the advisory size and splits skewed ones. Scans use 256 MB splits.
    Streaming state (join buffers, dedup keys) goes to RocksDB so it is not bounded by executor heap."""
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 * 1024**2),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }

"""Tables that micro-batches add to and that are merged partition by partition behind a committed manifest.

Layout under ``path``:

- ``batches/batch_id=n/<partition folders>``: what micro-batch ``n`` wrote (overwrite, so a replay repeats itself);
- ``merged/run=<id>/<partition folders>``: what a merge wrote;
- ``manifest/v=<n>.json``: which run holds each partition folder, and up to which batch they are merged.

A merge reads and rewrites only the partitions that new batches touched; the others keep the run they are in. It writes
its run first and then commits by renaming a finished manifest to the next version's name, which fails if another merge
has taken that. Readers go by the last manifest, so they see a partition as it was before or as it is after, and a merge
that is cut short leaves files that nothing refers to (``vacuum`` deletes them).

What a merge does with the rows of a partition is the table's own ``merge``: last write wins for points, sums for
counts, unions for sketches and intervals. It must give the same result whether rows are merged at once or by parts,
and rows that it brings together must be of one partition. Batches must be complete in the order of their numbers, as a
stream's are.

The manifest has one short line per partition folder (a measurement and a day, say), whatever the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Name that Spark gives the folder of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class _Files:
    """The file system of the table, as the cluster is set up."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        p = self.path(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def exists(self, path: str) -> bool:
        return bool(self.fs.exists(self.path(path)))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self.fs.create(self.path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_new(self, src: str, dst: str) -> None:
        """Renames; an error if ``dst`` is there."""
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.gateway.new_array(kind, 1)
        none[0] = kind.NONE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf).rename(self.path(src), self.path(dst), none)


def folder_values(folder: str) -> dict[str, str | None]:
    """Values in a partition folder's name, ``a=1/b=x``."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {k: None if v == NULL_FOLDER else unquote(v) for k, v in pairs}


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    upto: int = -1  # number of the last batch that is merged
    runs: dict[str, str] | None = None  # partition folder -> run

    def folders(self) -> dict[str, str]:
        return self.runs or {}


@dataclass(frozen=True)
class MergedTable:
    """``schema``: of the rows, with the partition columns and without ``batch_id``. ``order``: what the rows of a
    partition are split over tasks by (besides the partition) and sorted by."""

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    order: tuple[str, ...] = ()

    # --- writing

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` writer: batch ``n`` to its own folder. Rows are rebalanced by partition: small folders get one
        file and tasks are coalesced, while a folder with many rows is split over tasks by size. A batch without rows is
        complete, too."""
        (rows.select(*self.schema.names).hint("rebalance", *self.partition_by).write.mode("overwrite").partitionBy(*self.partition_by)
         .parquet(f"{self.path}/batches/batch_id={batch_id}"))

    def merge_new(self, spark: SparkSession) -> list[str]:
        """Merges the batches since the last merge and commits; the partition folders that were rewritten."""
        files = _Files(spark, self.path)
        manifest = self.manifest(spark)
        fresh = self._fresh(files, manifest)
        if not fresh:
            return []
        touched = sorted({f for folders in fresh.values() for f in folders})
        runs = dict(manifest.folders())
        if touched:
            run = uuid.uuid4().hex[:16]
            rows = self.merge(self._rows(spark, {f: runs[f] for f in touched if f in runs}, fresh))
            # by range: a partition's rows in few files, those of a large one split over several tasks
            keys = [*self.partition_by, *self.order]
            ranged = rows.select(*self._stored().names).repartitionByRange(*keys).sortWithinPartitions(*keys)
            ranged.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/merged/run={run}")
            runs.update({f: run for f in touched})
        self._commit(files, Manifest(manifest.version + 1, max(fresh), runs))
        return touched

    def _commit(self, files: _Files, manifest: Manifest) -> None:
        text = json.dumps({"upto": manifest.upto, "runs": manifest.folders()}, indent=0, sort_keys=True)
        draft = f"{self.path}/manifest/draft-{uuid.uuid4().hex}"
        files.write(draft, text)
        files.rename_new(draft, f"{self.path}/manifest/v={manifest.version:010d}.json")

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Deletes the manifests but the last ``keep``, and the runs and batches that none of those needs. Not beside a
        running merge, and ``keep`` must reach back to the oldest version that a reader still has open."""
        files = _Files(spark, self.path)
        versions = self._versions(files)
        kept = [self._load(files, v) for v in versions[-keep:]]
        for v in versions[:-keep]:
            files.delete(f"{self.path}/manifest/v={v:010d}.json")
        needed = {f"run={r}" for m in kept for r in m.folders().values()}
        for run in set(files.names(f"{self.path}/merged")) - needed:
            if run.startswith("run="):
                files.delete(f"{self.path}/merged/{run}")
        upto = min((m.upto for m in kept), default=-1)
        for n in self._batches(files):
            if n <= upto:
                files.delete(f"{self.path}/batches/batch_id={n}")
        for name in files.names(f"{self.path}/manifest"):
            if name.startswith("draft-"):
                files.delete(f"{self.path}/manifest/{name}")

    # --- reading

    def manifest(self, spark: SparkSession) -> Manifest:
        files = _Files(spark, self.path)
        versions = self._versions(files)
        return self._load(files, versions[-1]) if versions else Manifest()

    def read(self, spark: SparkSession, wanted: Callable[[dict[str, str | None]], bool] | None = None, fresh: bool = True) -> DataFrame:
        """Merged rows, of the partitions for which ``wanted`` (given a folder's values) is true. With ``fresh``, those of
        batches that no merge has seen yet are merged in while reading; partitions without any are read as they are."""
        files = _Files(spark, self.path)
        manifest = self.manifest(spark)
        keep = (lambda f: True) if wanted is None else (lambda f: wanted(folder_values(f)))
        runs = {f: r for f, r in manifest.folders().items() if keep(f)}
        new = {n: [f for f in folders if keep(f)] for n, folders in self._fresh(files, manifest).items()} if fresh else {}
        open_ = {f for folders in new.values() for f in folders}
        done = self._rows(spark, {f: r for f, r in runs.items() if f not in open_}, {})
        if open_:
            done = done.unionByName(self.merge(self._rows(spark, {f: r for f, r in runs.items() if f in open_}, new)).select(*done.columns))
        return done.select(*self.schema.names)

    # --- inside

    def _stored(self) -> T.StructType:
        """Merged rows keep the batch they are from, which orders writes of later batches."""
        return T.StructType([*self.schema.fields, T.StructField("batch_id", T.IntegerType())])

    def _rows(self, spark: SparkSession, runs: dict[str, str], fresh: dict[int, list[str]]) -> DataFrame:
        stored = self._stored()
        parts = []
        if runs:
            folders = [f"{self.path}/merged/run={r}/{f}" for f, r in sorted(runs.items())]
            parts.append(spark.read.schema(stored).option("basePath", f"{self.path}/merged").parquet(*folders))
        folders = [f"{self.path}/batches/batch_id={n}/{f}" for n, fs in sorted(fresh.items()) for f in fs]
        if folders:
            parts.append(spark.read.schema(stored).option("basePath", f"{self.path}/batches").parquet(*folders))
        rows = [p.select(*stored.names) for p in parts] or [spark.createDataFrame([], stored)]
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])

    def _versions(self, files: _Files) -> list[int]:
        return sorted(int(n[2:-5]) for n in files.names(f"{self.path}/manifest") if n.startswith("v=") and n.endswith(".json"))

    def _load(self, files: _Files, version: int) -> Manifest:
        kept = json.loads(files.read(f"{self.path}/manifest/v={version:010d}.json"))
        return Manifest(version, kept["upto"], kept["runs"])

    def _batches(self, files: _Files) -> list[int]:
        """Batches that are written to the end."""
        names = [n for n in files.names(f"{self.path}/batches") if n.startswith("batch_id=")]
        return sorted(int(n[9:]) for n in names if files.exists(f"{self.path}/batches/{n}/_SUCCESS"))

    def _fresh(self, files: _Files, manifest: Manifest) -> dict[int, list[str]]:
        """Partition folders of the batches that aren't merged."""
        return {n: self._folders(files, f"{self.path}/batches/batch_id={n}") for n in self._batches(files) if n > manifest.upto}

    def _folders(self, files: _Files, root: str) -> list[str]:
        found: Iterable[str] = [""]
        for column in self.partition_by:
            found = [f"{f}/{name}" if f else name for f in found for name in files.names(f"{root}/{f}" if f else root) if name.startswith(f"{column}=")]
        return list(found)

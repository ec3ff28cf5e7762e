"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devmetrics.session import materialize

#: Fixed value: a word is a maximal run of other characters than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

#: The letters that ASCII lower-casing maps, in order.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, once (what ``--py-files`` does): operators with Python
    parts then work wherever the session was started."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if any(f.rpartition("/")[2] == "devmetrics.zip" for f in context.listFiles):
        return
    path = Path(tempfile.mkdtemp(prefix="devmetrics-py-")) / "devmetrics.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f"devmetrics/{f.relative_to(package)}")
    context.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its whole name, whatever characters (dots, too) that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """For each name one like it that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        own = f"__{name}"
        while own.lower() in taken:
            own += "_"
        taken.add(own.lower())
        found.append(own)
    return found


def bounded_sample(rows: DataFrame, by: str, limit: Column, most: int) -> DataFrame:
    """Of rows (doc_id, ``by``) at most ``limit`` (a column; ``most`` at most) for each value, those first in the
    order of md5(doc_id).

    A share of the hash range that holds about twice as many is cut out first, where the rows are read, so that what
    meets in the window of a value doesn't grow with the input. The sizes that this takes (one row per label or
    language) are broadcast."""
    place = F.md5(F.col("doc_id").cast("string"))
    share = F.conv(F.substring(place, 1, 8), 16, 10).cast("double") / 2.0**32
    sizes = rows.groupBy(by).agg(F.count("*").alias("__size"))
    near = rows.join(F.broadcast(sizes), by).where(share * F.col("__size") < 2 * most + 100)
    order = Window.partitionBy(by).orderBy(place, "doc_id")
    return near.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= limit).drop("__n", "__size")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc32_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def numbered(df: DataFrame, order: list[Column], value: Column | None = None, name: str = "numbered") -> DataFrame:
    """``df`` globally ordered, with ``__rank`` (from 0) and, for a value, ``__before`` (its sum over earlier rows).

    The sorted rows are written to the shared folder with their place in the partition, so that a retry can't
    renumber them; only one row per partition meets in the window over partitions (bounded by the number of
    partitions, whatever the input)."""
    value = F.lit(1) if value is None else value
    rows = df.withColumn("__v", value.cast("long")).orderBy(*order).withColumn("__mid", F.monotonically_increasing_id())
    rows = materialize(rows, name).withColumn("__part", F.shiftright("__mid", 33))
    parts = rows.groupBy("__part").agg(F.sum("__v").alias("__sum"), F.count("*").alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base"),
                         F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__part").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("__in", F.coalesce(F.sum("__v").over(inside), F.lit(0)))
            .join(F.broadcast(parts), "__part")
            .withColumn("__rank", F.col("__first") + F.col("__mid").bitwiseAND((1 << 33) - 1))
            .withColumn("__before", F.col("__base") + F.col("__in"))
            .drop("__part", "__mid", "__v", "__base", "__first", "__in"))

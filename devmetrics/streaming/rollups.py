"""Stored cells that range queries are answered from instead of the points.

Each kind of cell is a ``MergedTable``: a micro-batch adds the cells of its own points, a merge folds them into the
partitions they fall into, and late files change only those.

- Counts per group in cells of a minute, an hour and a day (``count_table``). A range takes days where whole days fit,
  hours and minutes towards its two ends, and the points themselves only for the two parts of a minute that are left.
- Sketches per group and cell (``sketch_table``): HyperLogLog for distinct tag values, KLL for quantiles. They are
  unioned at read, over any range of cells and any of the groups.
- Coverage per group and day (``coverage_table``): spans in which no two neighbouring points are further apart than a
  threshold. What lies between spans are the silences.

Counts and coverage are exact and don't depend on the order of files. The errors of the sketches are stated below.

Defined cases: a null group is a group; null tag values and null values aren't sketched; a range without points, like an
empty table, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devmetrics.functions.values import NS_PER_DAY, NS_PER_HOUR, NS_PER_MINUTE, floor_div, ns_to_utc_date, truncate_ns
from devmetrics.operators.aggregates import empty_runs, filled_windows
from devmetrics.operators.points import upsert_points
from devmetrics.operators.reads import time_range
from devmetrics.sources.merged import MergedTable
from devmetrics.sources.points_store import utc_date

#: Levels of the counts, coarse to fine.
LEVELS = {"day": NS_PER_DAY, "hour": NS_PER_HOUR, "minute": NS_PER_MINUTE}
#: HyperLogLog of 2^14 registers: a standard error of 1.04 / sqrt(2^14) = 0.8 % for unions; three of them are stated.
HLL_LOG2 = 14
DISTINCT_ERROR = 0.025
#: KLL of this size: the rank of a returned value is off by 0.4 % of the rows at 99 % confidence; 1 % is stated.
KLL_SIZE = 800
RANK_ERROR = 0.01


def points_table(path: str, schema: T.StructType, key: str = "metric", order: tuple[str, ...] = ("gpu_id", "timestamp_ns")) -> MergedTable:
    """A6 + D9: a points store whose merges keep one copy per point, the last write (batch, then sequence). ``schema``:
    of the points with their ``date`` (see ``dated``). A point's copies share its measurement and its date."""
    last = lambda rows: upsert_points(rows, key=key, seq_col=["batch_id", "persist_key"])
    return MergedTable(path, schema, ("measurement", "date"), last, order)


def dated(rows: DataFrame, ns_col: str = "timestamp_ns") -> DataFrame:
    return rows.withColumn("date", ns_to_utc_date(F.col(ns_col)))


def _day_filter(start_ns: int | None, stop_ns: int | None) -> Callable[[dict[str, str | None]], bool] | None:
    """Folders of the days that ``[start, stop)`` touches."""
    if start_ns is None or stop_ns is None:
        return None
    first, last = str(utc_date(start_ns)), str(utc_date(stop_ns - 1))
    return lambda v: v["date"] is not None and first <= v["date"] <= last


def read_merged_points(spark: SparkSession, table: MergedTable, start_ns: int, stop_ns: int, measurement: str | None = None) -> DataFrame:
    """A7 over a merged store: one copy per point of ``[start, stop)``, from the folders of its days alone."""
    day = _day_filter(start_ns, stop_ns)
    wanted = lambda v: day(v) and (measurement is None or v["measurement"] == measurement)
    return time_range(table.read(spark, wanted), start_ns, stop_ns)


# --- counts (D6, I4) -----------------------------------------------------------------------------------------------

def count_cells(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """level, date, ``by``, cell_ns, points. The points are counted by the minute once; hours and days add minutes."""
    minutes = points.groupBy(*by, truncate_ns(F.col("timestamp_ns"), NS_PER_MINUTE).alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("level"), truncate_ns(F.col("_m"), width).alias("cell_ns"))
                                for name, width in LEVELS.items()]))
    summed = minutes.select(*by, "_n", cells.alias("_c")).groupBy("_c", *by).agg(F.sum("_n").alias("points"))
    return dated(summed.select("_c.level", *by, "_c.cell_ns", "points"), "cell_ns")


def count_table(path: str, by: dict[str, str]) -> MergedTable:
    """``by``: name and type of each group column."""
    schema = T.StructType.fromDDL(", ".join(["level string", *(f"`{c}` {t}" for c, t in by.items()), "cell_ns long, points long, date date"]))

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("level", "date", *by, "cell_ns").agg(F.sum("points").alias("points"), F.max("batch_id").alias("batch_id"))

    return MergedTable(path, schema, ("level", "date"), merge, (*by, "cell_ns"))


def cover(start_ns: int, stop_ns: int, levels: dict[str, int]) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """``[start, stop)`` as ranges of whole cells (level, from, to), as coarse as they fit, and what no cell fits in."""
    cells, left = [], [(start_ns, stop_ns)] if start_ns < stop_ns else []
    for name, width in sorted(levels.items(), key=lambda kv: -kv[1]):
        still = []
        for a, b in left:
            first, last = -(-a // width) * width, b // width * width
            if first < last:
                cells.append((name, first, last))
                still += [(x, y) for x, y in ((a, first), (last, b)) if x < y]
            else:
                still.append((a, b))
        left = still
    return cells, left


def counted_windows(spark: SparkSession, table: MergedTable, points: Callable[[int, int], DataFrame], every_ns: int, start_ns: int,
                    stop_ns: int, by: Sequence[str] = ("gpu_id",), create_empty: bool = True) -> DataFrame:
    """D6 from stored counts, for any ``[start, stop)``; same rows as ``aggregates.window_count``. ``points(a, b)`` gives
    the points of ``[a, b)`` and is called for the ends that are less than a minute. Windows must be whole minutes."""
    levels = {name: width for name, width in LEVELS.items() if every_ns % width == 0}
    if not levels:
        raise ValueError("windows must be whole minutes")
    cells, ends = cover(start_ns, stop_ns, levels)
    days = [(name, str(utc_date(a)), str(utc_date(b - 1))) for name, a, b in cells]
    rows = table.read(spark, lambda v: any(v["level"] == name and first <= v["date"] <= last for name, first, last in days))
    inside = F.lit(False)
    for name, a, b in cells:
        inside = inside | ((F.col("level") == name) & (F.col("cell_ns") >= a) & (F.col("cell_ns") < b))
    counts = rows.where(inside).select(*by, F.col("cell_ns").alias("_t"), "points")
    for a, b in ends:
        ones = time_range(points(a, b), a, b).select(*by, F.col("timestamp_ns").alias("_t"), F.lit(1).cast("long").alias("points"))
        counts = counts.unionByName(ones)
    windows = counts.groupBy(*by, truncate_ns(F.col("_t"), every_ns).alias("_w")).agg(F.sum("points").alias("points"))
    return filled_windows(windows, every_ns, start_ns, stop_ns, by, create_empty)


# --- sketches (D2, D5, K11) ----------------------------------------------------------------------------------------

def sketch_cells(points: DataFrame, by: Sequence[str], distinct: Sequence[str], value: Column, every_ns: int) -> DataFrame:
    """date, ``by``, cell_ns, points, a HyperLogLog sketch per column of ``distinct`` and a KLL sketch of ``value``."""
    cell = truncate_ns(F.col("timestamp_ns"), every_ns).alias("cell_ns")
    sketches = [F.hll_sketch_agg(F.col(c), HLL_LOG2).alias(f"{c}_hll") for c in distinct]
    rows = points.withColumn("_value", value.cast("double")).groupBy(*by, cell).agg(
        F.count(F.lit(1)).alias("points"), *sketches, F.kll_sketch_agg_double("_value", KLL_SIZE).alias("value_kll"))
    return dated(rows, "cell_ns")


def sketch_table(path: str, by: dict[str, str], distinct: Sequence[str]) -> MergedTable:
    kinds = [*(f"`{c}` {t}" for c, t in by.items()), "cell_ns long, points long", *(f"`{c}_hll` binary" for c in distinct), "value_kll binary, date date"]

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("date", *by, "cell_ns").agg(F.max("batch_id").alias("batch_id"), F.sum("points").alias("points"), *_unions(distinct))

    return MergedTable(path, T.StructType.fromDDL(", ".join(kinds)), ("date",), merge, (*by, "cell_ns"))


def _unions(distinct: Sequence[str]) -> list[Column]:
    return [*(F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in distinct), F.kll_merge_agg_double("value_kll", KLL_SIZE).alias("value_kll")]


def read_sketches(spark: SparkSession, table: MergedTable, every_ns: int, by: Sequence[str], distinct: Sequence[str],
                  start_ns: int | None = None, stop_ns: int | None = None) -> DataFrame:
    """``by``, points and the sketches of ``[start, stop)`` unioned; the range must consist of whole cells."""
    rows = table.read(spark, _day_filter(start_ns, stop_ns))
    if start_ns is not None and stop_ns is not None:
        if start_ns % every_ns or stop_ns % every_ns:
            raise ValueError("the range must consist of whole cells")
        rows = rows.where((F.col("cell_ns") >= start_ns) & (F.col("cell_ns") < stop_ns))
    return rows.groupBy(*by).agg(F.sum("points").alias("points"), *_unions(distinct))


def distinct_estimate(column: str) -> Column:
    """D2 over ``read_sketches``: number of distinct values, to within ``DISTINCT_ERROR``."""
    return F.hll_sketch_estimate(f"{column}_hll")


def quantile_estimate(q: float) -> Column:
    """K11 over ``read_sketches``: a value whose rank is within ``RANK_ERROR`` of ``q``; null where there is none."""
    some = F.kll_sketch_get_n_double("value_kll") > 0
    return F.when(some, F.kll_sketch_get_quantile_double("value_kll", F.lit(q)))


# --- coverage (D7, K6) ---------------------------------------------------------------------------------------------

def merged_spans(spans: DataFrame, keys: Sequence[str], threshold_ns: int) -> DataFrame:
    """Spans (``keys``, from_ns, to_ns) of one key no further apart than the threshold, joined. The window is over spans:
    a key's day has at most ``day / threshold`` of them that are apart, times the batches not merged yet."""
    w = Window.partitionBy(*keys).orderBy("from_ns", "to_ns")
    before = F.max("to_ns").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("_new", F.coalesce(F.col("from_ns") - before > threshold_ns, F.lit(True)).cast("int"))
    numbered = starts.withColumn("_span", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = [F.max("batch_id").alias("batch_id")] if "batch_id" in spans.columns else []
    return numbered.groupBy(*keys, "_span").agg(F.min("from_ns").alias("from_ns"), F.max("to_ns").alias("to_ns"), *last).drop("_span")


def coverage_spans(points: DataFrame, by: Sequence[str], threshold_ns: int) -> DataFrame:
    """date, ``by``, from_ns, to_ns. Points within one stretch of ``threshold`` are a span by themselves, so a partial
    aggregate (least and greatest time) comes first and no window sees points."""
    t = F.col("timestamp_ns")
    stretches = dated(points).groupBy(*by, "date", floor_div(t, threshold_ns).alias("_s")).agg(F.min(t).alias("from_ns"), F.max(t).alias("to_ns"))
    return merged_spans(stretches, [*by, "date"], threshold_ns)


def coverage_table(path: str, by: dict[str, str], threshold_ns: int) -> MergedTable:
    schema = T.StructType.fromDDL(", ".join([*(f"`{c}` {t}" for c, t in by.items()), "from_ns long, to_ns long, date date"]))
    return MergedTable(path, schema, ("date",), lambda rows: merged_spans(rows, [*by, "date"], threshold_ns), (*by, "from_ns"))


def silences(spark: SparkSession, table: MergedTable, threshold_ns: int, by: Sequence[str] = ("gpu_id",)) -> DataFrame:
    """K6 from stored coverage: closed silences longer than the threshold; same rows as ``aggregates.gpu_silences``."""
    w = Window.partitionBy(*by).orderBy("from_ns")
    spans = table.read(spark).select(*by, "from_ns", F.lag("to_ns").over(w).alias("_before"))
    silent = F.col("from_ns") - F.col("_before")
    return spans.where(silent > threshold_ns).select(
        *by, F.col("_before").alias("silent_from_ns"), F.col("from_ns").alias("silent_to_ns"), silent.alias("silent_ns"))


def gaps(spark: SparkSession, table: MergedTable, threshold_ns: int, every_ns: int, start_ns: int, stop_ns: int,
         by: Sequence[str] = ("gpu_id",)) -> DataFrame:
    """D7 from stored coverage: runs of empty windows; same rows as ``aggregates.continuity_gaps``.

    Neighbouring points of a span are at most ``threshold <= every`` apart, so no window between its first and last point
    is empty, and a range of whole windows cuts a span without emptying one."""
    if threshold_ns > every_ns or start_ns % every_ns or stop_ns % every_ns:
        raise ValueError("the threshold must not exceed a window, and the range must consist of whole windows")
    spans = table.read(spark, _day_filter(start_ns, stop_ns)).where((F.col("to_ns") >= start_ns) & (F.col("from_ns") < stop_ns))
    window = lambda t: truncate_ns(t, every_ns)
    full = spans.select(*by, window(F.greatest("from_ns", F.lit(start_ns))).alias("_first"), window(F.least("to_ns", F.lit(stop_ns - 1))).alias("_last"))
    return empty_runs(full, every_ns, start_ns, stop_ns, by)

"""Metric CSV ingest with rejects (A1, A2 schema, B1-B6).

Positional columns, never inferred: 0 recorded time, 1 metric, 2 gpu id, 3 device, 4 uuid, 5-8 model names,
9 namespace, 10 value, 11 labels; later columns are ignored, however many there are. A record with fewer fields is a
reject, and so is one whose quotes are broken (never closed, or in the middle of a field). Bad rows are kept apart with
a reason, counted neither as sent nor as dropped; every input record comes out once, as a message or as a reject.

Two readers: by line (the default) or, with ``multi_line``, by record, where quoted fields may hold line feeds
(``csv_records``). Both split large files. Blank lines are no records in either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.functions.values import append_source_node, arrival_ns, parse_value, value_reject_reason

N_FIELDS = 12
FIELDS_SCHEMA = ", ".join(f"c{i} STRING" for i in range(N_FIELDS))
PARSE_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
# Whole lines: a separator of many characters and no quote, so each line arrives as one string, whatever single
# character it holds (the CSV source, not the text source, as it skips each file's header).
LINE_OPTIONS = {"sep": "\u0001\ue0f1line\ue0f2\u0002", "quote": "", "multiLine": "false"}
# From one quote to the next, once doubled quotes are out; the class runs to the next quote, so matching is linear.
QUOTED = '"[^"]*"'
#: In what ``bare`` gives: a quote behind, or a quoted field before, something else than a comma.
MISPLACED = '[^",]"|""[^",]'
CLOSED, OPEN, STRAY = 0, 1, 2


def bare(record: Column) -> Column:
    """The record with all quoted fields empty (``""``); a single quote is left where the last field is still open."""
    return F.when(record.contains('"'), F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), QUOTED, '""')).otherwise(record)


def quote_state(bare_record: Column) -> Column:
    """Of what ``bare`` gave: all quoted fields closed, the last one still open, or a quote where none may be."""
    return F.when(~bare_record.contains('"'), CLOSED).when(bare_record.rlike(MISPLACED), STRAY).otherwise(_odd_quotes(bare_record))


def _odd_quotes(record: Column) -> Column:
    return (F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))) % 2


def field_count(bare_record: Column) -> Column:
    return F.length(bare_record) - F.length(F.replace(bare_record, F.lit(","), F.lit(""))) + 1


def first_fields(record: Column, n: int = N_FIELDS) -> Column:
    """A record of more than ``n`` fields cut behind the ``n``-th: commas between quotes are hidden (by a character of
    the same length), so that the ``n``-th of the others is the place."""
    parts = F.transform(F.split(record, '"'), lambda x, i: F.when(i % 2 == 1, F.translate(x, ",", "\u0001")).otherwise(x))
    return F.left(record, F.length(F.substring_index(F.array_join(parts, '"'), ",", n)))


def has_min_fields(n_fields: Column, n: int = N_FIELDS) -> Column:
    """The record has at least ``n`` fields (fewer -> rejected as an incomplete record)."""
    return n_fields >= n


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Records (a text column) -> fields ``c0..c11``, ``n_fields`` and ``broken`` (why its quotes can't be read, or null).

    Only the wanted fields reach the parser, which has a limit of columns: of a record whose quotes are broken, what
    stands before its twelfth comma."""
    known = lines.withColumn("_bare", bare(F.col(line))).withColumn("_n", field_count(F.col("_bare"))).withColumn("_q", quote_state(F.col("_bare")))
    wanted = (F.when(F.col("_q") != CLOSED, F.substring_index(line, ",", N_FIELDS))
              .when(F.col("_n") > N_FIELDS, first_fields(F.col(line))).otherwise(F.col(line)))
    reason = F.when(F.col("_q") != CLOSED, F.when(_odd_quotes(F.col("_bare")) == 1, "unclosed quote").otherwise("stray quote"))
    return known.select(F.from_csv(wanted, FIELDS_SCHEMA, PARSE_OPTIONS).alias("f"), F.col("_n").alias("n_fields"),
                        reason.alias("broken")).select("f.*", "n_fields", "broken")


def read_metrics_csv_raw(spark: SparkSession, path: str, header: bool = True, multi_line: bool = False) -> DataFrame:
    """A1 reader: one row per CSV record with fields ``c0..c11``, ``n_fields`` and ``broken``."""
    if multi_line:
        from devmetrics.sources.csv_records import read_records

        return parse_lines(read_records(spark, path, header), "record")
    return parse_lines(spark.read.option("header", str(header).lower()).schema("line STRING").options(**LINE_OPTIONS).csv(path))


def _s(c: str) -> Column:
    # Message strings are never null (an absent value is '').
    return F.coalesce(F.col(c), F.lit(""))


def map_record(raw: DataFrame, source_node: str | Column, event_time: str = "arrival",
               mode: str = "permissive") -> DataFrame:
    """Positional fields -> canonical telemetry columns plus ``reject_reason`` (null for good rows).

    ``event_time='arrival'`` stamps the arrival time in ns (B5; the recorded column is discarded, as the sender
    does); ``'recorded'`` keeps column 0 as an integer ns time. ``mode='permissive'`` (default) sends short records
    to the rejects; ``'failfast'`` fails the job on the first one.
    """
    if event_time == "arrival":
        ts = arrival_ns()
    elif event_time == "recorded":
        ts = F.col("c0").try_cast("long")
    else:
        raise ValueError("event_time must be 'arrival' or 'recorded'")
    if mode not in ("permissive", "failfast"):
        raise ValueError("mode must be 'permissive' or 'failfast'")
    ragged = ~has_min_fields(F.col("n_fields"))
    if mode == "failfast":
        # Strict: the job fails at the first short record, as a reader error ends the reference's pass.
        ragged = F.when(ragged, F.raise_error(F.lit("incomplete record"))).otherwise(F.lit(False))
    reason = (F.when(F.col("broken").isNotNull(), F.col("broken")).when(ragged, F.lit("incomplete record"))
              .otherwise(value_reject_reason(_s("c10"))))
    return raw.select(
        ts.alias("timestamp_ns"),
        _s("c1").alias("metric_name"),
        _s("c2").alias("gpu_id"),
        _s("c3").alias("device"),
        _s("c4").alias("uuid"),
        F.array(*[_s(f"c{i}") for i in range(5, 9)]).alias("model_name"),
        _s("c9").alias("namespace"),
        F.when(F.col("broken").isNull(), parse_value(_s("c10"))).alias("value"),
        append_source_node(_s("c11"), source_node).alias("labels_raw"),
        reason.alias("reject_reason"),
    )


def stamp_arrival(df: DataFrame, col: str = "timestamp_ns") -> DataFrame:
    """Replace the event time with the arrival time in ns (one value per query evaluation / micro-batch)."""
    return df.withColumn(col, arrival_ns())


def split_valid_rejects(mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two filters of one frame: (valid rows without the reason column, rejected rows)."""
    valid = mapped.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = mapped.where(F.col("reject_reason").isNotNull())
    return valid, rejects


def read_metrics_csv(spark: SparkSession, path: str, source_node: str, event_time: str = "arrival",
                     header: bool = True, mode: str = "permissive", multi_line: bool = False) -> DataFrame:
    """A1: read and map metric CSV files; rows carry ``reject_reason`` (use ``split_valid_rejects``)."""
    return map_record(read_metrics_csv_raw(spark, path, header, multi_line), source_node, event_time, mode)


def quote_csv_field(c: Column) -> Column:
    """A field in double quotes with inner quotes doubled (what the reader's quote/escape options undo)."""
    return F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))

"""CSV records whose quoted fields hold line feeds, read from files that are split over tasks.

A line alone doesn't tell whether it begins inside a quoted field: that depends on all lines before it. But it tells,
for both possibilities, whether the next line begins inside one. So each line is a function on two states (outside,
inside); functions compose, and the state at the start of every split is a prefix over one function per split:

1. each line's function, from its own quotes;
2. per split, the composed function and what the split holds for either state (a window over the split's lines);
3. a prefix over the splits of a file: their real states, and which record an open end belongs to;
4. back at the lines: they are grouped to records, and the lines at the head of a split that belong to a record of an
   earlier split are handed to it, one row per split.

A window holds the lines of one split at most, whatever the size of the file.

Broken quotes don't spread: where a line can't go on from inside a field (a quote closes it in the middle of a field),
the open record ends there, as a reject with an unclosed quote, and the line begins a record of its own. A record that
goes on for more than ``max_tail_chars`` in later splits is cut there, and so is a reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devmetrics.sources.csv import OPEN, QUOTED, STRAY, quote_state

MAX_TAIL_CHARS = 64 << 20


def _ends(line: Column, inside: bool) -> Column:
    """``quote_state`` of a line that begins outside or inside a quoted field."""
    text = F.replace(line, F.lit('""'), F.lit(""))
    if inside:  # as if the field had begun with it
        text = F.concat(F.lit('"'), text)
    return quote_state(F.regexp_replace(text, QUOTED, '""'))


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_split, _pos, line, _quoted) of all lines: the split a line begins in, and its order there."""
    # line feeds only: a carriage return before one goes, others are characters like any
    lines = spark.read.option("lineSep", "\n").text(path)
    line = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return lines.select(
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).alias("_split"),
        F.monotonically_increasing_id().alias("_pos"), line.alias("line"))


def _with_states(lines: DataFrame) -> DataFrame:
    """For both states a split may begin in: the number of records begun up to each line (``_n0``, ``_n1``).

    With ``out`` and ``inn`` the states after a line that begins outside and inside: it fixes the state (both equal),
    swaps it or leaves it. The state after a line is the last one fixed, swapped as often as lines since then swap."""
    quoted = F.col("line").contains('"')
    w = Window.partitionBy("_split").orderBy("_pos")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.withColumn("_o", F.when(quoted, _ends(F.col("line"), False)).otherwise(0))
    rows = rows.withColumn("_i", F.when(quoted, _ends(F.col("line"), True)).otherwise(OPEN))
    rows = rows.withColumn("_again", F.col("_i") == STRAY)  # from inside, this line begins a record of its own
    out = (F.col("_o") == OPEN).cast("int")
    inn = F.when(F.col("_again"), out).otherwise((F.col("_i") == OPEN).cast("int"))
    rows = rows.withColumns({"_out": out, "_in": inn})
    rows = rows.withColumn("_swap", ((F.col("_out") == 1) & (F.col("_in") == 0)).cast("int"))
    rows = rows.withColumn("_swaps", F.sum("_swap").over(upto))
    rows = rows.withColumn("_fix", F.when(F.col("_out") == F.col("_in"), (F.col("_out") + F.col("_swaps")) % 2))
    rows = rows.withColumn("_fixed", F.last("_fix", ignorenulls=True).over(before))
    for s in (0, 1):
        state = (F.coalesce("_fixed", F.lit(s)) + F.col("_swaps") - F.col("_swap")) % 2
        rows = rows.withColumn(f"_n{s}", F.sum(((state == 0) | F.col("_again")).cast("int")).over(upto))
    return rows


def _splits(rows: DataFrame) -> DataFrame:
    """One row per split: its real state (``_state``), the number of records begun in it (``_n``), the split whose last
    record its first lines belong to (``_of``) and how long that record's lines in later splits are up to here."""
    end = F.max_by(F.struct(F.coalesce("_fix", "_fixed").alias("fixed"), F.col("_swaps").alias("swaps")), "_pos")
    long = F.length("line") + 1
    each = rows.groupBy("_split").agg(
        end.alias("_end"), *[F.max(f"_n{s}").alias(f"_n{s}") for s in (0, 1)],
        *[F.sum(F.when(F.col(f"_n{s}") == 0, long).otherwise(0)).alias(f"_head{s}") for s in (0, 1)])
    by_file = Window.partitionBy(F.col("_split.file")).orderBy("_split.block")
    upto, before = by_file.rowsBetween(Window.unboundedPreceding, 0), by_file.rowsBetween(Window.unboundedPreceding, -1)
    # a split's function, composed like a line's
    each = each.withColumn("_swap", F.when(F.col("_end.fixed").isNull(), F.col("_end.swaps") % 2).otherwise(0))
    each = each.withColumn("_swaps", F.sum("_swap").over(upto))
    each = each.withColumn("_fix", (F.col("_end.fixed") + F.col("_end.swaps") + F.col("_swaps")) % 2)
    each = each.withColumn("_fixed", F.last("_fix", ignorenulls=True).over(before))
    each = each.withColumn("_state", (F.coalesce("_fixed", F.lit(0)) + F.col("_swaps") - F.col("_swap")) % 2)
    of_state = lambda name: F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    each = each.withColumns({"_n": of_state("_n"), "_head": of_state("_head")})
    each = each.withColumn("_of", F.last(F.when(F.col("_n") > 0, F.col("_split")), ignorenulls=True).over(before))
    tail = Window.partitionBy("_of").orderBy("_split.block").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("_tail", F.sum("_head").over(tail))
    return each.select("_split", "_state", F.col("_n").alias("_last"), "_of", "_tail")


def _in_order(place: str, text: str) -> Column:
    rows = F.sort_array(F.collect_list(F.struct(place, text)))
    return F.array_join(F.transform(rows, lambda r: r[text]), "\n")


def read_records(spark: SparkSession, path: str, header: bool = True, max_tail_chars: int = MAX_TAIL_CHARS) -> DataFrame:
    """One row per record (column ``record``: its lines, joined by line feeds). With ``header``, the first record of
    each file isn't one. Blank records are left out."""
    rows = _with_states(_numbered_lines(spark, path))
    placed = rows.select("_split", "_pos", "line", "_n0", "_n1").join(_splits(rows), "_split")
    placed = placed.withColumn("_n", F.when(F.col("_state") == 0, F.col("_n0")).otherwise(F.col("_n1")))
    facts = [F.first(c).alias(c) for c in ("_last", "_of", "_tail")]
    pieces = placed.groupBy("_split", "_n").agg(_in_order("_pos", "line").alias("record"), *facts)
    heads = pieces.where((F.col("_n") == 0) & (F.col("_tail") <= max_tail_chars)).select("_of", F.col("_split.block").alias("_block"), "record")
    tails = heads.groupBy(F.col("_of").alias("_split")).agg(_in_order("_block", "record").alias("_more"))
    whole = F.when((F.col("_n") == F.col("_last")) & F.col("_more").isNotNull(), F.concat_ws("\n", "record", "_more")).otherwise(F.col("record"))
    found = pieces.where("_n > 0").join(tails, "_split", "left").withColumn("record", whole)
    if header:
        found = found.where(~((F.col("_split.block") == 0) & (F.col("_n") == 1)))
    return found.where(F.trim("record") != "").select("record")

"""Order-dependent operators that stay distributed when one key holds a large share of the rows.

A window partitioned only by a key (``gpu_id``) puts all of a hot key's rows into one task, and an unpartitioned
window puts everything into one task. Here every window is partitioned by (key, time bucket); what crosses a bucket
boundary travels through per-bucket summaries (one row per key and bucket, bounded by the time span / bucket width,
not by the row count) and is joined back on (key, bucket). A bucket that holds too many rows is cut by their total
order (``bucketed``).

- ``previous_row``: the previous row of the same key in time order (lag), for derivatives and silences (K5, K6).
- ``rolling_agg``: aggregates over a trailing time range, for rolling means (K2); ``rolling_sums`` for ranges of
  very many rows.
- ``asof_join``: the latest right row at or before each left row's time (K1).
- ``running_sum``, ``running_totals``: running totals in a global order, for queue depth and FIFO positions (E1, E4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devmetrics.functions.values import truncate_ns


def _materialize(df: DataFrame, name: str) -> DataFrame:
    from devmetrics.session import materialize

    return materialize(df, name)


def _key_struct(keys: Sequence[str]) -> Column:
    """Keys as one struct column. A struct is never null and compares null fields as equal, so a plain equi-join on it
    is null-safe -- and, unlike ``<=>`` on each key, it joins on exactly the column the window was hash-partitioned by,
    so the large side is not shuffled again."""
    return F.struct(*[F.col(k) for k in keys])


def bucketed(df: DataFrame, keys: Sequence[str], base: Column, order: Sequence[str], facts: dict[str, Column], name: str,
             split_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_kb`` = (keys, _bucket = (base, part)), and a summary: one row per ``_kb`` with the aggregates
    ``facts``, combined before its shuffle. ``base`` must be monotone in ``order``; so is ``_bucket``, within a key.

    With ``split_rows`` the summary also counts rows. It is needed anyway and written once, so looking for (key, bucket)
    groups of more than ``split_rows`` rows costs no pass over the input. Where there are none, the part is 0 and
    that is all. The rows of those that are found are dealt out by Spark's range partitioning on (keys, base, order), to
    tasks of ``split_rows`` rows on average, and written with their task as the part: a group is cut wherever its total
    order says, also between rows of one time that differ in a later column of ``order``."""
    def keyed(rows: DataFrame, part: Column) -> DataFrame:
        bucket = F.struct(base.alias("base"), part.cast("int").alias("part")).alias("_bucket")
        return rows.withColumn("_kb", F.struct(*[F.col(k) for k in keys], bucket))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_kb").agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in facts.items()])

    rows = keyed(df, F.lit(0))
    if not split_rows:
        return rows, summed(rows)
    summary = _materialize(summed(rows), f"{name}-buckets")
    hot = summary.where(F.col("_rows") > split_rows).select("_kb", "_rows")
    n = hot.agg(F.sum("_rows")).first()[0]
    if n is None:
        return rows, summary
    hot = hot.select("_kb")
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // split_rows))
    places = [*keys, base, *[F.col(c) for c in order]]
    cut = rows.join(hot, "_kb", "left_semi").drop("_kb").repartitionByRange(tasks, *places).withColumn("_at", F.monotonically_increasing_id())
    cut = keyed(_materialize(cut, f"{name}-hot"), F.shiftright("_at", 33)).drop("_at")
    return (rows.join(hot, "_kb", "left_anti").select(*rows.columns).unionByName(cut),
            summary.join(hot, "_kb", "left_anti").unionByName(summed(cut)))


def _key_of(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col("_kb").getField(k).alias(k) for k in keys])


def previous_row(df: DataFrame, keys: Sequence[str], time_col: str, tiebreak: str, carry: Sequence[str],
                 bucket_ns: int, prefix: str = "prev_", materialize: bool = False, split_rows: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` (for ``c`` in ``carry`` plus ``time_col``) from the previous row of the same key in
    (time, tiebreak) order; null for a key's first row.

    The input feeds the window and the per-bucket summaries (each bucket's last row). Over a table scan that is two
    column-pruned reads; when ``df`` is an expensive derivation pass ``materialize=True`` to compute it once.
    ``split_rows``: see ``bucketed``."""
    carried = [time_col, *[c for c in carry if c != time_col]]
    if materialize:
        df = _materialize(df, "previous-row")
    order = [F.col(time_col), F.col(tiebreak)]
    last = F.max_by(F.struct(*[F.col(c) for c in carried]), F.struct(*order))
    b, summary = bucketed(df, keys, truncate_ns(F.col(time_col), bucket_ns), [time_col, tiebreak], {"_last": last}, "previous-row", split_rows)
    w = Window.partitionBy("_kb").orderBy(*order)
    within = b.select(
        "*", *[F.lag(c).over(w).alias(prefix + c) for c in carried],
        (F.row_number().over(w) == 1).alias("_first_in_bucket"),
    )
    # over the summaries: the previous non-empty bucket's last row for each bucket
    wb = Window.partitionBy(_key_of(keys)).orderBy(F.col("_kb").getField("_bucket"))
    carry_in = summary.select("_kb", F.lag("_last").over(wb).alias("_carry"))
    joined = within.join(carry_in, "_kb", "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            F.when(F.col("_first_in_bucket"), F.col("_carry").getField(c)).otherwise(F.col(prefix + c)).alias(prefix + c)
            for c in carried
        ],
    )


def rolling_agg(df: DataFrame, keys: Sequence[str], time_col: str, width_ns: int, aggs: dict[str, Column],
                bucket_ns: int) -> DataFrame:
    """Aggregates over the trailing range ``(t - width, t]`` of the same key (peers at equal time included).

    Rows are bucketed by time; a row is also copied into the next bucket when it lies within ``width`` of that
    bucket's start, so every window is complete inside one (key, bucket) partition. Buckets are as wide as the
    window at least.
    """
    bucket_ns = max(bucket_ns, width_ns)
    home = truncate_ns(F.col(time_col), bucket_ns)
    near_next = F.col(time_col) > home + (bucket_ns - width_ns)
    # One pass over the input: every row is emitted for its own bucket and, when within `width` of the next
    # bucket's start, once more as context for that bucket (explode, not a self-union that would read twice).
    copies = F.when(near_next, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = df.select("*", F.explode(copies).alias("_ctx")).withColumn(
        "_bucket", home + F.when(F.col("_ctx"), F.lit(bucket_ns)).otherwise(F.lit(0)))
    w = Window.partitionBy(*keys, "_bucket").orderBy(time_col).rangeBetween(-(width_ns - 1), 0)
    out = both.select("*", *[a.over(w).alias(name) for name, a in aggs.items()])
    return out.where(~F.col("_ctx")).drop("_bucket", "_ctx")


def rolling_sums(df: DataFrame, keys: Sequence[str], time_col: str, value_col: str, width_ns: int, bucket_ns: int,
                 split_rows: int | None = None) -> DataFrame:
    """Mean of a value (``_mean``) and number of rows (``_points``) over the trailing range ``(t - width, t]``, one row
    per key and time, however many rows a range holds.

    Rows of one key and time are added up first. The sums over a range are differences of running totals: that at ``t``
    less that of the latest time at or before ``t - width`` (an as-of join of the totals with themselves). Decimal
    totals make the differences exact; they hold values under a million in size with at most 20 decimals, as
    all doubles of telemetry size are written. A range with any other value takes the difference of double totals."""
    exact = F.when(F.abs(value_col) < 1e6, F.col(value_col)).cast("decimal(38,20)")
    fits = exact.cast("double") == F.col(value_col)
    odd = F.col(value_col).isNotNull() & ~F.coalesce(fits, F.lit(False))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    each = df.groupBy(*keys, time_col).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(value_col).alias("_values"), F.count_if(odd).alias("_odd"),
        total(F.when(fits, exact)).cast("decimal(38,20)").alias("_exact"), total(value_col).cast("double").alias("_double"))
    sums = ["_rows", "_values", "_odd", "_exact", "_double"]
    upto = running_totals(each, [time_col], {f"{c}_upto": c for c in sums}, truncate_ns(F.col(time_col), bucket_ns), keys, split_rows=split_rows)
    upto = _materialize(upto.select(*keys, time_col, *[f"{c}_upto" for c in sums]), "rolling-totals")
    earlier = upto.select(*keys, F.col(time_col).alias("_low_time"), *[F.col(f"{c}_upto").alias(f"{c}_low") for c in sums])
    both = asof_join(upto.withColumn("_low", F.col(time_col) - width_ns), earlier, keys, "_low", "_low_time",
                     [f"{c}_low" for c in sums], bucket_ns, split_rows=split_rows, tiebreak="_low")
    inside = {c: F.col(f"{c}_upto") - F.coalesce(F.col(f"{c}_low"), F.lit(0)) for c in sums}
    added = F.when(inside["_odd"] == 0, inside["_exact"].cast("double")).otherwise(inside["_double"])
    return both.select(*keys, time_col, F.when(inside["_values"] > 0, added / inside["_values"]).alias("_mean"), inside["_rows"].alias("_points"))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              payload: Sequence[str], bucket_ns: int, materialize: bool = False, split_rows: int | None = None,
              tiebreak: str | None = None) -> DataFrame:
    """Left join each left row to the latest right row of the same key with ``right_time <= left_time``; of right rows
    of one time, to that with the largest payload.

    Within a (key, bucket) partition a running ``last(ignorenulls)`` over the union of both sides finds matches in
    the same bucket; the latest right row of any earlier bucket comes from per-bucket summaries. ``split_rows``: see
    ``bucketed``; with ``tiebreak`` (a left column) left rows of one time are cut apart, too.
    """
    if materialize:
        left = _materialize(left, "asof-left")
    lcols = left.columns
    pay = F.struct(F.col(right_time).alias("_rt"), *[F.col(p) for p in payload])
    pay_type = right.select(pay.alias("p")).schema["p"].dataType
    lb = left.select(*lcols, F.lit(None).cast(pay_type).alias("_pay"), F.col(left_time).alias("_t"),
                     F.lit(1).alias("_side"))
    rb_cols = [F.lit(None).cast(left.schema[c].dataType).alias(c) if c not in keys else F.col(c) for c in lcols]
    rb = right.select(*rb_cols, pay.alias("_pay"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"))
    order = ["_t", "_side", "_pay", *([tiebreak] if tiebreak else [])]
    u, summary = bucketed(lb.unionByName(rb), keys, truncate_ns(F.col("_t"), bucket_ns), order, {"_last": F.max("_pay")}, "asof", split_rows)
    w = Window.partitionBy("_kb").orderBy("_t", "_side", "_pay").rowsBetween(Window.unboundedPreceding, 0)
    within = u.withColumn("_match", F.last("_pay", ignorenulls=True).over(w)).where(F.col("_side") == 1)
    # (the largest payload of a bucket is its latest: it begins with the time)
    wb = Window.partitionBy(_key_of(keys)).orderBy(F.col("_kb").getField("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select("_kb", F.last("_last", ignorenulls=True).over(wb).alias("_carry"))
    j = within.join(carry, "_kb", "left")
    m = F.coalesce(F.col("_match"), F.col("_carry"))
    return j.select(*lcols, *[m.getField(p).alias(p) for p in payload], m.getField("_rt").alias(right_time))


def running_sum(df: DataFrame, order: Sequence[str], value_col: str, bucket: Column, out_col: str,
                partition: Sequence[str] = (), materialize: bool = False,
                super_bucket: Column | None = None, split_rows: int | None = None) -> DataFrame:
    """``running_totals`` of one column of whole numbers."""
    out = running_totals(df, order, {out_col: value_col}, bucket, partition, materialize, super_bucket, split_rows)
    return out.withColumn(out_col, F.col(out_col).cast("long"))


def running_totals(df: DataFrame, order: Sequence[str], sums: dict[str, str], bucket: Column, partition: Sequence[str] = (),
                   materialize: bool = False, super_bucket: Column | None = None, split_rows: int | None = None) -> DataFrame:
    """Running totals in ``order`` (within ``partition``), for each output column of ``sums`` that of an input column,
    computed as a prefix sum of per-bucket totals plus a running sum inside each bucket: no window ever sees more than
    one bucket of rows.

    ``bucket`` must be monotone in ``order`` (for example the time truncated to a minute); ``split_rows``: see
    ``bucketed``. Bucket offsets are a prefix sum over one row per bucket. With ``super_bucket`` (monotone in
    ``bucket``, for example the day) that prefix is taken in two levels -- over super-bucket totals, then inside each
    super-bucket -- so the only sequential step (when there is no ``partition``) sees one row per super-bucket.
    """
    if materialize:
        df = _materialize(df, "running-sum")
    tot = {f"_tot{i}": c for i, c in enumerate(sums.values())}
    # Bucket totals from the rows, combined before their shuffle (a row per bucket and task), so that the window
    # over all rows is worked out once; a sum doesn't depend on the order of rows that tie.
    facts = {t: F.sum(c) for t, c in tot.items()} | ({"_super": F.max(super_bucket)} if super_bucket is not None else {})
    b, totals = bucketed(df, partition, bucket, order, facts, "running-sum", split_rows)
    wi = Window.partitionBy("_kb").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = b.select("*", *[F.sum(c).over(wi).alias(f"_run{i}") for i, c in enumerate(sums.values())])
    bucket_of = F.col("_kb").getField("_bucket")
    part = [F.col("_kb").getField(k).alias(k) for k in partition]

    def earlier(prefix: str, name: str, over: list[Column], by: Column) -> list[Column]:
        w = (Window.partitionBy(*over).orderBy(by) if over else Window.orderBy(by)).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(f"{name}{i}").over(w), F.lit(0)).alias(f"{prefix}{i}") for i in range(len(sums))]

    if super_bucket is None:
        offsets = totals.select("_kb", *earlier("_off", "_tot", part, bucket_of))
    else:
        # Level 1: inside each super-bucket, partitioned by it. Level 2: over one row per super-bucket.
        inner = totals.select("_kb", "_super", *part, *earlier("_in", "_tot", [*part, F.col("_super")], bucket_of))
        sup = totals.select(*part, "_super", *tot).groupBy(*[F.col(k) for k in partition], "_super").agg(
            *[F.sum(t).alias(f"_stot{i}") for i, t in enumerate(tot)])
        sup_off = sup.select(*partition, "_super", *earlier("_soff", "_stot", [F.col(k) for k in partition], F.col("_super")))
        offsets = _join_keys(inner, sup_off, [*partition, "_super"]).select(
            "_kb", *[(F.col(f"_in{i}") + F.col(f"_soff{i}")).alias(f"_off{i}") for i in range(len(sums))])
    j = within.join(offsets, "_kb", "inner")
    return j.select(*df.columns, *[(F.col(f"_off{i}") + F.col(f"_run{i}")).alias(out) for i, out in enumerate(sums)])


def _join_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of two small frames on ``on`` with null keys matching (via one struct key)."""
    lk = left.withColumn("_jk", _key_struct(on))
    rk = right.select(_key_struct(on).alias("_jk"), *[c for c in right.columns if c not in on])
    return lk.join(rk, "_jk", "inner").drop("_jk")

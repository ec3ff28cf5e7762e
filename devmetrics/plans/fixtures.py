"""Views over the driver's Parquet tables that stand in for recorded inputs at scale (for the registered queries only;
the library doesn't depend on them).

``telemetry`` is derived from ``events``; the ledger tables (``enqueues``, ``dispatches``, ``acks``, ``requeues``,
``sink_log``) from ``telemetry``; ``attempts`` from ``lineitem``; ``assignments`` from ``orders``. Every view is a
lazy DataFrame over the whole table, so its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import datetime as dt

from devmetrics.functions.values import NS_PER_HOUR, NS_PER_SECOND, NS_PER_US, ns_from_timestamp_ntz

ACK_TIMEOUT_NS = 30 * NS_PER_SECOND
REDELIVERY_DELAY_NS = 40 * NS_PER_SECOND


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return c.cast("string")


def telemetry(spark: SparkSession, sf_dir: str, start_ns: int | None = None, stop_ns: int | None = None) -> DataFrame:
    """Canonical telemetry messages from ``events``, carrying the awkward cases on purpose (empty ids and
    namespaces, empty model lists, spaced labels, valueless keys, repeated keys, '=' in values, empty keys and labels
    that collide with columns).

    ``start_ns``/``stop_ns`` state a time range on the raw ``ts`` column as well (a superset, to the microsecond),
    so it reaches the Parquet scan as a pushed filter; the exact ns range is applied by the read operators."""
    e = table(spark, sf_dir, "events")
    if start_ns is not None:
        e = e.where(F.col("ts") >= _ntz(start_ns // NS_PER_US))
    if stop_ns is not None:
        e = e.where(F.col("ts") <= _ntz(-(-stop_ns // NS_PER_US)))
    return telemetry_from_events(e)


def _ntz(micros: int):
    """TIMESTAMP_NTZ literal for a count of microseconds since the epoch (UTC wall clock, zone-free)."""
    t = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def telemetry_from_events(e: DataFrame) -> DataFrame:
    """The ``telemetry`` projection of an ``events`` frame (batch or streaming): row by row, no shuffle."""
    k_text = F.regexp_extract("props", "([0-9]+)", 1)
    node = F.concat(F.lit(",source_node=node-"), _s(F.col("event_id") % 10))
    labels = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("k="), k_text, node))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit(" k = "), k_text, F.lit(" ,, flag "), node))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("k=1,k=2,expr=a=b,=orphan"), node))
        .when(F.col("event_id") % 5 == 3, F.concat(F.lit("namespace=from_label,gpu_id=label_gpu"), node))
        .otherwise(F.lit(""))
    )
    model_csv = (
        F.when(F.col("user_id") % 3 == 0, F.lit("A100,PCIe"))
        .when(F.col("user_id") % 3 == 1, F.lit("H100,SXM5"))
        .otherwise(F.lit(""))
    )
    return e.select(
        F.col("event_id").alias("persist_key"),
        ns_from_timestamp_ntz(F.col("ts")).alias("timestamp_ns"),
        F.col("event_type").alias("metric_name"),
        F.when(F.col("event_id") % 97 == 0, F.lit("")).otherwise(_s(F.col("user_id"))).alias("gpu_id"),
        F.concat(F.lit("nvidia"), _s(F.col("user_id") % 8)).alias("device"),
        F.concat(F.lit("GPU-"), _s(F.col("user_id"))).alias("uuid"),
        F.when(model_csv == "", F.array().cast("array<string>")).otherwise(F.split(model_csv, ",")).alias("model_name"),
        F.when(F.col("user_id") % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("ns"), _s(F.col("user_id") % 5))).alias(
            "namespace"
        ),
        F.col("value"),
        labels.alias("labels_raw"),
        k_text.try_cast("long").alias("k"),
    )


def enqueues(tel: DataFrame) -> DataFrame:
    return tel.select(
        "persist_key",
        F.col("timestamp_ns").alias("enqueued_ns"),
        F.when(F.col("persist_key") % 50 == 0, "rejected")
        .when(F.col("persist_key") % 333 == 0, "invalid")
        .otherwise("enqueued")
        .alias("outcome"),
    )


def accepted(tel: DataFrame) -> DataFrame:
    # The outcome is a function of the key alone, so the accepted set needs no join back to `enqueues`.
    return tel.where((F.col("persist_key") % 50 != 0) & (F.col("persist_key") % 333 != 0))


def _rows_per_message(tel: DataFrame, candidates: list, keep: tuple[str, ...]) -> DataFrame:
    """One pass over the messages: each message yields the candidate rows whose condition holds (a ``when``
    without ``otherwise`` is null and dropped), exploded. Equivalent to a UNION ALL of filtered projections, but the
    source is read once -- and a later semi/anti join is not pushed into every union branch."""
    rows = F.filter(F.array(*candidates), lambda r: r.isNotNull())
    return tel.select(*keep, F.explode(rows).alias("_r"))


def dispatches(tel: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """First delivery for every accepted message; a second one 40 s later for some that were late or never acked.
    ``carry`` adds columns of the message row (each delivery is a function of its message: no join back)."""
    key = _s(F.col("persist_key"))
    d = _rows_per_message(accepted(tel), [
        F.struct(F.concat(F.lit("d1-"), key).alias("message_id"), F.col("timestamp_ns").alias("sent_ns")),
        F.when(_redelivery(), F.struct(F.concat(F.lit("d2-"), key).alias("message_id"),
                                      (F.col("timestamp_ns") + REDELIVERY_DELAY_NS).alias("sent_ns"))),
    ], ("persist_key", *carry))
    return d.select("_r.message_id", "persist_key", "_r.sent_ns", *carry)


def _redelivery():
    return ((F.col("metric_name") == "error") | (F.col("k") > 30)) & (F.col("persist_key") % 2 == 0)


def redelivered(tel: DataFrame) -> DataFrame:
    """Accepted messages that get a second delivery (late or never acked, even keys)."""
    return accepted(tel).where(_redelivery())


def acks(tel: DataFrame) -> DataFrame:
    """First deliveries acked after k seconds unless `error`; some second deliveries once or twice; unknown ids;
    empty ids. Derived row by row from `telemetry` in one pass (each ack is a function of its message)."""
    key = _s(F.col("persist_key"))
    ts = F.col("timestamp_ns")
    is_accepted = (F.col("persist_key") % 50 != 0) & (F.col("persist_key") % 333 != 0)
    second = is_accepted & _redelivery()

    def ack(mid, at):
        return F.struct(mid.alias("message_id"), at.alias("ack_ns"))

    a = _rows_per_message(tel, [
        F.when(is_accepted & (F.col("metric_name") != "error"),
               ack(F.concat(F.lit("d1-"), key), ts + F.col("k") * NS_PER_SECOND)),
        F.when(second & (F.col("persist_key") % 4 == 0),
               ack(F.concat(F.lit("d2-"), key), ts + REDELIVERY_DELAY_NS + 5 * NS_PER_SECOND)),
        F.when(second & (F.col("persist_key") % 8 == 0),
               ack(F.concat(F.lit("d2-"), key), ts + REDELIVERY_DELAY_NS + 100 * NS_PER_SECOND)),
        F.when(F.col("persist_key") % 100 == 0, ack(F.concat(F.lit("ghost-"), key), ts)),
        F.when(F.col("persist_key") % 500 == 0, ack(F.lit(""), ts)),
    ], ())
    return a.select("_r.message_id", "_r.ack_ns")


def _code():
    return (
        F.when(F.col("l_returnflag") == "A", "ResourceExhausted")
        .when(F.col("l_returnflag") == "R", "Unavailable")
        .when(F.col("l_linestatus") == "O", "OK")
        .otherwise("InvalidArgument")
    )


def attempt_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status code of every attempt, without its number (no window needed)."""
    return table(spark, sf_dir, "lineitem").select(_code().alias("code"))


def attempt_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attempt number that occurs: 0 up to the most attempts of a message, from counts per message."""
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n").alias("n")).where("n > 0").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("attempt"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Send attempts per message from ``lineitem``; attempt order fixed by every column that could tie. One window by
    message (a message has as many rows as attempts, a handful)."""
    li = table(spark, sf_dir, "lineitem")
    order = [
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
    ]
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
    return li.select(F.col("l_orderkey").alias("message_key"), (number - 1).cast("long").alias("attempt"), _code().alias("code"))


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPU ownership changes for the as-of join: one owner per GPU and start time."""
    o = table(spark, sf_dir, "orders")
    return (
        o.groupBy((F.col("o_custkey") % 150).alias("g"), (F.col("o_orderkey") % 720).alias("h"))
        .agg(F.max("o_orderkey").alias("mx"))
        .select(
            _s(F.col("g")).alias("gpu_id"),
            (F.lit(1704067200000000000) + F.col("h") * NS_PER_HOUR).alias("from_ns"),
            F.concat(F.lit("wl-"), _s(F.col("mx"))).alias("owner"),
        )
    )


def model_tiers(spark: SparkSession) -> DataFrame:
    """Parameter table for K4 (tier per model list)."""
    return spark.createDataFrame([("A100,PCIe", "gold"), ("H100,SXM5", "platinum")], "model_name_csv string, tier string")


def allowlist(spark: SparkSession) -> DataFrame:
    """Parameter table for K3 (allowed namespaces)."""
    return spark.createDataFrame([("ns1",), ("ns2",)], "namespace string")


def sink_log(tel: DataFrame) -> DataFrame:
    """The collector's per-delivery log: the write fails for `error` metrics (then no ack is tried); the ack
    succeeded when the ledger holds one for that delivery."""
    d = dispatches(tel, carry=("metric_name",))
    d = d.join(acks(tel).select("message_id", F.lit(True).alias("_acked")).distinct(), "message_id", "left")
    write_ok = F.col("metric_name") != "error"
    return d.select("message_id", write_ok.alias("write_ok"), (write_ok & F.col("_acked").isNotNull()).alias("ack_ok"))

"""At-least-once delivery audits over recorded ledger tables.

The queue's in-memory state (pending map, ready list, counters) is re-aimed as joins and aggregates over
``enqueues``, ``dispatches`` and ``acks``. An ack is judged against the sending of its id (``in_order``), by one rule for
all queries; the empty message id -- the one value that could be hot -- is spread over many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devmetrics.functions.values import non_empty

#: What a send can end with.
SEND_OUTCOMES = ("enqueued", "rejected", "invalid", "closed", "persist_failed")

#: Groups over which acks without an id are spread.
NAMELESS_PARTS = 64


def in_order(dispatches: DataFrame, acks: DataFrame) -> DataFrame:
    """Sendings and acks in one frame (message_id, persist_key, sent_ns, ack_ns), with what was known of an id at each
    row's time: ``_sent`` (its sending, null before it) and ``_first`` (its first ack since then).

    One shuffle by id; the rows of an id are sorted and streamed, never held. At equal times the sending comes first. An
    id has as many acks as its receiver repeated; acks without an id, which may be many, are spread over ``''`` groups."""
    null = F.lit(None).cast("long")
    rows = dispatches.select("message_id", "persist_key", "sent_ns", null.alias("ack_ns")).unionByName(acks.select(
        F.coalesce(F.col("message_id"), F.lit("")).alias("message_id"), null.alias("persist_key"), null.alias("sent_ns"), "ack_ns"))
    spread = F.when(F.col("message_id") == "", F.pmod(F.xxhash64("ack_ns"), F.lit(NAMELESS_PARTS)))
    rows = rows.withColumn("_id", F.struct("message_id", spread.alias("part")))
    w = (Window.partitionBy("_id").orderBy(F.coalesce("sent_ns", "ack_ns"), F.col("sent_ns").isNull())
         .rowsBetween(Window.unboundedPreceding, 0))
    known = rows.withColumn("_sent", F.last("sent_ns", ignorenulls=True).over(w))
    return known.withColumn("_first", F.min(F.when(F.col("_sent").isNotNull(), F.col("ack_ns"))).over(w))


def delivery_acks(dispatches: DataFrame, acks: DataFrame) -> DataFrame:
    """One row per message id of either side: persist_key, sent_ns (null: never sent), first_ack_ns (the first ack at or
    after the sending), n_acks, and n_unknown of them that came before it. This is the one matching rule: an ack that
    comes before its sending finds nothing to complete, and a later one may still complete the delivery.

    Ids are those of single deliveries. Acks without an id come as several rows of the id ``''``."""
    early = F.when(F.col("_sent").isNull(), F.col("ack_ns"))
    return in_order(dispatches, acks).groupBy("_id").agg(
        F.max("persist_key").alias("persist_key"), F.max("sent_ns").alias("sent_ns"), F.min("_first").alias("first_ack_ns"),
        F.count("ack_ns").alias("n_acks"), F.count(early).alias("n_unknown"),
    ).select("_id.message_id", "persist_key", "sent_ns", "first_ack_ns", "n_acks", "n_unknown")


def match_acks(dispatches: DataFrame, acks: DataFrame, timeout_ns: int) -> DataFrame:
    """Dispatches matched with their first ack; latency and whether it was within the timeout (inclusive)."""
    m = delivery_acks(dispatches, acks).where(F.col("first_ack_ns").isNotNull())
    lat = F.col("first_ack_ns") - F.col("sent_ns")
    return m.select("message_id", "persist_key", "sent_ns", F.col("first_ack_ns").alias("ack_ns"), lat.alias("latency_ns"),
                    (lat <= timeout_ns).alias("on_time"))


def unknown_acks(dispatches: DataFrame, acks: DataFrame) -> DataFrame:
    """Acks for ids that weren't dispatched by then (or ever); accepted but without effect."""
    rows = in_order(dispatches, acks.where(non_empty(F.col("message_id"))))
    return rows.where(F.col("ack_ns").isNotNull() & F.col("_sent").isNull()).select("message_id", "ack_ns")


def invalid_acks(acks: DataFrame) -> DataFrame:
    """Acks without a message id (refused as an invalid argument)."""
    return acks.where(~non_empty(F.col("message_id")))


def message_states(dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """``delivery_acks`` with requeue_tick_ns and ``effective``: whether the first ack since the sending came before the
    requeue tick. A later one finds no pending entry and does not delete the durable copy."""
    tick = requeue_tick(F.col("sent_ns"), timeout_ns, scan_ns, t0_ns)
    ok = (F.col("first_ack_ns") < tick) & (F.col("message_id") != "")
    return delivery_acks(dispatches, acks).select("*", tick.alias("requeue_tick_ns"), F.coalesce(ok, F.lit(False)).alias("effective"))


def effective_acks(dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """Deliveries that an ack completed in time: (message_id, persist_key, ack_ns). Only these delete the durable copy."""
    done = message_states(dispatches, acks, timeout_ns, scan_ns, t0_ns).where("effective")
    return done.select("message_id", "persist_key", F.col("first_ack_ns").alias("ack_ns"))


def ack_classes(dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """C2 in full: every ack in one class, as (ack_class, acks) rows that add up to all acks: effective, repeated
    (after an effective one), late (of a requeued delivery), unknown (not dispatched by then, or never), invalid (no id)."""
    s = message_states(dispatches, acks, timeout_ns, scan_ns, t0_ns)
    n, since = F.col("n_acks"), F.col("n_acks") - F.col("n_unknown")
    total = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")
    named = F.col("message_id") != ""
    return _as_rows(s.agg(
        total(F.col("effective"), F.lit(1)).alias("effective"), total(F.col("effective"), since - 1).alias("repeated"),
        total(named & ~F.col("effective"), since).alias("late"), total(named, F.col("n_unknown")).alias("unknown"),
        total(~named, n).alias("invalid")), "ack_class", "acks")


def acked_keys(dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """Durable keys with at least one effectively acked delivery."""
    return effective_acks(dispatches, acks, timeout_ns, scan_ns, t0_ns).select("persist_key").distinct()


def unacked(enqueues: DataFrame, dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int,
            t0_ns: int = 0) -> DataFrame:
    """Accepted messages that no ack completed in time: their durable copy is still there, a restart recovers it."""
    accepted = enqueues.where(F.col("outcome") == "enqueued")
    return accepted.join(acked_keys(dispatches, acks, timeout_ns, scan_ns, t0_ns), "persist_key", "left_anti")


def expired_pending(dispatches: DataFrame, acks: DataFrame, as_of_ns: int, timeout_ns: int,
                    scan_interval_ns: int | None = None, t0_ns: int = 0) -> DataFrame:
    """C4: deliveries with no ack since their sending by ``as_of`` and sent more than ``timeout`` before it (strict).

    With ``scan_interval_ns`` the expiry is only noticed at a scan tick (E5): the delivery must also have reached
    its requeue tick by ``as_of``."""
    states = delivery_acks(dispatches, acks.where(F.col("ack_ns") <= as_of_ns))
    waiting = states.where(F.col("first_ack_ns").isNull()).select("message_id", "persist_key", "sent_ns")
    expired = waiting.where(F.lit(as_of_ns) - F.col("sent_ns") > timeout_ns)
    if scan_interval_ns is not None:
        expired = expired.where(requeue_tick(F.col("sent_ns"), timeout_ns, scan_interval_ns, t0_ns) <= as_of_ns)
    return expired


def requeue_tick(sent_ns: Column, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> Column:
    """E5: the first scan tick ``t0 + n*scan`` with ``tick - sent > timeout``."""
    return F.lit(t0_ns) + (F.call_function("div", sent_ns + timeout_ns - t0_ns, F.lit(scan_ns)) + 1) * scan_ns


def requeue_times(dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """E5: per delivery, the scan tick that requeues it unless its first ack came before that tick."""
    d = message_states(dispatches, acks, timeout_ns, scan_ns, t0_ns).where(F.col("sent_ns").isNotNull())
    return d.select("message_id", "persist_key", "sent_ns", "requeue_tick_ns", "first_ack_ns", F.col("effective").alias("acked_in_time"),
                    (~F.col("effective")).alias("requeued"))


def requeues(dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """The ``requeues`` ledger derived from E5: (message_id, persist_key, requeued_ns, reason)."""
    r = requeue_times(dispatches, acks, timeout_ns, scan_ns, t0_ns).where("requeued")
    return r.select("message_id", "persist_key", F.col("requeue_tick_ns").alias("requeued_ns"),
                    F.lit("timeout").alias("reason"))


def ready_after_requeue(enqueues: DataFrame, dispatches: DataFrame, acks: DataFrame, as_of_ns: int, timeout_ns: int,
                        scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """G1: the ready list at ``as_of``: (persist_key, source, ready_ns), one row per key that is still durable and not
    pending. ``backlog``: accepted and never sent, ready since it was accepted; ``requeue``: its latest delivery
    timed out, ready since the scan tick that noticed. Pending deliveries are not on the list (a restart drops the
    pending state and recovers every durable key: that list is C3)."""
    by_then = lambda df, col: df.where(F.col(col) <= as_of_ns)
    states = message_states(by_then(dispatches, "sent_ns"), by_then(acks, "ack_ns"), timeout_ns, scan_ns, t0_ns)
    sent = states.where(F.col("persist_key").isNotNull()).select(
        "persist_key", F.col("sent_ns"), F.col("requeue_tick_ns").alias("tick"), F.col("effective").cast("int").alias("done"),
        F.lit(None).cast("long").alias("enqueued_ns"))
    accepted = by_then(enqueues, "enqueued_ns").where(F.col("outcome") == "enqueued").select(
        "persist_key", F.lit(None).cast("long").alias("sent_ns"), F.lit(None).cast("long").alias("tick"),
        F.lit(None).cast("int").alias("done"), "enqueued_ns")
    # Ticks grow with the sending time, so the largest tick belongs to the latest delivery.
    keys = sent.unionByName(accepted).groupBy("persist_key").agg(
        F.max("enqueued_ns").alias("enqueued_ns"), F.max("tick").alias("tick"), F.max("done").alias("done"))
    durable = keys.where(F.col("enqueued_ns").isNotNull() & (F.coalesce("done", F.lit(0)) == 0)
                         & (F.col("tick").isNull() | (F.col("tick") <= as_of_ns)))
    return durable.select("persist_key", F.when(F.col("tick").isNull(), "backlog").otherwise("requeue").alias("source"),
                          F.coalesce("tick", "enqueued_ns").alias("ready_ns"))


def late_acks(dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """Acks of deliveries that were requeued: accepted, but without effect. A further ack of a delivery that was
    acked in time is a repeated one, not a late one, and one from before the sending is unknown (``ack_classes``)."""
    tick = requeue_tick(F.col("_sent"), timeout_ns, scan_ns, t0_ns)
    rows = in_order(dispatches, acks.where(non_empty(F.col("message_id"))))
    return rows.where(F.col("ack_ns").isNotNull() & (F.col("_first") >= tick)).select("message_id", "ack_ns", tick.alias("requeue_tick_ns"))


def deliveries(dispatches: DataFrame) -> DataFrame:
    """Deliveries per durable key (the correct count; the reference's field stays at 1)."""
    return dispatches.groupBy("persist_key").agg(F.count(F.lit(1)).alias("deliveries"))


def dead_letters(dispatches: DataFrame, acks: DataFrame, max_deliveries: int, timeout_ns: int, scan_ns: int,
                 t0_ns: int = 0) -> DataFrame:
    """Keys delivered at least ``max_deliveries`` times and never effectively acked (one row per delivery, then
    one aggregate per key)."""
    s = message_states(dispatches, acks, timeout_ns, scan_ns, t0_ns).where(F.col("persist_key").isNotNull())
    keys = s.groupBy("persist_key").agg(F.count(F.lit(1)).alias("deliveries"), F.max("effective").alias("_acked"))
    return keys.where((F.col("deliveries") >= max_deliveries) & ~F.col("_acked")).drop("_acked")


def _as_rows(wide: DataFrame, name_col: str = "counter", value_col: str = "value") -> DataFrame:
    """One-row frame of LONG counters -> (name, value) rows (``stack``: no join, no extra pass)."""
    cols = wide.columns
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (`{name_col}`, `{value_col}`)")


def queue_counters(enqueues: DataFrame, dispatches: DataFrame, acks: DataFrame, as_of_ns: int, timeout_ns: int,
                   scan_ns: int, t0_ns: int = 0) -> DataFrame:
    """The queue's counters at ``as_of`` as (counter, value) rows.

    One aggregate per message id (``message_states``), one per durable key over these and the sends, one over the
    keys: each table is read once. ``acked`` counts effective acks, ``requeued`` deliveries noticed as timed out by
    then, ``pending`` those still waited for, ``queue`` the length of the ready list (accepted - dispatched +
    requeued), ``recovered`` the accepted keys that a restart would reload (C3)."""
    by_then = lambda df, col: df.where(F.col(col) <= as_of_ns)
    s = message_states(by_then(dispatches, "sent_ns"), by_then(acks, "ack_ns"), timeout_ns, scan_ns, t0_ns)
    named, sent, done = F.col("message_id") != "", F.col("sent_ns").isNotNull(), F.col("effective")
    expired = sent & ~done & (F.col("requeue_tick_ns") <= as_of_ns)
    none, one = F.lit(0).cast("long"), lambda c: c.cast("long")
    messages = s.select("persist_key", none.alias("accepted"), *[none.alias(o) for o in SEND_OUTCOMES],
                        one(sent).alias("dispatched"), one(done).alias("acked"), one(expired).alias("requeued"),
                        one(sent & ~done & ~expired).alias("pending"),
                        F.when(named, F.col("n_unknown")).otherwise(0).alias("unknown_acks"),
                        F.when(~named, F.col("n_acks")).otherwise(0).alias("invalid_acks"))
    outcome = F.col("outcome")
    sends = by_then(enqueues, "enqueued_ns").select(
        "persist_key", one(outcome == "enqueued").alias("accepted"), *[one(outcome == o).alias(o) for o in SEND_OUTCOMES],
        *[none.alias(c) for c in messages.columns[2 + len(SEND_OUTCOMES):]])
    counts = messages.columns[2:]
    keys = messages.unionByName(sends).groupBy("persist_key").agg(F.max("accepted").alias("accepted"), *[F.sum(c).alias(c) for c in counts])
    recovered = (F.col("accepted") == 1) & (F.col("acked") == 0)
    totals = keys.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], F.count_if(recovered).alias("recovered"))
    queue = F.col("enqueued") - F.col("dispatched") + F.col("requeued")
    return _as_rows(totals.select("*", queue.alias("queue")))


def sink_rollup(sink_log: DataFrame) -> DataFrame:
    """Processed (written; a failed write is not counted as processed and is not acked), write failures and ack
    failures among the written."""
    return sink_log.agg(
        F.count_if(F.col("write_ok")).cast("long").alias("processed"),
        F.count_if(~F.col("write_ok")).cast("long").alias("write_failed"),
        F.count_if(F.col("write_ok") & ~F.col("ack_ok")).cast("long").alias("ack_failed"),
    )


def at_least_once_audit(enqueues: DataFrame, dispatches: DataFrame, acks: DataFrame, timeout_ns: int, scan_ns: int,
                        t0_ns: int = 0) -> DataFrame:
    """Accepted vs. acked vs. dispatched, as (check, value) rows.

    ``unique_acked`` counts accepted keys with an ack call that succeeded on any delivery (late or not), as a client
    sees it; ``effective_acked`` those whose durable copy is gone, ``missing`` those whose copy is still there. One
    aggregate per message id, one per key, one over the keys."""
    s = message_states(dispatches, acks, timeout_ns, scan_ns, t0_ns).where(F.col("persist_key").isNotNull())
    one = lambda c: c.cast("long")
    zero = F.lit(0).cast("long")
    rows = s.select("persist_key", zero.alias("accepted"), one(F.lit(True)).alias("n"), one(F.col("n_acks") > 0).alias("acked"),
                    one(F.col("effective")).alias("done"))
    sends = enqueues.where(F.col("outcome") == "enqueued").select("persist_key", one(F.lit(True)).alias("accepted"),
                                                                  *[zero.alias(c) for c in ("n", "acked", "done")])
    keys = rows.unionByName(sends).groupBy("persist_key").agg(F.max("accepted").alias("accepted"), F.sum("n").alias("n"),
                                                              F.max("acked").alias("acked"), F.max("done").alias("done"))
    acc = F.col("accepted") == 1
    return _as_rows(keys.agg(
        F.count_if(acc).alias("accepted"), F.count_if(acc & (F.col("acked") == 1)).alias("unique_acked"),
        F.count_if(acc & (F.col("done") == 1)).alias("effective_acked"), F.count_if(acc & (F.col("done") == 0)).alias("missing"),
        F.count_if(acc & (F.col("n") == 0)).alias("never_dispatched"), F.count_if(F.col("n") > 0).alias("dispatched_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("dispatches")), "check")


def reject_rate(enqueues: DataFrame) -> DataFrame:
    """Rejected / attempts x 100."""
    return enqueues.agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("outcome") == "rejected").cast("long").alias("rejected"),
        F.round(F.avg(F.when(F.col("outcome") == "rejected", 1.0).otherwise(0.0)) * 100, 6).alias("reject_rate_pct"),
    )


def latency_sketch(matched: DataFrame, by: str, accuracy: int = 10_000) -> DataFrame:
    """K11 approximately: p50 / p95 / p99 of ack latency per group with a bounded-memory sketch
    (``percentile_approx``): the rank of a returned value is off by at most ``rows / accuracy``."""
    q = F.percentile_approx("latency_ns", [0.5, 0.95, 0.99], accuracy)
    return matched.groupBy(by).agg(q.alias("_q"), F.count(F.lit(1)).alias("acked")).select(
        by, "acked", F.col("_q")[0].alias("p50_ns"), F.col("_q")[1].alias("p95_ns"), F.col("_q")[2].alias("p99_ns")
    )


def exact_percentiles(df: DataFrame, by: str, value_col: str, quantiles: dict[str, float],
                      value_bucket: Column) -> DataFrame:
    """K11 exactly: nearest-rank percentiles (the value at rank ``max(1, ceil(n*q))`` in ascending order) per group.

    Rows are counted per group and value first (combined before the shuffle: a value that all rows share is one
    row). The running count over distinct values is a prefix over buckets of values (``running_sum``;
    ``value_bucket`` must be monotone in the value), so a group of very many values is spread over many tasks."""
    from devmetrics.operators.sequence import running_sum

    counts = df.groupBy(by, value_col).agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_sum(counts, [value_col], "_c", value_bucket, "_upto", partition=(by,))
    n = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    rows = ranked.join(n, ranked[by].eqNullSafe(n[by])).drop(n[by])
    rank = lambda q: F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(q))).cast("long")
    picked = [F.max(F.when((F.col("_upto") >= rank(q)) & (F.col("_upto") - F.col("_c") < rank(q)), F.col(value_col))).alias(name)
              for name, q in quantiles.items()]
    return rows.groupBy(by).agg(F.max("_n").alias("acked"), *picked)

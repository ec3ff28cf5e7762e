"""Queue depth and order from the ledger (E1-E4), without an unpartitioned window over raw events.

Depth is a running sum of +1 (accept), -1 (dispatch: a pop, not an ack; pending is outside the depth) and +1
(requeue) in time order. ``running_sum`` computes it as per-bucket totals -> prefix sum over buckets (one row per
bucket) -> running sum inside each bucket, so no task sees more than one bucket of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.values import NS_PER_DAY, NS_PER_MINUTE, truncate_ns
from devmetrics.operators.sequence import running_sum


def depth_events(enqueues: DataFrame, dispatches: DataFrame, requeues: DataFrame | None = None,
                 with_refusals: bool = False) -> DataFrame:
    """(persist_key, event_ns, delta, kind) for every change of the ready list; ``with_refusals`` adds refused
    sends as ``refusal`` events with delta 0 (they see the depth but do not change it)."""
    acc = enqueues.where(F.col("outcome") == "enqueued").select(
        "persist_key", F.col("enqueued_ns").alias("event_ns"), F.lit(1).alias("delta"), F.lit("accept").alias("kind"))
    pop = dispatches.select("persist_key", F.col("sent_ns").alias("event_ns"), F.lit(-1).alias("delta"),
                            F.lit("dispatch").alias("kind"))
    ev = acc.unionByName(pop)
    if with_refusals:
        ev = ev.unionByName(enqueues.where(F.col("outcome") == "rejected").select(
            "persist_key", F.col("enqueued_ns").alias("event_ns"), F.lit(0).alias("delta"),
            F.lit("refusal").alias("kind")))
    if requeues is not None:
        ev = ev.unionByName(requeues.select("persist_key", F.col("requeued_ns").alias("event_ns"), F.lit(1).alias("delta"),
                                            F.lit("requeue").alias("kind")))
    return ev


def queue_depth(events: DataFrame, bucket_ns: int = NS_PER_MINUTE, partition: tuple[str, ...] = (),
                materialize: bool = False, split_rows: int | None = None) -> DataFrame:
    """Depth after every event; at equal times -1 comes before +1, then by key and kind (a total order).
    ``materialize`` computes the events once when they are derived by joins; with ``split_rows`` a bucket of more
    events is cut (see ``running_totals``)."""
    return running_sum(events, ["event_ns", "delta", "persist_key", "kind"], "delta",
                       truncate_ns(F.col("event_ns"), bucket_ns), "depth", partition, materialize,
                       super_bucket=truncate_ns(F.col("event_ns"), NS_PER_DAY), split_rows=split_rows)


def high_water(depth: DataFrame, max_size: int, pct: int = 80) -> DataFrame:
    """Accepts after which the queue is at or above ``pct`` percent full (integer division, as logged)."""
    fill = F.call_function("div", F.col("depth") * 100, F.lit(max_size))
    return depth.where(F.col("kind") == "accept").select("*", fill.alias("fill_pct"), (fill >= pct).alias("high_water"))


def saturated(depth: DataFrame, max_size: int) -> DataFrame:
    """Accepts that found the recorded queue at ``max_size`` or above. A predicate on the recorded depth: had the
    first of them been refused, the depth after it would have been smaller."""
    return depth.where(F.col("kind") == "accept").select(
        "*", (F.col("depth") - 1 >= max_size).alias("would_reject"))


def saturation_check(depth: DataFrame, max_size: int) -> DataFrame:
    """E3 against the record: for every send (accepted or refused), the length it met and whether a queue of
    ``max_size`` of that recorded length would refuse it (length >= max), per recorded outcome and prediction."""
    sends = depth.where(F.col("kind").isin("accept", "refusal")).select(
        F.when(F.col("kind") == "accept", "enqueued").otherwise("rejected").alias("recorded"),
        ((F.col("depth") - F.col("delta")) >= max_size).alias("predicted_reject"))
    return sends.groupBy("recorded", "predicted_reject").agg(F.count(F.lit(1)).alias("sends"))


def fifo_order(backlog: DataFrame, bucket_keys: int = 1_000_000, materialize: bool = False) -> DataFrame:
    """Position of each durable key in recovery order (ascending ``persist_key``), 1-based, as a distributed
    running count over key buckets; other columns ride along. One row per super-bucket (a thousand buckets of keys)
    meets in the only unpartitioned step."""
    ones = backlog.withColumn("_one", F.lit(1))
    pos = running_sum(ones, ["persist_key"], "_one", F.call_function("div", F.col("persist_key"), F.lit(bucket_keys)),
                      "position", materialize=materialize,
                      super_bucket=F.call_function("div", F.col("persist_key"), F.lit(bucket_keys * 1000)))
    return pos.drop("_one")

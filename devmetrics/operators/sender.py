"""Sender outcomes from recorded attempts.

Per message the first terminal attempt decides: ``OK`` -> sent; a non-retryable failure -> dropped at once; the
last allowed attempt (``max_retries``) failing -> dropped. A logical failure (call succeeded but refused) is retried.
Attempts after the terminal one are ignored. One partial aggregate per message: no sort, no per-message window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.values import is_retryable

LOGICAL_FAILURE = "LogicalFailure"


def sender_rollup(attempts: DataFrame, max_retries: int = 5) -> DataFrame:
    """(message_key, outcome, attempts_used, final_code); ``pending`` when the ledger stops before a terminal
    attempt."""
    code = F.col("code")
    terminal = (code == "OK") | (~is_retryable(code) & (code != LOGICAL_FAILURE)) | (F.col("attempt") == max_retries)
    per_msg = attempts.where(F.col("attempt") <= max_retries).groupBy("message_key").agg(
        F.min_by(F.when(terminal, F.struct("attempt", "code")), F.when(terminal, F.col("attempt"))).alias("_t"),
    )
    t = F.col("_t")
    return per_msg.select(
        "message_key",
        F.when(t.isNull(), "pending").when(t["code"] == "OK", "sent").otherwise("dropped").alias("outcome"),
        (t["attempt"] + 1).cast("long").alias("attempts_used"),
        t["code"].alias("final_code"),
    )


def sender_totals(rollup: DataFrame) -> DataFrame:
    """Messages per outcome (the sender's sent / dropped counters)."""
    return rollup.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))

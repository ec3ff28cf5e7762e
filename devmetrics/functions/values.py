"""Value parsing, identifiers, retry rules and nanosecond time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal float text accepted as a metric value (optional sign, digits with optional point, or a
# leading point, optional exponent). Spark's cast alone also takes ' 10.5', '1d' and hex floats.
FLOAT_TEXT = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"

# Special float words the reference's parser accepts (case-insensitive) and then refuses as not finite.
NON_FINITE_TEXT = r"(?i)\A[+-]?(inf|infinity|nan)\z"

# Characters allowed in a safe identifier.
SAFE_IDENTIFIER = r"\A[A-Za-z0-9_.:-]+\z"

# Status codes a sender retries.
RETRYABLE_CODES = ("ResourceExhausted", "Unavailable", "DeadlineExceeded")

NS_PER_US = 1000
NS_PER_SECOND = 1_000_000_000
NS_PER_MINUTE = 60 * NS_PER_SECOND
NS_PER_HOUR = 60 * NS_PER_MINUTE
NS_PER_DAY = 24 * NS_PER_HOUR


def parse_value(text: Column) -> Column:
    """B2: strict decimal float -> DOUBLE; null for non-numeric, NaN, +-Inf and overflow."""
    d = F.when(text.rlike(FLOAT_TEXT), text.try_cast("double"))
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def value_reject_reason(text: Column) -> Column:
    """Why a value text is refused, or null when it is a finite float: ``not finite`` for NaN/Inf words,
    ``invalid value`` for anything else that is not a decimal float, including overflow such as ``1e999``."""
    d = text.try_cast("double")
    return (
        F.when(text.isNull(), F.lit("incomplete record"))
        .when(text.rlike(NON_FINITE_TEXT), F.lit("not finite"))
        .when(~text.rlike(FLOAT_TEXT), F.lit("invalid value"))
        .when(d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit("invalid value"))
    )


def is_safe_identifier(c: Column) -> Column:
    """Non-empty and only ASCII letters, digits and ``_ . : -`` (anchored with \\A..\\z: '$' would let a
    trailing newline pass)."""
    return F.coalesce(c.rlike(SAFE_IDENTIFIER), F.lit(False))


def non_empty(c: Column) -> Column:
    """Neither null nor ''."""
    return c.isNotNull() & (c != "")


def is_retryable(code: Column) -> Column:
    """Transient status codes; anything else (and null) is not retried."""
    return F.coalesce(code.isin(*RETRYABLE_CODES), F.lit(False))


def backoff_bound_ms(attempt: Column, initial_ms: float = 100.0, factor: float = 2.0, max_ms: float = 5000.0) -> Column:
    """Upper bound of the wait before retry ``attempt`` (0 = first retry): min(initial*factor^attempt, max)."""
    return F.least(F.lit(float(initial_ms)) * F.pow(F.lit(float(factor)), attempt.cast("double")), F.lit(float(max_ms)))


def ns_from_timestamp_ntz(ts: Column) -> Column:
    """Nanoseconds since the epoch of a TIMESTAMP_NTZ read as UTC, independent of the session zone.

    Built from calendar parts (day number, hour, minute, seconds with fraction): ``timestampdiff`` and casts would
    go through a zoned TIMESTAMP and shift by an hour across a daylight-saving change in non-UTC sessions."""
    micros = (
        F.unix_date(F.to_date(ts)).cast("long") * (86_400 * 1_000_000)
        + F.hour(ts).cast("long") * 3_600_000_000
        + F.minute(ts).cast("long") * 60_000_000
        + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    )
    return micros * NS_PER_US


def floor_div(ns: Column, unit: int) -> Column:
    """Floor division of a LONG (exact, also for negatives)."""
    return F.call_function("div", ns - F.pmod(ns, F.lit(unit)), F.lit(unit))


def truncate_ns(ns: Column, unit: int) -> Column:
    """Start of the epoch-aligned bucket of width ``unit`` containing ``ns``."""
    return ns - F.pmod(ns, F.lit(unit))


def ns_to_timestamp(ns: Column) -> Column:
    """Ns -> TIMESTAMP (UTC instant), flooring to microseconds. For display and event time only."""
    return F.timestamp_micros(floor_div(ns, NS_PER_US))


def ns_to_utc_date(ns: Column) -> Column:
    """UTC calendar date of an ns instant, independent of the session zone (used as a partition column)."""
    return F.date_from_unix_date(floor_div(ns, NS_PER_DAY).cast("int"))


def arrival_ns() -> Column:
    """Arrival time in ns (one value per query evaluation, as ``current_timestamp``)."""
    return F.unix_micros(F.current_timestamp()) * NS_PER_US


def resolve_time(ns: Column, arrival: Column | None = None) -> Column:
    """A zero time means 'now' (arrival time); any other value is kept."""
    return F.when(F.coalesce(ns, F.lit(0)) == 0, arrival if arrival is not None else arrival_ns()).otherwise(ns)


def append_source_node(labels_raw: Column, node: str | Column) -> Column:
    """``labels || ',source_node=' || node`` (also when the labels are empty)."""
    node_col = node if isinstance(node, Column) else F.lit(node)
    return F.concat(F.coalesce(labels_raw, F.lit("")), F.lit(",source_node="), node_col)

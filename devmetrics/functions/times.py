"""RFC 3339 text -> nanoseconds, as a column (B20) and as a driver-side argument check."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from devmetrics.functions.values import NS_PER_SECOND, SAFE_IDENTIFIER

# RFC 3339 date-time with a mandatory zone (Z or +hh:mm); fractional seconds optional.
RFC3339 = r"\A(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2})(?:\.(\d+))?(Z|[+-]\d{2}:\d{2})\z"
_RFC3339_PY = re.compile(r"(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2})(?:\.(\d+))?(Z|[+-]\d{2}:\d{2})\Z")


def parse_rfc3339_ns(text: Column) -> Column:
    """B20 as a column: nanoseconds since the epoch (UTC), exact to the nanosecond; null when the text is not a
    valid RFC 3339 time with a zone (a space separator, a missing zone or 30 February all give null)."""
    date_part = F.regexp_extract(text, RFC3339, 1)
    time_part = F.regexp_extract(text, RFC3339, 2)
    frac = F.regexp_extract(text, RFC3339, 3)
    zone = F.regexp_extract(text, RFC3339, 4)
    whole = F.try_to_timestamp(
        F.concat(date_part, F.lit(" "), time_part, F.when(zone == "Z", F.lit("+00:00")).otherwise(zone)),
        F.lit("yyyy-MM-dd HH:mm:ssXXX"),
    )
    frac_ns = F.rpad(F.substr(frac, F.lit(1), F.lit(9)), 9, "0").cast("long")
    ns = F.unix_seconds(whole) * NS_PER_SECOND + F.coalesce(frac_ns, F.lit(0))
    return F.when(text.rlike(RFC3339) & whole.isNotNull(), ns)


def parse_rfc3339_or_default(text: Column, default_ns: Column) -> Column:
    """Empty text -> default; otherwise the parsed time (null when invalid)."""
    return F.when(F.coalesce(text, F.lit("")) == "", default_ns).otherwise(parse_rfc3339_ns(text))


def rfc3339_to_ns(text: str | None, default_ns: int | None = None) -> int:
    """B20 on the driver, for query arguments. Raises ValueError on anything but strict RFC 3339 with a zone."""
    if text is None or text == "":
        if default_ns is None:
            raise ValueError("time is required")
        return default_ns
    m = _RFC3339_PY.match(text)
    if not m:
        raise ValueError(f"not an RFC 3339 time: {text!r}")
    date_s, time_s, frac, zone = m.groups()
    tz = dt.timezone.utc if zone == "Z" else dt.timezone(
        (1 if zone[0] == "+" else -1) * dt.timedelta(hours=int(zone[1:3]), minutes=int(zone[4:6]))
    )
    whole = dt.datetime.fromisoformat(f"{date_s}T{time_s}").replace(tzinfo=tz)
    seconds = int((whole - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)).total_seconds())
    return seconds * NS_PER_SECOND + int((frac or "0")[:9].ljust(9, "0"))


def check_identifier(value: str) -> str:
    """B19 on the driver: refuse an empty or unsafe identifier argument."""
    if not value or not re.fullmatch(SAFE_IDENTIFIER.replace(r"\A", "").replace(r"\z", ""), value):
        raise ValueError(f"identifier contains invalid characters: {value!r}")
    return value


def time_range_ns(start: str | int | None, end: str | int | None, now_ns: int, default_window_ns: int) -> tuple[int, int]:
    """B16 argument rules: start defaults to now - window, end to now; end must be after start."""
    s = start if isinstance(start, int) else rfc3339_to_ns(start, now_ns - default_window_ns)
    e = end if isinstance(end, int) else rfc3339_to_ns(end, now_ns)
    if not e > s:
        raise ValueError("end_time must be after start_time")
    return s, e

"""Property tests: the label parser (B7) and the RFC 3339 parser (B20) against small Python models."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from devmetrics.functions.labels import WHITE_SPACE_CHARS, parse_labels


def model(text: str) -> dict[str, str]:
    """
    keys, a piece without '=' is a key with '', a repeated key keeps its last value."""
    tags: dict[str, str] = {}
    for piece in text.split(","):
        piece = piece.strip(WHITE_SPACE_CHARS)
        if not piece:
            continue
        if "=" in piece:
            k, v = piece.split("=", 1)
            k, v = k.strip(WHITE_SPACE_CHARS), v.strip(WHITE_SPACE_CHARS)
            if k:
                tags[k] = v
        else:
            tags[piece] = ""
    return tags


ALPHABET = "ab=,\"' \t\u00a0\u3000x1"


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=300))
def test_parse_labels_matches_model(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: dict(r.m) for r in df.select("i", parse_labels(F.col("t")).alias("m")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == model(text), repr(text)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(
    st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2099, 12, 31)),
    st.integers(0, 999_999_999), st.integers(0, 9), st.integers(-14 * 60, 14 * 60)), min_size=1, max_size=200))
def test_rfc3339_matches_python(spark, cases):
    from devmetrics.functions.times import parse_rfc3339_ns

    rows, expected = [], {}
    for i, (wall, nanos, digits, offset_min) in enumerate(cases):
        wall = wall.replace(microsecond=0)
        frac = str(nanos).rjust(9, "0")[:digits]
        sign = "+" if offset_min >= 0 else "-"
        zone = "Z" if offset_min == 0 else f"{sign}{abs(offset_min) // 60:02d}:{abs(offset_min) % 60:02d}"
        text = wall.strftime("%Y-%m-%dT%H:%M:%S") + (f".{frac}" if digits else "") + zone
        utc = wall - dt.timedelta(minutes=offset_min)
        seconds = int((utc - dt.datetime(1970, 1, 1)).total_seconds())
        expected[i] = seconds * 10**9 + (int(frac.ljust(9, "0")) if digits else 0)
        rows.append((i, text))
    df = spark.createDataFrame(rows, "i int, t string")
    got = {r.i: r.ns for r in df.select("i", parse_rfc3339_ns(F.col("t")).alias("ns")).collect()}
    assert got == expected

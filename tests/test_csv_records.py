"""Wide and broken CSV lines, and records over several lines in files that are split."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from devmetrics.sources.csv import N_FIELDS, parse_lines, read_metrics_csv
from devmetrics.sources.csv_records import read_records

HEADER = "when,what,card,node,id,n1,n2,n3,n4,space,reading,tags\n"


def _write(folder, text, name="m.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(text)


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of this many bytes."""
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield cut
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


@pytest.mark.parametrize("multi_line", [False, True])
def test_wide_lines_are_records(spark, tmp_dir, multi_line):
    good = "1,m,0,d,u,a,b,c,d,ns,1.0,x=1"
    lines = [good, "2,m,0,d,u,a,b,c,d,ns,2.0,y=1" + "," * 25_000, "3,m,0,d,u,a,b,c,d,ns,3.0,\"k=1,l=2\"" + ",q" * 1_000_000,
             '4,m,0,d,u,a,b,c,d,ns,4.0,"' + "k=v," * 30_000 + '"', '5,x",' + "," * 25_000 + '"', "," * 40_000, good.replace("1,m", "6,m")]
    _write(f"{tmp_dir}/in", HEADER + "\n".join(lines) + "\n")
    rows = read_metrics_csv(spark, f"{tmp_dir}/in", "h", event_time="recorded", multi_line=multi_line)
    got = {r.timestamp_ns: r for r in rows.collect()}
    assert len(got) == 7 and {t for t, r in got.items() if r.reject_reason is None} == {1, 2, 3, 4, 6}
    assert got[2].labels_raw == "y=1,source_node=h" and got[3].labels_raw == "k=1,l=2,source_node=h"
    assert got[4].labels_raw == "k=v," * 30_000 + ",source_node=h"
    assert got[5].reject_reason == "stray quote" and got[None].reject_reason == "invalid value"


def test_fields_of_random_lines_equal_a_csv_reader(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(400):
        n = rng.choice([1, 2, 11, 12, 13, 40])
        rows.append(["".join(rng.choices(["a", "é", ",", '"', " ", "\u0001", "日", "="], k=rng.choice([1, 2, 5]))) for _ in range(n)])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    lines = []
    for r in rows:
        out.seek(0), out.truncate()
        writer.writerow(r)
        lines.append(out.getvalue()[:-1])
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    got = parse_lines(df.coalesce(1).sortWithinPartitions("i")).collect()
    for r, want in zip(got, rows):
        assert r.broken is None and r.n_fields == len(want)
        assert [r[f"c{i}"] for i in range(min(len(want), N_FIELDS))] == want[:N_FIELDS]


def test_broken_quotes(spark):
    # by an odd number of quotes, one isn't closed
    cases = {'a,"b': "unclosed quote", 'a,b"c': "unclosed quote", 'a"b"c': "stray quote", 'a,"b"c': "stray quote", '"a"b","c': "stray quote", '"a""b"': None, '""': None,
             '"""a"""': None, '"': "unclosed quote", 'a,""': None, 'a,"",b': None, '"a,b","c"': None, "": None, '"a""': "unclosed quote"}
    df = spark.createDataFrame([(k,) for k in cases], "line string").coalesce(1)
    assert [r.broken for r in parse_lines(df).collect()] == list(cases.values())


def _records(rng, n):
    values = ["x", "k=v", "a,b", "two\nlines", 'q"q', "", "\n", "\n\n", '"', "é日", "three\n\"quoted\"\nlines,", ",\n,", '"\n"', "end\n"]
    return [[str(i), *rng.choices(values, k=rng.choice([1, 3, 11]))] for i in range(n)]


@pytest.mark.parametrize("seed,size,ends", [(1, 37, "\n"), (2, 100, "\n"), (3, 400, "\r\n"), (4, 5000, "\n")])
def test_records_of_split_files_equal_a_csv_reader(spark, tmp_dir, small_splits, seed, size, ends):
    rng = random.Random(seed)
    want = []
    for name in ("a.csv", "b.csv"):
        records = _records(rng, 120)
        out = io.StringIO()
        csv.writer(out, lineterminator=ends).writerows([["head", "er\nof two lines"], *records])
        _write(f"{tmp_dir}/in", out.getvalue(), name)
        want += records
    small_splits(size)
    got = read_records(spark, f"{tmp_dir}/in")
    if size < 1000:
        assert spark.read.text(f"{tmp_dir}/in").rdd.getNumPartitions() >= 8
    assert sorted(next(csv.reader(io.StringIO(r.record, newline=""))) for r in got.collect()) == sorted(want)


def test_large_file_equals_the_whole_file_reader(spark, tmp_dir, small_splits):
    rng = random.Random(7)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for i in range(20_000):
        tags = rng.choice(["k=v", "k=v,z=1", "a\nb", 'say "so"\nthen', "x" * 50])
        writer.writerow([i, "m", i % 7, "d", "u", "a", "b", "c", "d", "ns", i / 8, tags][:rng.choice([12, 12, 12, 5])])
    _write(f"{tmp_dir}/in", HEADER + out.getvalue())
    small_splits(64 << 10)
    assert spark.read.text(f"{tmp_dir}/in").rdd.getNumPartitions() >= 8
    rows = read_metrics_csv(spark, f"{tmp_dir}/in", "h", event_time="recorded", multi_line=True)
    plain = spark.read.csv(f"{tmp_dir}/in", header=True, multiLine=True, quote='"', escape='"', schema=", ".join(f"c{i} string" for i in range(12)))
    want = sorted((int(r.c0), r.c11 and f"{r.c11},source_node=h") for r in plain.collect())
    got = sorted((r.timestamp_ns, r.labels_raw if r.reject_reason is None else None) for r in rows.collect())
    assert got == want and len(got) == 20_000


@pytest.mark.parametrize("size", [40, 10_000])
def test_a_broken_line_is_one_reject(spark, tmp_dir, small_splits, size):
    row = lambda i, tags: f"{i},m,0,d,u,a,b,c,d,ns,1.0,{tags}"
    lines = [row(1, '"a=1,b=2"'), row(2, '"never closed'), row(3, '"c=1,d=2"'), row(4, "e=1"), row(5, 'f"g"h'), row(6, '"h\ni"'),
             "7,short", row(8, '"ends" badly'), row(9, '"j=1"'), row(10, '"open to the end')]
    _write(f"{tmp_dir}/in", HEADER + "\n".join(lines) + "\n")
    small_splits(size)
    rows = read_metrics_csv(spark, f"{tmp_dir}/in", "h", event_time="recorded", multi_line=True).collect()
    assert {r.timestamp_ns: r.reject_reason for r in rows} == {
        1: None, 2: "unclosed quote", 3: None, 4: None, 5: "stray quote", 6: None, 7: "incomplete record", 8: "stray quote", 9: None, 10: "unclosed quote"}
    assert len(rows) == 10


def test_an_open_quote_is_cut(spark, tmp_dir, small_splits):
    """A quote that nothing closes doesn't gather the rest of the file in one row."""
    lines = ["1,m,0,d,u,a,b,c,d,ns,1.0,x", '2,m,0,d,u,a,b,c,d,ns,1.0,"open', *["some line"] * 5000, '3,m,0,d,u,a,b,c,d,ns,1.0,"y=1,z=2"']
    _write(f"{tmp_dir}/in", HEADER + "\n".join(lines) + "\n")
    small_splits(1000)
    got = read_records(spark, f"{tmp_dir}/in", max_tail_chars=5000).collect()
    assert sorted(r.record[:2] for r in got) == ["1,", "2,", "3,"] and max(len(r.record) for r in got) < 7000
    assert read_records(spark, f"{tmp_dir}/in").agg(F.max(F.length("record"))).first()[0] > 50_000


def test_empty_files(spark, tmp_dir):
    _write(f"{tmp_dir}/in", "", "a.csv")
    _write(f"{tmp_dir}/in", HEADER, "b.csv")
    _write(f"{tmp_dir}/in", "\n\n  \n" + HEADER, "c.csv")
    assert read_records(spark, f"{tmp_dir}/in", header=False).count() == 2

"""Water-filling and the seeded fractional repetition, against an iterative clamp-and-redistribute in Python."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest

from devmetrics.llm import mixing
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights, share, epochs):
    left, active = share * sum(sizes.values()), set(sizes)
    target = dict.fromkeys(sizes, 0.0)
    while active:
        total = sum(weights[s] for s in active)
        above = {s for s in active if left * weights[s] / total > epochs * sizes[s]}
        if not above:
            for s in active:
                target[s] = left * weights[s] / total
            break
        for s in above:
            target[s] = float(epochs * sizes[s])
        left -= sum(target[s] for s in above)
        active -= above
    return target


def order(s):
    return (s is None, (s or "").encode("utf-32-be"))


def check(rows, got):
    sizes, words = defaultdict(int), {}
    for doc_id, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=order))}
    target = brute_targets(sizes, weights, 1.5, 2)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s], s
    assert len(got) == len(rows)


def test_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.collect()]
    check(rows, mixing.mix_sources(odd).collect())


def test_small_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = mixing.mix_sources(docs)
    check([tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()], got.collect())
    assert sorted(map(tuple, mixing.mix_sources(docs).collect())) == sorted(map(tuple, got.collect()))


def test_clamping_cascade(spark):
    """Small sources of great weight are clamped one after the other."""
    rows = [(i, "w " * n, None, f"s{i:02d}", None) for i, n in enumerate((1, 2, 3, 40, 5, 600, 7, 80, 9000))]
    check(rows, mixing.mix_sources(spark.createDataFrame(rows, DOCS)).collect())


def test_empty(empty):
    assert mixing.mix_sources(empty).collect() == []
    assert mixing.mixed_documents(empty).collect() == []


def test_mixed_documents_follow_the_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumnRenamed("n_chars", "key")  # a clashing name
    repeats = {r.doc_id: r.repeats for r in mixing.mix_sources(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = defaultdict(int)
    for r in mixed.collect():
        counts[r.doc_id] += 1
    assert {d: n for d, n in repeats.items() if n} == dict(counts)


def test_hot_source_is_cut_near_its_target(spark):
    """One source with nearly all rows: its partial repetition ends within a document of the target."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 7 + 1 as int)) AS text", "cast(null as string) AS lang",
                                          "if(id % 50 = 0, 'small', 'hot') AS source", "id AS n_chars")
    rows = mixing.mix_sources(docs).groupBy("source").agg({"target": "max", "taken": "sum"}).collect()
    for r in rows:
        assert abs(r["max(target)"] - r["sum(taken)"]) <= 7


def test_sample_key_is_md5(spark):
    got = spark.sql("select 5L AS doc_id, 'abc' AS text").select(mixing.sample_key(*(__import__("pyspark").sql.functions.col(c) for c in ("doc_id", "text")), 13))
    assert got.first()[0] == hashlib.md5(b"13:5:abc").hexdigest()


def test_oracle(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    want = con.sql(mixing.oracle_sql()).df().sort_values("doc_id").to_dict("records")
    got = mixing.mix_sources(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.target, r.taken) for r in got] == [(w["doc_id"], w["target"], w["taken"]) for w in want]

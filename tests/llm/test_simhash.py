import numpy as np
import pytest

from devmetrics.llm import simhash
from devmetrics.llm.components import components
from tests.conftest import SF_SMALL


def brute_components(prints, max_bits=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ prints[i]) <= max_bits) + i + 1:
            root[max(find(i), find(int(j)))] = min(find(i), find(int(j)))
    return [find(i) for i in range(len(prints))]


def brute_print(text):
    import xxhash

    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_small_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = simhash.near_duplicates(docs).orderBy("doc_id").collect()
    prints = [brute_print(r.text) for r in rows]
    assert [int(r.fingerprint, 16) for r in got] == prints
    want = brute_components(np.array(prints, np.uint64))
    assert [r.component_id for r in got] == [rows[i].doc_id for i in want]
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    assert kept == sorted({rows[i].doc_id for i in want})


def test_spark_hash_is_the_same(spark):
    got = spark.sql("select xxhash64('a b c') AS h").first().h
    import xxhash

    assert got % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_odd_rows(spark, odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    blank = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert blank == {2}
    kept = simhash.one_of_each(odd.withColumnRenamed("lang", "fp")).collect()  # a clashing name
    assert len(kept) == len({r.fingerprint for r in got})
    assert simhash.near_duplicates(empty).collect() == [] and simhash.one_of_each(empty).collect() == []


@pytest.mark.parametrize("chunk", [4096, 16])
def test_near_prints_in_groups(spark, chunk):
    """Balls of near prints (a few bits from a centre, chains of them) among random ones; small chunks split buckets."""
    rng = np.random.default_rng(3)
    prints = [int(x) for x in rng.integers(0, 2**64, 150, dtype=np.uint64)]
    for centre in prints[:3]:
        for _ in range(60):
            prints.append(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)))
    for start in prints[3:6]:
        for _ in range(20):
            start ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            prints.append(start)
    prints = sorted(set(prints))
    table = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(table, chunk=chunk).collect()}
    want = brute_components(np.array(prints, np.uint64))
    assert [got[p - (1 << 64) if p >> 63 else p] for p in prints] == want


def test_forest_spans_without_all_pairs():
    rng = np.random.default_rng(4)
    prints = np.unique(np.array([1 << int(a) ^ 1 << int(b) for a, b in rng.integers(0, 64, (300, 2))], np.uint64))
    links = simhash.forest(prints)
    assert len(links) == len(prints) - len(set(brute_components(prints)))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 103: 100}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []

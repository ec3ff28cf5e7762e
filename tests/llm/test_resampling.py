import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from devmetrics.llm import resampling
from tests.conftest import SF_SMALL


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for f in brute_features(text)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000.0) / ((a + 1) * (sum(t) + 10000.0)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in rows:
        words, found = brute_features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = 25 * len(order) // 100
    return out, order[:drawn]


@pytest.mark.parametrize("depth", [8, 64])
def test_crc_of_spans(depth):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 300_000).astype(np.uint8)
    lengths = [1, 2, 3, 7, 8, 9, 15, 16, 17, 63, 64, 65, 127, 128, 129, 1000, 4096, 99_999, 250_000]
    starts = np.array([int(rng.integers(0, len(data) - n + 1)) for n in lengths])
    ends = starts + np.array(lengths)
    got = resampling.Crc(depth).spans(data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[s:e].tobytes()) for s, e in zip(starts, ends)]


def test_overlapping_spans_of_zero_bytes():
    data = np.zeros(500, np.uint8)
    starts, ends = np.array([0, 0, 10, 499]), np.array([500, 1, 300, 500])
    assert resampling.Crc().spans(data, starts, ends).tolist() == [zlib.crc32(bytes(n)) for n in (ends - starts)]


def found_in(texts):
    words, counts = [0] * len(texts), [[] for _ in texts]
    for numbers, n, found in resampling.features(texts):
        for i, k in zip(numbers.tolist(), n.tolist()):
            words[i] += k
        for i, b in found.T.tolist():
            counts[i].append(b)
    return words, [sorted(c) for c in counts]


def test_features_of_odd_and_long_texts(monkeypatch):
    rng = random.Random(5)
    texts = [None, "", " ", "x", "A-b C\x00D\x7fé Ünï_日本語 １2", "a" * 3000, "ab " * 900,
             " ".join(rng.choice(["ab", "C", "dé", "日本", "x" * 70]) for _ in range(3000)), "!" * 5000 + "end", "b" * 2000 + " " + "c" * 2000 + " d"]
    for size in (1 << 18, 1000, 64):
        monkeypatch.setattr(resampling, "BATCH", size)
        words, counts = found_in(texts)
        assert words == [len(brute_features(t)[0]) for t in texts]
        assert counts == [sorted(map(bucket, brute_features(t)[1])) for t in texts]


def check(spark, docs, target):
    got = resampling.resample(docs, target).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, drawn = brute(rows, [r.text for r in target.collect()])
    key = lambda r: (r[0] is None, *[x or 0 for x in r])
    assert sorted(([r.doc_id, r.n_words, r.n_features, r.weight, r.score] for r in got), key=key) == sorted(want, key=key)
    ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[4]) for r in drawn]
    return got


def test_draw_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    target = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = check(spark, docs, target)
    again = resampling.resample(docs.repartition(7), target.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_odd_rows_and_clashing_names(spark, odd, empty):
    target = spark.createDataFrame([(1, "quick brown fox"), (2, None), (3, "")], "item_id long, text string")
    many = odd.withColumnsRenamed({"lang": "score", "source": "rank", "n_chars": "__rows"})
    many = many.unionByName(many).unionByName(many)  # repeated rows: ties in everything
    check(spark, many, target)
    check(spark, odd, target.limit(0))
    assert resampling.resample(empty, target).collect() == []


def test_nearer_documents_are_drawn_more_often(spark):
    rng = random.Random(2)
    near, far = [f"near{i}" for i in range(40)], [f"far{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(near if i % 2 else far, k=40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(" ".join(rng.choices(near, k=40_000)),)], "text string")
    drawn = [r.doc_id for r in resampling.resample(docs, target).where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(d % 2 for d in drawn) >= 80

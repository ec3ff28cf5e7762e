import numpy as np

from devmetrics.llm import ann
from tests.conftest import SF_CHECK


def brute(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (x * x[q]).sum(axis=1) / (norms * norms[q])
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_recall_and_scores(spark):
    vectors = ann.usable(spark.read.parquet(f"{SF_CHECK}/embeddings.parquet"))
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), rows=100, per_block=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute([(r.vec_id, r.v) for r in vectors.collect()])
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(abs(exact[q, i] - s) < 1e-14 for q in got for i, s in got[q] if (q, i) in exact)


def test_threshold_leaves_most_out():
    """Far vectors mostly stay unverified; near ones are found."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    x[1:30] = x[0] + 0.05 * rng.standard_normal((29, 64))
    block = ann.Block(np.arange(4000), x)
    (places, scores), = block.search(np.array([0]), x[:1])
    want = np.argsort(-(x[1:] @ x[0]) / np.linalg.norm(x[1:], axis=1))[:5] + 1
    assert set(places.tolist()) == set(want.tolist()) and block.verified < 100


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.5]), (9, [1.0, 2.0, 3.0]), (100, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, embedding array<float>, score string")
    vectors = ann.usable(table)
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    half = round(0.5**0.5, 9)
    assert got == {0: [(1, 1, half), (2, 2, half), (3, 50, 0.0)], 50: [(1, 1, half), (2, 2, half), (3, 0, 0.0)], 100: [(1, 9, round(6 / 42**0.5, 9))]}
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).collect() == []


def test_copies_tie_by_id(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(120)] + [(200 + i, [float(i), -1.0, 0.5]) for i in range(50)]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = ann.nearest(vectors, vectors.where("vec_id = 50"), rows=40).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3, 4] and len({r.score for r in got}) == 1


def test_repeated_query_rows(spark):
    """Equal query rows are one query; other vectors under the same id are queries of their own, each with all k."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(1, 40)]
    first, second = [1.0, 2.0, 0.0, 0.5], [-1.0, 0.5, 3.0, 0.0]
    odd = [(50, first), (50, first), (50, second)]
    vectors = ann.usable(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"))
    got = ann.nearest(vectors, vectors.where("vec_id = 50"), rows=15).collect()
    want = []
    for q in (first, second):
        score = {i: np.dot(v, q) / (np.linalg.norm(v) * np.linalg.norm(q)) for i, v in rows}
        want += [(50, n + 1, i) for n, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(want)

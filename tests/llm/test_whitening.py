import math
from fractions import Fraction

import numpy as np
import pytest

from devmetrics.llm import whitening
from tests.conftest import SF_CHECK

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def brute(rows):
    """Exact n, S, V (fractions) and deviations of (vec_id, vector) rows that all take part."""
    xs = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, dims = len(xs), len(xs[0])
    s = [sum(x[d] for x in xs) for d in range(dims)]
    dev = [[n * x[d] - s[d] for d in range(dims)] for x in xs]
    cov = [[Fraction(sum(r[i] * r[j] for r in dev), n**3) for j in range(dims)] for i in range(dims)]
    return n, s, np.array(cov, float), [sum(d * d for d in r) for r in dev], np.array(dev, object)


def check(got, rows):
    n, _, cov, deviations, dev = brute(rows)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1][:8]
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(rows) * len(values) and sorted(by_row) == sorted(i for i, _ in rows)
    white = np.zeros((len(rows), len(values)))
    for k, (vec_id, _) in enumerate(rows):
        for j, e in enumerate(values, 1):
            r = by_row[vec_id][j]
            assert r.n == n and r.deviation_exact == str(deviations[k])
            assert r.deviation == (deviations[k] if deviations[k] < 2**63 else None)
            assert r.explained == pytest.approx(e / np.trace(cov), rel=1e-6)
            white[k, j - 1] = r.whitened
    error = np.abs(white.T @ white / n - np.eye(len(values))).max()
    assert error < 1e-8 and got[0].identity_error < 1e-8
    # each column is a projection on a unit eigenvector, over the root of its eigenvalue
    c = (dev / n).astype(float)
    along, *_ = np.linalg.lstsq(c, white * np.sqrt(values), rcond=None)
    assert np.allclose(np.linalg.norm(along, axis=0), 1) and np.allclose(cov @ along, along * values, atol=1e-7 * values[0])


def test_cross_products_are_exact():
    rng = np.random.default_rng(1)
    for top, n, dims in ((1, 1, 1), (2, 63, 3), (5000, 64, 4), (5000, 65, 4), (2**20, 1000, 5), (2**45, 200, 3)):
        x = rng.integers(0, top, (n, dims))
        want = x.astype(object).T @ x.astype(object)
        assert (whitening.cross_products(x) == want).all()


def test_scatter_of_blocks_is_exact():
    rng = np.random.default_rng(2)
    own, x = whitening.Scatter(4), np.concatenate([rng.integers(-500, 900, (300, 4)), rng.integers(-2**50, 2**50, (40, 4)), [[2**62, -2**62, 5, 1]]])
    for part in np.array_split(x, 7):
        own.add(part)
    exact = x.astype(object)
    assert own.n == len(x) and (own.sums == exact.sum(axis=0)).all() and (own.products == exact.T @ exact).all()


def test_table(spark):
    vectors = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = whitening.whitened(vectors).collect()
    check(got, rows)
    one, other = (whitening.fit(*whitening.usable(v)) for v in (vectors, vectors.repartition(5)))
    assert (one.covariance == other.covariance).all() and (one.components == other.components).all() and one.sums == other.sums


def test_large_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=3) * [1e9, 5e8, 1e8] + [7e9, -3e8, 0]).tolist()) for i in range(50)]
    check(whitening.whitened(frame(spark, [(*r, 0) for r in rows])).collect(), rows)
    rows = [(i, [2.0**51 + 3 * 2.0**40 * rng.normal(), -(2.0**51) * rng.random()]) for i in range(50)]
    check(whitening.whitened(frame(spark, [(*r, 0) for r in rows])).collect(), rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [NAN, 0.0, 0.0, 0.0]), (104, [INF, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]),
           (106, [-INF, 0.0, 0.0, 0.0]), (107, [2.0**52, 0.0, 0.0, 0.0]), (108, [1.0, 2.0, 3.0, 4.0, 5.0]), (None, None)]
    table = frame(spark, [(*r, None) for r in good + odd]).withColumnsRenamed({"label": "w"})
    check(whitening.whitened(table).collect(), good)


def test_null_and_repeated_ids(spark):
    rng = np.random.default_rng(6)
    vectors = [rng.normal(size=3).tolist() for _ in range(20)]
    ids = [None, 1, 1, *range(2, 19)]
    got = whitening.whitened(frame(spark, [(i, v, 0) for i, v in zip(ids, vectors)])).collect()
    want = whitening.whitened(frame(spark, [(i, v, 0) for i, v in enumerate(vectors)])).collect()
    assert sorted((r.component, r.whitened, r.deviation) for r in got) == sorted((r.component, r.whitened, r.deviation) for r in want)
    assert sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 1 for r in got) == 6


def test_without_variance_and_empty(spark):
    same = whitening.whitened(frame(spark, [(i, [0.5, 0.25], 0) for i in range(3)])).collect()
    assert len(same) == 6 and all(r.whitened == 0 and r.deviation == 0 and r.identity_error == 0 and r.explained == 0 for r in same)
    line = whitening.whitened(frame(spark, [(i, [float(i), 2.0 * i], 0) for i in range(5)])).collect()
    assert {r.component: r.whitened == 0 for r in line if r.vec_id == 0} == {1: False, 2: True} and line[0].identity_error < 1e-9
    for rows in ([], [(1, None, 0)], [(1, [], 0)]):
        out = whitening.whitened(frame(spark, rows))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]

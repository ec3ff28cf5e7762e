"""Embedding whitening by principal components, from exact integer cross-products.

An entry c becomes the integer x = floor(1024 * c) + 100000. The scatter is bit-sliced: in a block of rows each dimension
is shifted by its least x there, so that only as many bits are left as its spread needs; every bit of the shifted
numbers is a plane, and a plane of 64 rows is one machine word. The cross-product of two dimensions is then the sum
over pairs of their planes of 2^(a + b) times the number of rows that have both bits (AND, popcount). These are whole
numbers, and so are their sums over all blocks: no result depends on how rows were dealt out. The covariance is
centred as an integer, n * C - S S', and becomes a double only for ``eigh``.

Tasks send one row per pair of dimensions, whatever the number of rows; the driver gets one matrix of the number of
dimensions squared.

Defined cases: a null vector, one with null or non-finite entries, or one with an entry whose size is 2^52 or more
(x isn't a long then) takes no part; vectors of another length than the commonest (the longer one if tied) lack an
entry, or have one that no others have, and take no part either; an empty vector has no entry to whiten; null and
repeated vec_ids are rows like any others; a component with no variance (up to rounding) whitens to 0 and isn't in
identity_error, which is 0 if there is no other; equal eigenvalues: the order that ``eigh`` gives; empty table: empty
result; ``deviation`` is null where it is beyond a long (``deviation_exact``, its digits as text, never is); other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.session import materialize

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries in a block of planes.
BLOCK = 1 << 19
#: Entries of this size or more don't give a long.
TOO_LARGE = 2.0**52
#: A variance at most this part of the trace is rounding.
NO_VARIANCE = 1e-13
#: Sums are sent in two parts, so that each fits a decimal of 38 digits whatever the number of rows.
_LIMB = 62


@dataclass
class Model:
    """n, the sums per dimension, the covariance of x, its eigenvalues in falling order and the components as rows."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    def varies(self) -> np.ndarray:
        return self.values > max(self.trace, 0.0) * NO_VARIANCE


def fits(vector: str = "embedding") -> Column:
    """Whether every entry gives an integer."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= TOO_LARGE)
    return F.coalesce((F.size(vector) > 0) & ~F.exists(F.col(vector).cast("array<double>"), bad), F.lit(False))


def usable(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the rows that take part, and their number of dimensions (0: there are none)."""
    rows = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("embedding")).where(fits())
    sizes = rows.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("n"))
    common = sizes.agg(F.max_by("dims", F.struct("n", "dims"))).first()[0]
    return (rows, 0) if common is None else (rows.where(F.size("embedding") == common), common)


def integers(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """x of a batch's last column, row by row."""
    flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.floor(flat * SCALE).astype(np.int64) + OFFSET


def planes(shifted: np.ndarray) -> tuple[np.ndarray, int]:
    """The bit planes of the columns of ``shifted`` (rows by dimensions, not negative), as words: one row for each
    dimension and bit, and the number of bits."""
    bits = max(1, int(shifted.max(initial=0)).bit_length())
    columns = np.ascontiguousarray(shifted.T).astype(np.uint64)
    one = (columns[:, None, :] >> np.arange(bits, dtype=np.uint64)[None, :, None]) & np.uint64(1)
    packed = np.packbits(one.astype(np.uint8).reshape(-1, shifted.shape[0]), axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return packed.view(np.uint64), bits


def cross_products(shifted: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of the products of every two dimensions (Python integers)."""
    words, bits = planes(shifted)
    counts = np.zeros((len(words), len(words)), np.int64)
    for p in range(len(words)):
        counts[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
    counts += np.triu(counts, 1).T
    dims = shifted.shape[1]
    counts = counts.reshape(dims, bits, dims, bits)
    if 2 * bits + len(shifted).bit_length() < 62:
        powers = 1 << np.arange(bits, dtype=np.int64)
        return np.einsum("iajb,a,b->ij", counts, powers, powers).astype(object)
    powers = np.array([1 << b for b in range(bits)], object)
    return ((counts.astype(object) * powers[None, None, None, :]).sum(axis=3) * powers[None, :, None]).sum(axis=1)


class Scatter:
    """n, sums and cross-products of x, block by block, as Python integers."""

    def __init__(self, dims: int):
        self.n, self.sums, self.products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)

    def add(self, x: np.ndarray) -> None:
        n = len(x)
        least = x.min(axis=0)
        if max(abs(int(least.min())), abs(int(x.max()))) >= 1 << 61:  # the difference of two longs might not be one
            least = np.zeros_like(least)
            exact = x.astype(object)
            self.products += exact.T @ exact
            self.sums += exact.sum(axis=0)
        else:
            shifted = x - least
            part = self._column_sums(shifted)
            shift = least.astype(object)
            self.products += cross_products(shifted) + np.outer(shift, part) + np.outer(part, shift) + n * np.outer(shift, shift)
            self.sums += part + n * shift
        self.n += n

    @staticmethod
    def _column_sums(shifted: np.ndarray) -> np.ndarray:
        low = (shifted & 0xFFFFFFFF).sum(axis=0).astype(object)
        return low + ((shifted >> 32).sum(axis=0).astype(object) << 32)


def _limbs(values: list[int]) -> tuple[list[Decimal], list[Decimal]]:
    return [Decimal(v >> _LIMB) for v in values], [Decimal(v & ((1 << _LIMB) - 1)) for v in values]


def scatter(rows: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, cross-products) of all rows, exact. Row ``dims`` of what tasks send holds the sums and n."""
    wide, step = pa.decimal128(38, 0), max(64, BLOCK // dims)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scatter(dims)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                own.add(integers(batch.slice(at, step), dims))
        if own.n:
            cells = [(i, j, int(own.products[i, j])) for i in range(dims) for j in range(i, dims)]
            cells += [(dims, j, int(own.sums[j])) for j in range(dims)] + [(dims, dims, own.n)]
            high, low = _limbs([c[2] for c in cells])
            yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
                                              pa.array(high, wide), pa.array(low, wide)], names=["i", "j", "high", "low"])

    sent = rows.select("embedding").mapInArrow(count, "i int, j int, high decimal(38,0), low decimal(38,0)")
    total = sent.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    products = [[0] * (dims + 1) for _ in range(dims + 1)]
    for r in total.toLocalIterator():
        products[r.i][r.j] = products[r.j][r.i] = (int(r.high) << _LIMB) + int(r.low)
    return products[dims][dims], products[dims][:dims], [row[:dims] for row in products[:dims]]


def fit(rows: DataFrame, dims: int, most: int = COMPONENTS) -> Model:
    n, sums, products = scatter(rows, dims)
    square = n * n
    covariance = np.array([[(n * products[i][j] - sums[i] * sums[j]) / square for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    return Model(n, sums, covariance, values[order], np.ascontiguousarray(vectors[:, order].T))


def centred(x: np.ndarray, model: Model) -> np.ndarray:
    """n * x - S, exact: longs where these fit, Python integers elsewhere."""
    most = int(np.abs(x).max(initial=0))
    if model.n * most < 1 << 62 and max(map(abs, model.sums), default=0) < 1 << 62:
        return model.n * x - np.array(model.sums, np.int64)
    return model.n * x.astype(object) - np.array(model.sums, object)


def deviations(c: np.ndarray) -> list[int]:
    """Sum of the squares of each row."""
    most = int(np.abs(c).max(initial=0))
    if c.dtype != object and most * most * c.shape[1] < 1 << 63:
        return (c * c).sum(axis=1).tolist()
    exact = c.astype(object)
    return (exact * exact).sum(axis=1).tolist()


def project(rows: DataFrame, dims: int, model: Model) -> DataFrame:
    """vec_id, deviation_exact and an array of the whitened components of every row."""
    scale = np.where(model.varies(), np.sqrt(np.maximum(model.values, 0.0)), np.inf)
    directions, step = model.components.T / scale, max(64, BLOCK // dims)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                c = centred(integers(part, dims), model)
                white = (c / model.n).astype(np.float64) @ directions
                offsets = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([str(d) for d in deviations(c)]),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))], names=["vec_id", "deviation_exact", "w"])

    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(work, "vec_id long, deviation_exact string, w array<double>")


def identity_error(found: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of what ``project`` gave (centred by the aggregate), less the identity."""
    live = np.flatnonzero(model.varies()).tolist()
    pairs = [(i, j) for i in live for j in live if i <= j]
    if not pairs:
        return 0.0
    got = found.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact: one row per vector and
    component."""
    rows, dims = usable(vectors, vector)
    if dims == 0:
        kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string"
        return vectors.sparkSession.createDataFrame([], kinds)
    model = fit(rows, dims, most)
    found = materialize(project(rows, dims, model), "whitened")
    explained = [float(v) / model.trace if model.trace > 0 else 0.0 for v in model.values]
    per = F.posexplode("w").alias("at", "whitened")
    return found.select("vec_id", "deviation_exact", per).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation_exact AS BIGINT)").alias("deviation"), "whitened",
        F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1).alias("explained"),
        F.lit(identity_error(found, model)).alias("identity_error"), "deviation_exact")

"""Nearest neighbours by collision-counting hashing (cosine).

Vectors are scaled to length 1 and projected on ``PROJECTIONS`` random lines; each line is an array of the vectors
sorted by their projection. A query opens a window around its own projection on every line. Windows of a larger
radius contain those of a smaller one (virtual rehashing: nothing is hashed anew), so widening them only brings in
the vectors at their ends, whose collisions are counted. A vector that collides on at least ``threshold`` lines is
verified: its cosine is worked out on the original vectors. A query ends when its k-th nearest verified vector is
within the radius; a last radius without bound covers everything, so fewer than k results mean there are no more.

Rows go to blocks by a hash of vec_id, queries too, and every pair of blocks is a task: each holds at most about
``ROWS`` rows and ``QUERIES`` queries, whatever the input, and returns k rows per query, of which the best k are
kept by rank. Every row is in the index.

Defined cases: null, empty or zero vectors, null or non-finite components, and null vec_ids take no part; vectors of
other lengths than the query's are no candidates; rows that share the query's vec_id are its own; other repeated
vec_ids are rows like any others; query rows of one vec_id and vector are one query, answered once, and those of one
vec_id with other vectors are queries of their own; equal scores: smaller vec_id first; empty table: empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
PROJECTIONS = 160
ROWS = 16384
QUERIES = 1024
#: Half width of a window, in radii: a vector at the radius collides on a line with a probability of 0.383.
WIDTH = 0.5
COLLIDES = 0.3829
#: The threshold lies so many standard deviations below the collisions expected at the radius.
SAFETY = 1.1
#: Radii on the unit sphere (2 is the opposite point).
RADII = (0.1, 0.2, 0.4, 0.6, 0.8, 0.9, 0.95, 1.0, 1.05, 1.1, 1.15, 1.2, 1.25, 1.3, 1.4, 1.6, 2.0)


class Block:
    """The sorted arrays of some rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = 5):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.lines = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], projections))
        along = (vectors / self.norms[:, None]) @ self.lines
        self.order = [np.argsort(along[:, j], kind="stable") for j in range(projections)]
        self.sorted = [along[o, j] for j, o in enumerate(self.order)]
        self.threshold = int(projections * COLLIDES - SAFETY * np.sqrt(projections * COLLIDES * (1 - COLLIDES)))
        self.radii = [*RADII, np.inf]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int = K) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, cosines) of each query's k nearest, nearest first; the number verified is in ``self.verified``."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        along = (queries / norms[:, None]) @ self.lines
        half = np.array(self.radii) * WIDTH
        low = np.stack([np.searchsorted(s, along[:, j, None] - half, "left") for j, s in enumerate(self.sorted)])
        high = np.stack([np.searchsorted(s, along[:, j, None] + half, "right") for j, s in enumerate(self.sorted)])
        self.verified = 0
        for q in range(len(queries)):
            counts = np.zeros(len(self.ids), np.int64)
            open_ = self.ids != query_ids[q]
            places, scores = np.zeros(0, np.int64), np.zeros(0)
            lows, highs = low[:, q].tolist(), high[:, q].tolist()
            for level, radius in enumerate(self.radii):
                if level:
                    new = [o[a[level]:a[level - 1]] for o, a in zip(self.order, lows)] + [o[b[level - 1]:b[level]] for o, b in zip(self.order, highs)]
                else:
                    new = [o[a[0]:b[0]] for o, a, b in zip(self.order, lows, highs)]
                counts += np.bincount(np.concatenate(new), minlength=len(counts))
                found = np.flatnonzero(open_ & (counts >= self.threshold))
                if len(found):
                    open_[found] = False
                    self.verified += len(found)
                    cosines = (self.vectors[found] * queries[q]).sum(axis=1) / (self.norms[found] * norms[q])
                    places, scores = np.append(places, found), np.append(scores, cosines)
                    best = np.lexsort((self.ids[places], -scores))[:k]
                    places, scores = places[best], scores[best]
                if len(places) >= k and 2 - 2 * scores[-1] <= radius * radius:
                    break
            yield places, scores


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, rows: int = ROWS, per_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query. Both inputs: (vec_id, v), see ``usable``."""
    queries = queries.dropDuplicates(["vec_id", "v"])
    size = F.size("v").alias("dim")
    n_rows, n_queries = (max(1, -(-t.count() // n)) for t, n in ((vectors, rows), (queries, per_block)))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select(size, block(n_rows).alias("rb"), every(n_queries).alias("qb"), "vec_id", "v")
    right = queries.select(size, every(n_rows).alias("rb"), block(n_queries).alias("qb"), "vec_id", "v",
                           F.xxhash64("v").alias("which"))  # tells queries of one vec_id apart
    schema = pa.schema([("query_id", pa.int64()), ("which", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def plain(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t.column("vec_id").to_numpy()
        return ids, t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)

    def search(here: pa.Table, asked: pa.Table) -> pa.Table:
        if not here.num_rows or not asked.num_rows:
            return schema.empty_table()
        found = Block(*plain(here))
        query_ids, qs = plain(asked)
        which = asked.column("which").to_numpy()
        out = [(np.full(len(p), query_ids[i]), np.full(len(p), which[i]), found.ids[p], s) for i, (p, s) in enumerate(found.search(query_ids, qs, k))]
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    keys = ["dim", "rb", "qb"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, which long, vec_id long, score double")
    best = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""SimHash near-duplicates with pivot distance tables.

Equal fingerprints are one class from the start. Two classes link where their fingerprints differ in at most
``max_bits`` bits; a document's component is everything reachable over links. For every fingerprint the Hamming
distances to many reference fingerprints (pivots) are tabled. By the triangle inequality a pair with coordinates
more than ``max_bits`` apart for any pivot can't link: such pairs are discarded and the survivors verified.

The table rules pairs out but doesn't say which to look at, so pairs are looked for among fingerprints that agree
in whole blocks of bits: of ``blocks`` blocks, ``max_bits`` bits touch at most ``max_bits``, the others are equal.
Inside such a bucket, rows are in the order of their first coordinate and a row meets only those at most
``max_bits`` away. Links of a bucket are found by a search over its unvisited members, so that it returns a
spanning forest and never all pairs. A bucket of more than ``chunk`` members is split by cells of the first
coordinate (only neighbouring cells can link) and by a hash, and pairs of parts go to tasks of their own.

Defined cases: null, empty or blank text: fingerprint 0, linked like any other; fewer words than a shingle: the
whole sequence is the shingle; repeated rows: same class; null doc_id: a row like any other, never a component's
id unless all its ids are null (then null); empty table: empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.components import components
from devmetrics.llm.common import free_names, quoted
from devmetrics.session import materialize

SHINGLE = 3
MAX_BITS = 3
BLOCKS = 6
PIVOTS = 24
CHUNK = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """The 64-bit SimHash of a text, unsigned. bytes.lower() and bytes.split() know ASCII only, as wanted."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(n)))]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at:at + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.fromiter((fingerprint(t, shingle) for t in batch), np.uint64, len(batch))
            yield pd.Series(found.view(np.int64))

    return prints(text)


def pivots(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, n, dtype=np.uint64)


def forest(prints: np.ndarray, max_bits: int = MAX_BITS, table: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that span the components of some distinct fingerprints."""
    table = np.bitwise_count(prints[:, None] ^ pivots()[None, :]).astype(np.int8) if table is None else table
    order = np.argsort(table[:, 0], kind="stable")
    first, table, prints = table[order, 0], table[order], prints[order]
    low = np.searchsorted(first, first - max_bits, "left")
    high = np.searchsorted(first, first + max_bits, "right")
    fresh, links = np.ones(len(prints), bool), []
    for start in range(len(prints)):
        if not fresh[start]:
            continue
        fresh[start] = False
        stack = [start]
        while stack:
            i = stack.pop()
            near = low[i] + np.flatnonzero(fresh[low[i]:high[i]])
            near = near[np.abs(table[near] - table[i]).max(axis=1, initial=0) <= max_bits]
            near = near[np.bitwise_count(prints[near] ^ prints[i]) <= max_bits]
            fresh[near] = False
            stack.extend(near.tolist())
            links.extend((int(order[i]), int(order[j])) for j in near)
    return links


def _links_of_units(max_bits: int):
    """mapInArrow function over rows sorted by unit: links inside each unit, a unit at a time."""
    unit_columns = ("m", "k", "c", "up", "h1", "h2")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(unit: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        """unit: the row at which each row's unit starts."""
        starts = np.unique(unit)
        sizes = np.diff(np.append(starts, len(unit)))
        table = np.bitwise_count(prints[:, None] ^ pivots()[None, :]).astype(np.int8)
        two = starts[sizes == 2]
        two = two[np.abs(table[two] - table[two + 1]).max(axis=1, initial=0) <= max_bits]
        two = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= max_bits]
        u, v = [prints[two]], [prints[two + 1]]
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            own = prints[at:at + n]
            pairs = np.array(forest(own, max_bits, table[at:at + n]), np.int64).reshape(-1, 2)
            u.append(own[pairs[:, 0]])
            v.append(own[pairs[:, 1]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64) for _ in range(len(unit_columns) + 1)]
        for batch in batches:
            held = [np.concatenate([a, batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)])
                    for a, n in zip(held, (*unit_columns, "fp"))]
            n = len(held[0])
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = np.any([a[1:] != a[:-1] for a in held[:-1]], axis=0)
            unit = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            end = int(unit[-1])  # the last unit may go on in the next batch
            if end:
                yield links(unit[:end], held[-1][:end].view(np.uint64))
            held = [a[end:] for a in held]
        if len(held[0]):
            yield links(np.zeros(len(held[0]), np.int64), held[-1].view(np.uint64))

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) that span the components of distinct fingerprints (column fp, a signed long)."""
    if not max_bits < blocks <= 64:
        raise ValueError("blocks must be more than max_bits and at most 64")
    edges = np.linspace(0, 64, blocks + 1).round().astype(int)
    masks = [sum(((1 << int(b)) - (1 << int(a))) for a, b in kept)
             for kept in combinations(list(zip(edges[:-1], edges[1:])), blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*(F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed)))
    buckets = prints.select("fp", F.inline(keys))
    sizes = buckets.groupBy("m", "k").agg(F.count("*").alias("n")).where("n > 1")
    rows = buckets.join(sizes, ["m", "k"])
    zero = F.lit(0).cast("long")
    small = rows.where(F.col("n") <= chunk).select("m", "k", zero.alias("c"), zero.alias("up"), zero.alias("h1"), zero.alias("h2"), "fp")
    first = int(pivots()[0])
    cell = F.floor(F.bit_count(F.col("fp").bitwiseXOR(F.lit(first - (1 << 64) if first >> 63 else first))) / (max_bits + 1)).cast("long")
    parts = F.ceil(F.col("n") / chunk).cast("long")
    large = rows.where(F.col("n") > chunk).select("m", "k", "fp", cell.alias("c"), parts.alias("p"), F.pmod(F.xxhash64("fp"), parts).alias("h"))
    unit = lambda c, up, a, b: F.struct(c.alias("c"), F.lit(up).cast("long").alias("up"), a.alias("h1"), b.alias("h2"))
    others = F.sequence(zero, F.col("p") - 1)
    c, h = F.col("c"), F.col("h")
    units = F.concat(F.transform(others, lambda x: unit(c, 0, F.least(h, x), F.greatest(h, x))),
                     F.transform(others, lambda x: unit(c, 1, h, x)), F.transform(others, lambda x: unit(c - 1, 1, x, h)))
    large = large.select("m", "k", "fp", F.inline(units)).select("m", "k", "c", "up", "h1", "h2", "fp")
    by = ["m", "k", "c", "up", "h1", "h2"]
    units = small.union(large).repartition(*by).sortWithinPartitions(*by)
    return units.mapInArrow(_links_of_units(max_bits), "u long, v long")


def classes(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """(fp, root, component_id) for rows (doc_id, fp): root is the component's least fingerprint."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = materialize(components(links(distinct, max_bits, blocks, chunk)), "simhash-roots")
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of (doc_id, text)."""
    prints = materialize(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash")
    return (prints.join(classes(prints, max_bits, blocks), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``docs``, one of each component: that with the least doc_id (null ids last).

    Rows get a number in a written copy, so that repeated rows and repeated or null ids are told apart."""
    fp, row = free_names(docs, "fp", "row")
    rows = materialize(docs.select("*", fingerprint_column(F.col("text"), shingle).alias(fp),
                                   F.monotonically_increasing_id().alias(row)), "simhash-rows")
    prints = rows.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("__row"))
    rooted = prints.join(classes(prints, max_bits, blocks), "fp")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    kept = rooted.groupBy("root").agg(F.min(place).alias("__p")).select(F.col("__p.__row").alias(row))
    return rows.join(kept, row, "left_semi").select(*map(quoted, docs.columns))

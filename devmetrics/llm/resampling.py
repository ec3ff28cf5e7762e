"""Target-distribution importance resampling over hashed n-grams.

Features are runs of one and two consecutive words, joined by one space. A feature's bucket is the CRC-32 of its UTF-8
bytes modulo ``BUCKETS``. The counts per bucket of all documents and of all target texts give each bucket a gain (a
scaled log ratio); a document's weight is the mean gain of its features, and adding seeded Gumbel noise to the weights
and taking the highest scores draws documents without replacement with chances in proportion to exp(weight).

CRC-32 is affine: the code of n bytes is a constant for n, xor one contribution of every byte that depends only on the
byte and on its distance from the end. The contributions are a table (distance by byte value), so the codes of all
features of a batch are one lookup over their bytes and ``bitwise_xor.reduceat`` over their spans. A span longer than
the table is cut into blocks counted from its end; block codes are folded in pairs, with the shift by one block, two
blocks, four blocks and so on as tables of their own.

Defined cases: null, empty or wordless text: no features, weight 0, under the least number of words, not drawn; null
doc_id: its noise is that of the id written as an empty text, last among ties; repeated rows are documents of their
own, with scores that tie where id and text are equal, and get successive ranks; no target text: every feature's gain
comes from the corpus alone; empty table: empty result; very long texts (and words) are worked on in pieces of a
bounded number of bytes; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.common import numbered
from devmetrics.llm.wordhash import LOWER
from devmetrics.session import materialize

BUCKETS = 10_000
LONGEST = 2  # words in a feature
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
#: Distances in the table; a power of two.
DEPTH = 64
#: About so many bytes of text are worked on at once.
BATCH = 1 << 18

#: Bytes of words: ASCII digits and letters, and all bytes of other characters.
IN_WORD = np.array([b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])


class Crc:
    """CRC-32 of many spans of one buffer."""

    def __init__(self, depth: int = DEPTH):
        state = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            state = np.where(state & 1, (state >> 1) ^ np.uint32(POLYNOMIAL), state >> 1)
        self.depth, table = depth, [state]
        for _ in range(depth - 1):  # one zero byte more behind it
            table.append((table[-1] >> np.uint32(8)) ^ state[table[-1] & 0xFF])
        #: contribution of a byte value at a distance from the end, flat: [256 * distance + byte]
        self.table = np.concatenate(table)
        one = 1 << np.arange(32, dtype=np.uint32)
        self.shifts = [(one >> np.uint32(8)) ^ state[one & 0xFF]]  # images of the 32 bits under 2^k zero bytes
        self.tables: list[np.ndarray] = []
        self.constants = self._constant(np.arange(depth + 1))

    def _shifted(self, codes: np.ndarray, k: int) -> np.ndarray:
        """Codes after 2^k more zero bytes."""
        while len(self.tables) <= k:
            image = self.shifts[len(self.tables)]
            value = np.arange(256, dtype=np.uint32)
            rows = []
            for byte in range(4):
                bits = (value[:, None] >> np.arange(8, dtype=np.uint32)) & 1
                rows.append(np.bitwise_xor.reduce(bits * image[8 * byte:8 * byte + 8], axis=1))
            self.tables.append(np.stack(rows).astype(np.uint32))
            self.shifts.append(self._through(self.tables[-1], image))
        return self._through(self.tables[k], codes)

    @staticmethod
    def _through(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return table[0][codes & 0xFF] ^ table[1][(codes >> 8) & 0xFF] ^ table[2][(codes >> 16) & 0xFF] ^ table[3][codes >> 24]

    def _constant(self, lengths: np.ndarray) -> np.ndarray:
        """The code of so many zero bytes."""
        codes = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
        for k in range(int(lengths.max(initial=0)).bit_length()):
            on = (lengths >> k) & 1 == 1
            codes[on] = self._shifted(codes[on], k)
        return codes ^ np.uint32(0xFFFFFFFF)

    def _summed(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Xor of the contributions over spans of 1 to ``depth`` bytes."""
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - first, lengths)
        far = np.repeat(ends - 1, lengths) - at
        return np.bitwise_xor.reduceat(self.table[far * 256 + buf[at]], first)

    def spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The code of each ``buf[start:end]`` (none empty)."""
        codes, lengths = np.zeros(len(starts), np.uint32), ends - starts
        short = lengths <= self.depth
        if short.any():
            codes[short] = self._summed(buf, starts[short], ends[short]) ^ self.constants[lengths[short]]
        for i in np.flatnonzero(~short).tolist():
            codes[i] = self._long(buf, int(starts[i]), int(ends[i])) ^ self._constant(lengths[i:i + 1])[0]
        return codes

    def _long(self, buf: np.ndarray, start: int, end: int) -> np.uint32:
        """Xor of the contributions over one span of any length: blocks from the end, then pairs of blocks."""
        cuts = np.arange(end, start, -self.depth)[::-1]
        blocks = np.concatenate([self._summed(buf, np.maximum(c - self.depth, start), c) for c in np.array_split(cuts, -(-len(cuts) * self.depth // BATCH))])
        k = self.depth.bit_length() - 1
        while len(blocks) > 1:
            if len(blocks) % 2:  # a block of zero bytes in front contributes nothing
                blocks = np.append(np.uint32(0), blocks)
            blocks = self._shifted(blocks[::2], k) ^ blocks[1::2]
            k += 1
        return blocks[0]


_CRC: list[Crc] = []


def crc() -> Crc:
    if not _CRC:
        _CRC.append(Crc())
    return _CRC[0]


def features(texts: list[str | None], buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts in turn (a long one in pieces): (numbers of the texts, words in each, (text, bucket) of every
    feature as one array of two rows). A feature that spans two pieces of a text comes with the second."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if len(data) > BATCH:
            if held:
                yield _of_pieces(held, buckets, longest)
                held, size = [], 0
            yield from _of_long(i, data, buckets, longest)
            continue
        held.append((i, data))
        size += len(data)
        if size >= BATCH:
            yield _of_pieces(held, buckets, longest)
            held, size = [], 0
    if held:
        yield _of_pieces(held, buckets, longest)


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, and the places of words in them."""
    buf = LOWER[raw]
    flags = np.concatenate([[False], IN_WORD[buf], [False]])
    edges = np.flatnonzero(flags[1:] != flags[:-1])
    return buf, edges[::2], edges[1::2]


def _of_pieces(held: list[tuple[int, bytes]], buckets: int, longest: int, before: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``before``: the first so many words of a piece were counted with the piece before it."""
    raw = np.frombuffer(b"\n".join(d for _, d in held) + b"\n", np.uint8)
    buf, starts, ends = _words(raw)
    lengths = ends - starts
    # the words alone, one space behind each
    to = np.cumsum(lengths + 1) - lengths - 1
    at = np.arange(int(lengths.sum()), dtype=np.int64)
    inner = np.cumsum(lengths) - lengths
    row = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    row[at + np.repeat(to - inner, lengths)] = buf[at + np.repeat(starts - inner, lengths)]
    sizes = np.array([len(d) + 1 for _, d in held], np.int64)
    which = np.searchsorted(np.cumsum(sizes), starts, "right")
    numbers = np.array([i for i, _ in held], np.int64)
    found = []
    for n in range(1, longest + 1):
        last = np.arange(max(before, n - 1), len(starts))
        last = last[which[last] == which[last - n + 1]]
        if len(last):
            codes = crc().spans(row, to[last - n + 1], to[last] + lengths[last])
            found.append(np.stack([numbers[which[last]], (codes % np.uint32(buckets)).astype(np.int64)]))
    counted = np.bincount(which, minlength=len(held))
    counted[0] -= before
    return numbers, counted, np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _of_long(i: int, data: bytes, buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces that end at a word's end; each starts with the last words of the one before it."""
    whole = np.frombuffer(data, np.uint8)
    at, carry = 0, []
    while at < len(data):
        end = min(len(data), at + BATCH)
        while end < len(data):  # on to the next byte outside a word
            gap = np.flatnonzero(~IN_WORD[LOWER[whole[end:end + BATCH]]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + BATCH)
        piece = b" ".join([*carry, data[at:end]])
        yield _of_pieces([(i, piece)], buckets, longest, len(carry))
        buf, starts, ends = _words(np.frombuffer(piece, np.uint8))
        carry = [buf[s:e].tobytes() for s, e in zip(starts[len(starts) - longest + 1:].tolist(), ends[len(ends) - longest + 1:].tolist())] if longest > 1 and len(starts) else []
        at = end


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) over all rows of a column ``text``: each task sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for _, _, found in features(batch.column(0).slice(at, 1000).to_pylist(), buckets, longest):
                    total += np.bincount(found[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some.astype(np.int32), "n": total[some]})

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """The gain of every bucket (``buckets`` numbers, whatever the input)."""
    own = {}
    for name, texts in (("docs", docs), ("target", target)):
        own[name] = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, buckets, longest).toLocalIterator():
            own[name][r.bucket] = r.n
    s, t = own["docs"].tolist(), own["target"].tolist()
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, words, count, total = part.num_rows, *np.zeros((3, part.num_rows), np.int64)
                for numbers, own, found in features(part.column(1).to_pylist(), buckets, longest):
                    np.add.at(words, numbers, own)
                    count += np.bincount(found[0], minlength=n)
                    np.add.at(total, found[0], gain[found[1]])
                weight = np.where(count > 0, total // np.maximum(count, 1), 0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(count), pa.array(weight)],
                                                 names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int = SEED) -> F.Column:
    """Gumbel noise in thousandths, from the doc_id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 2.0**32))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (null: not drawn) of every document.

    The features are worked out twice, for the counts and for the weights, instead of being kept. What is ranked is one
    row per document of a few numbers; rows that are equal in all of them are one row with a count until they have
    their ranks."""
    found = weighted(docs, gains(docs, target))
    scored = materialize(found.withColumn("score", F.col("weight") + noise(seed)), "importance")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    groups = scored.where(enough).groupBy(*scored.columns).agg(F.count("*").alias("__rows"))
    ranked = numbered(groups, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("n_words").asc()], F.col("__rows"), "importance-ranks")
    ranked = ranked.withColumn("rank", F.explode(F.sequence(F.col("__before") + 1, F.col("__before") + F.col("__rows"))))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.select(*scored.columns, "rank").unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))

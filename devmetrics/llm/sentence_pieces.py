"""Sampled segmentations into pieces of a public SentencePiece vocabulary, and their decoding.

For each word the lattice of all its segmentations is filtered forward (the log-sum of all ways to reach each place)
and then sampled backward from its end, edge by edge in proportion. A piece weighs ``-theta * log(1 + rank)`` with
its rank in the vocabulary; a character that is no piece becomes its bytes. No piece reaches over the beginning of
a word or a line feed, so words are independent: a distinct word's forward pass is done once (and remembered
within bounds), sampling is done for every occurrence. Random numbers come from the row's key and the place in its
text, so that a row gets the same segmentation in any batch, task or run.

Words over ``LONG`` characters (scripts without blanks, minified code, base64) aren't remembered. They are filtered in
windows of ``WINDOW`` places that carry the last forward values on; as the random number of a place is known
beforehand, a window settles at once which piece would end at each of its places, and only that is kept: the backward
pass follows these from the word's end. Time is in proportion to the length.

Blanks become U+2581 as in the vocabulary; a U+2581 of the text itself is written as bytes, so decoding gives back
every text exactly.

Defined cases: null text: null ids and null decoding; empty text: no ids; null key: a fixed key; rows that repeat key
and text get the same ids; very long texts: worked on in pieces, none is cut short (a stretch
without any blank or line feed is held as a whole, at about 60 bytes a character); empty table: empty result;
other columns pass through ``encode_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from devmetrics.llm.wordhash import Memo, mix, pieces, prefix_sums, span_hashes

THETA = 1.0
SEED = 8
#: Characters worked on at once, and rows: they bound what a task holds beside its memory of words.
PIECE = 1 << 18
ROWS = 250
#: Characters from which on a word is long, and places of such a word that are filtered at once.
LONG = 256
WINDOW = 1 << 14
BLANK = 0x2581
_LITERAL = 0x110000 + BLANK  # a U+2581 of the text: no piece has this code
_BYTES = 1 << 24  # codes from here on: a character to be written as bytes


class Pieces:
    """A vocabulary: hashes, weights and bytes of its pieces."""

    def __init__(self, path: str, theta: float = THETA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        names = [model.id_to_piece(i) for i in ids]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a piece reaches over the beginning of a word")
        self.longest = max(map(len, names))
        if self.longest > 255:
            raise ValueError("a piece is longer than 255 characters")
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
        codes = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(n) for n in names])
        ends = np.cumsum(lengths)
        self.find = Memo(None, 1, np.int8, bits=(4 * len(names)).bit_length())
        self.find._add(span_hashes(prefix_sums(codes), ends - lengths, ends))
        self.ids = np.array(ids, np.int32)
        rank = np.argsort(np.argsort(-np.array([model.get_score(i) for i in ids]), kind="stable"))
        self.weights = np.append(-theta * np.log(1.0 + 1 + rank), -np.inf)  # the last: no piece
        self.byte_weight = -theta * np.log(2.0 + len(ids))
        content = [b""] * model.get_piece_size()
        for i, n in zip(ids, names):
            content[i] = n.replace("▁", " ").encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            content[i] = bytes([b])
        self.blob = np.frombuffer(b"".join(content), np.uint8)
        self.sizes = np.array([len(c) for c in content])
        self.at = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of some runs of ids (offsets: their n + 1 borders)."""
        sizes = self.sizes[ids]
        total = np.append(0, np.cumsum(sizes))
        data = self.blob[np.repeat(self.at[ids] - total[:-1], sizes) + np.arange(int(total[-1]))].tobytes()
        ends = total[offsets].tolist()
        return [data[a + 1:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


class Sampler:
    """Encodes texts; keeps the lattices of distinct words while there is room."""

    def __init__(self, vocabulary: Pieces, bits: int = 18):
        self.vocabulary = vocabulary
        self.memo = Memo(self._filter, 2, np.int64, bits=bits)
        self._clear()

    def _clear(self) -> None:
        self.n_nodes = self.n_edges = 0
        self.first = np.zeros(1 << 16, np.int32)  # per node: its first edge
        self.share = np.zeros(1 << 16, np.float32)  # per edge: shares up to and with it
        self.back = np.zeros(1 << 16, np.uint8)  # per edge: its length
        self.code = np.zeros(1 << 16, np.int32)  # per edge: piece id or character for bytes

    def _room(self, nodes: int, edges: int) -> None:
        while self.n_nodes + nodes > len(self.first):
            self.first = np.append(self.first, np.zeros_like(self.first))
        while self.n_edges + edges > len(self.share):
            for name in ("share", "back", "code"):
                setattr(self, name, np.append(getattr(self, name), np.zeros_like(getattr(self, name))))

    def _filter(self, places: np.ndarray) -> np.ndarray:
        """Forward pass over some words: (last node, length) of each."""
        if self.memo.n == 0:
            self._clear()
        out = np.empty((len(places), 2), np.int64)
        for at in range(0, len(places), 4096):  # bounds what the pass holds at once
            out[at:at + 4096] = self._filter_some(places[at:at + 4096])
        return out

    def _filter_some(self, places: np.ndarray) -> np.ndarray:
        v = self.vocabulary
        starts, lengths = self.starts[places], self.ends[places] - self.starts[places]
        base = np.cumsum(lengths) - lengths  # of each word's characters, one after the other
        n = int(lengths.sum())
        place = np.repeat(starts - base, lengths) + np.arange(n)
        left = np.repeat(lengths + base, lengths) - np.arange(n)  # characters to the word's end
        wide = min(v.longest, int(lengths.max()))
        edge = np.full((n, wide), len(v.ids), np.int32)  # piece that starts here, by length - 1
        for k in range(wide):
            here = np.flatnonzero(left > k)
            found = v.find.find(span_hashes(self.sums, place[here], place[here] + k + 1))
            edge[here, k] = np.where(found < 0, len(v.ids), found)
        bytes_only = edge[:, 0] == len(v.ids)
        alpha = np.zeros(n + len(places))  # word w's nodes from base[w] + w on
        node0 = base + np.arange(len(places))
        ways = np.full((n, wide), -np.inf)  # by end character and length - 1
        for j in range(1, int(lengths.max()) + 1):
            w = np.flatnonzero(lengths >= j)
            last = base[w] + j - 1
            for k in range(min(wide, j)):
                first = last - k
                weight = v.weights[edge[first, k]]
                if k == 0:
                    weight = np.where(bytes_only[first], v.byte_weight, weight)
                ways[last, k] = alpha[node0[w] + j - 1 - k] + weight
            rows = ways[last, :min(wide, j)]
            top = rows.max(axis=1)
            alpha[node0[w] + j] = top + np.log(np.exp(rows - top[:, None]).sum(axis=1))
        owner = np.repeat(np.arange(len(places)), lengths)
        node, k = np.nonzero(ways[:, ::-1] > -np.inf)  # long pieces first: they are the likelier ones, found sooner
        length = wide - k
        begin = node - length + 1
        code = np.append(v.ids, -1)[edge[begin, length - 1]]
        code = np.where(code < 0, _BYTES + self.codes[place[begin]].astype(np.int64), code)
        share = np.exp(ways[node, length - 1] - alpha[node + owner[node] + 1])
        counts = np.bincount(node, minlength=n)
        first = np.cumsum(counts) - counts
        upto = np.cumsum(share)
        upto -= np.repeat(upto[first] - share[first], counts)
        upto[first + counts - 1] = 2
        self._room(n, len(node))
        e = slice(self.n_edges, self.n_edges + len(node))
        self.share[e], self.back[e], self.code[e] = upto, length, code
        self.first[self.n_nodes:self.n_nodes + n] = self.n_edges + first
        found = np.column_stack([self.n_nodes + base + lengths - 1, lengths])
        self.n_nodes += n
        self.n_edges += len(node)
        return found

    def _sample_long(self, start: int, end: int, row: np.uint64, shift: int, out: np.ndarray) -> None:
        """Samples the word ``[start, end)`` of the piece into ``out``."""
        v = self.vocabulary
        jump = np.empty(end - start, np.uint8)  # by place of its last character: length and code of the piece to take
        code = np.empty(end - start, np.int32)
        carry = [0.0]  # forward values of the places up to the window's first
        for a in range(start, end, WINDOW):
            ends = np.arange(a + 1, min(a + WINDOW, end) + 1)
            wide = min(v.longest, int(ends[-1]) - start)
            edge = np.full((len(ends), wide), len(v.ids), np.int32)  # piece that ends here, by length - 1
            for k in range(wide):
                here = np.flatnonzero(ends - start > k)
                found = v.find.find(span_hashes(self.sums, ends[here] - 1 - k, ends[here]))
                edge[here, k] = np.where(found < 0, len(v.ids), found)
            weight = v.weights[edge]
            weight[:, 0] = np.where(edge[:, 0] == len(v.ids), v.byte_weight, weight[:, 0])
            node, k = np.nonzero(weight[:, ::-1] > -np.inf)
            length = wide - k
            weight = weight[node, length - 1]
            begin = node - length + len(carry)  # place among the forward values
            alpha, lead = carry, len(carry)
            borders = np.searchsorted(node, np.arange(len(ends) + 1)).tolist()
            begins, weights = begin.tolist(), weight.tolist()
            for lo, hi in zip(borders[:-1], borders[1:]):
                ways = [alpha[begins[i]] + weights[i] for i in range(lo, hi)]
                top = max(ways)
                alpha.append(top + log(sum([exp(w - top) for w in ways])))
            values = np.array(alpha)
            upto = np.cumsum(np.exp(values[begin] + weight - values[node + lead]))
            first, last = np.array(borders[:-1]), np.array(borders[1:]) - 1
            upto -= np.repeat(np.append(0, upto[last[:-1]]), last + 1 - first)
            upto[last] = 2
            passed = self._draw(row, ends + shift)[node] >= upto
            taken = first + np.bincount(node[passed], minlength=len(ends))
            ids = np.append(v.ids, -1)[edge[np.arange(len(ends)), length[taken] - 1]]
            at = slice(a - start, a - start + len(ends))
            jump[at] = length[taken]
            code[at] = np.where(ids < 0, _BYTES + self.codes[ends - 1].astype(np.int64), ids)
            carry = alpha[-v.longest:]
        back, place, stops = jump.tobytes(), end - start, []
        while place:
            stops.append(place - 1)
            place -= back[place - 1]
        stops = np.array(stops)
        out[start + stops + 1 - jump[stops]] = code[stops]

    @staticmethod
    def _draw(row: np.ndarray | np.uint64, place: np.ndarray) -> np.ndarray:
        """Random numbers in [0, 1) of some rows at some places of their texts."""
        draw = mix(row ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return (draw >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)

    def encode(self, texts: list[str | None], keys: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the n + 1 borders of the texts' runs. keys: 64-bit row keys."""
        row = mix(keys.astype(np.uint64) ^ mix(np.uint64([seed])))
        flat, counts, begun = [], np.zeros(len(texts), np.int64), {}
        for part in pieces(texts, PIECE):
            lead, ahead = [], []  # ahead: a piece's place in its text, so that random numbers depend on the text alone
            for i, t in part:
                lead.append((" " if i not in begun and t else "") + t)
                ahead.append(begun.get(i, 0))
                begun[i] = ahead[-1] + len(lead[-1])
            ahead = np.array(ahead, np.int64)
            sizes = np.array([len(t) for t in lead], np.int64)
            if not sizes.sum():
                continue
            codes = np.frombuffer("".join(lead).encode("utf-32-le", "replace"), np.uint32)
            codes = np.where(codes == BLANK, _LITERAL, np.where(codes == 32, BLANK, codes)).astype(np.uint32)
            offsets = np.cumsum(sizes) - sizes
            piece = np.repeat(np.arange(len(part)), sizes)
            blank, feed = codes == BLANK, codes == 10
            begins = np.ones(len(codes), bool)
            begins[1:] = blank[1:] & ~blank[:-1] | feed[1:] | feed[:-1] | (piece[1:] != piece[:-1])
            self.codes, self.sums = codes, prefix_sums(codes)
            starts = np.flatnonzero(begins)
            ends = np.append(starts[1:], len(codes))
            short = ends - starts <= LONG
            self.starts, self.ends = starts[short], ends[short]
            at = self.memo(span_hashes(self.sums, self.starts, self.ends))
            rows = self.memo.rows[at]
            node, left, end = rows[:, 0], rows[:, 1], self.ends.copy()
            which = piece[self.starts]
            number = np.array([i for i, _ in part])
            shift, own = (ahead - offsets)[which], row[number[which]]
            out = np.full(len(codes), -1, np.int64)
            for a, b in zip(starts[~short].tolist(), ends[~short].tolist()):
                self._sample_long(a, b, row[number[piece[a]]], int((ahead - offsets)[piece[a]]), out)
            while len(node):
                u = self._draw(own, end + shift)
                edge, on = self.first[node].astype(np.int64), np.arange(len(node))
                while len(on):
                    on = on[u[on] >= self.share[edge[on]]]
                    edge[on] += 1
                length = self.back[edge].astype(np.int64)
                end = end - length
                out[end] = self.code[edge]
                left = left - length
                more = left > 0
                node, left, end, shift, own = (node - length)[more], left[more], end[more], shift[more], own[more]
            at = np.flatnonzero(out >= 0)
            ids, owner = out[at], number[piece[at]]
            odd = np.flatnonzero(ids >= _BYTES)
            if len(odd):
                chars = ids[odd] - _BYTES
                written = [chr(c if c != _LITERAL else BLANK).encode("utf-8", "replace") for c in chars.tolist()]
                times = np.ones(len(ids), np.int64)
                times[odd] = [len(w) for w in written]
                spread = np.repeat(ids, times)
                spread[np.repeat(ids >= _BYTES, times)] = self.vocabulary.byte_ids[np.frombuffer(b"".join(written), np.uint8)]
                ids, owner = spread, np.repeat(owner, times)
            counts += np.bincount(owner, minlength=len(texts))
            flat.append(ids.astype(np.int32))
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), np.append(0, np.cumsum(counts))


_SAMPLERS: dict[tuple[str, float], Sampler] = {}


def sampler(path: str, theta: float = THETA) -> Sampler:
    if (path, theta) not in _SAMPLERS:
        _SAMPLERS[path, theta] = Sampler(Pieces(path, theta))
    return _SAMPLERS[path, theta]


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", seed: int = SEED, theta: float = THETA, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (if not given: all but text and those named like the new ones) with ids, n_ids and lossless:
    whether decoding the ids gave back the text, as tried for every row."""
    keep = [c for c in docs.columns if c not in ("text", "ids", "n_ids", "lossless")] if keep is None else keep
    rows = docs.select(*keep, F.col("text").alias("__text"), F.coalesce(F.xxhash64(key), F.lit(0)).alias("__key"))
    more = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.IntegerType()), T.StructField("lossless", T.BooleanType())])
    schema = T.StructType([*docs.select(*keep).schema.fields, *more.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sampler(path, theta)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(len(keep)).to_pylist()
                ids, borders = encoder.encode(texts, part.column(len(keep) + 1).to_numpy(zero_copy_only=False).astype(np.int64), seed)
                back = encoder.vocabulary.decode(ids, borders)
                null = np.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids), mask=pa.array(null))
                sizes = pa.array(np.diff(borders).astype(np.int32), mask=null)
                same = pa.array([None if t is None else t == b for t, b in zip(texts, back)], pa.bool_())
                kept = [c.cast(f.type) for c, f in zip(part.columns[:len(keep)], arrow)]
                yield pa.RecordBatch.from_arrays([*kept, lists.cast(arrow.field("ids").type), sizes, same], schema=arrow)

    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the text that the ids stand for."""
    schema = T.StructType([*encoded.select(*keep).schema.fields, T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sampler(path).vocabulary
        for batch in batches:
            lists = batch.column(len(keep))
            sizes = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            texts = vocabulary.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(sizes)))
            texts = [t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())]
            kept = [c.cast(f.type) for c, f in zip(batch.columns[:len(keep)], arrow)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], schema=arrow)

    return encoded.select(*keep, "ids").mapInArrow(run, schema)

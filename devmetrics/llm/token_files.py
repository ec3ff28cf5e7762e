"""Token-id files: one independent zstandard frame per document, with a trailing seek table.

A file holds the documents of one range of doc_id, in ascending order (null ids last). Each frame is a document's
ids as little-endian unsigned 32-bit integers. The last data frame is the directory: the doc_ids as 64-bit integers,
then a byte for each (0: null). A seek table in a skippable frame ends the file: for each frame its size, the size
of its content and a checksum (the low 32 bits of the content's XXH64), as in the seekable format of zstandard. A
reader fetches the table and the directory, and then only the frames of the documents it was asked for.

Files are written by tasks, straight to the shared folder, under names that no other attempt uses; the manifest,
committed by Spark, names those of the attempts that count. Texts are tokenized after they were dealt out by range,
so nothing is tokenized twice unless a task is lost.

Defined cases: null text: as an empty one, whose only id is the end id; repeated doc_ids: one frame for each row,
ordered by the text's hash; empty table: no file, empty result; very long texts: worked on in pieces; other columns
are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devmetrics.llm.wordhash import ByteWords, Memo, pieces
from devmetrics.session import scratch_path

END_ID = 1
FILE_BYTES = 256 << 20  # of text
LEVEL = 3
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80

#: Kinds of bytes for cutting texts into units: white space, letters, digits, symbols; 4 is never cut from its
#: neighbours (apostrophes, control characters and everything that isn't ASCII).
_KIND = np.full(256, 4, np.uint8)
for _b in range(33, 127):
    _KIND[_b] = 1 if chr(_b).isalpha() else 2 if chr(_b).isdigit() else 3
_KIND[ord("'")] = 4
_KIND[[9, 10, 11, 12, 13, 32]] = 0


class Units(ByteWords):
    """Units that the word tokenizer treats alone: it drops white space, and its pattern ends a piece where ASCII
    letters, digits and symbols meet. ASCII letters are lower-cased, except before other bytes, as such a letter
    may combine with what follows before the tokenizer lower-cases it."""

    def __init__(self, texts: list[str]):
        super().__init__(texts, is_word=_KIND > 0)
        followed = np.append(self.raw[1:], 0) >= 0x80
        self.buf = np.where(followed, self.raw, self.buf)
        kind = _KIND[self.raw]
        before = np.append(0, kind[:-1])
        cut = (kind != before) & (kind != 4) & (before != 4)
        self.starts = np.flatnonzero(cut & (kind > 0) | (before == 0) & (kind == 4))
        after = np.append(kind[1:], 0)
        cut = (kind != after) & (kind != 4) & (after != 4)
        self.ends = np.flatnonzero(cut & (kind > 0) | (after == 0) & (kind == 4)) + 1
        self.which = np.searchsorted(self.offsets, self.starts, "right") - 1


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest
    for characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordTokenizer:
    """The tokenizers library on units, remembered for as long as the worker lives."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.memo = Memo(self._make, 2, np.int64)

    def _make(self, places: np.ndarray) -> np.ndarray:
        if self.memo.n == 0:
            self.used = 0
        data, tokenize = self.units.buf.tobytes(), self.tokenizer.model.tokenize
        spans = zip(self.units.starts[places].tolist(), self.units.ends[places].tolist())
        words = [data[s:e] for s, e in spans]
        found: list = [None] * len(words)
        rest = []
        for i, w in enumerate(words):
            if w.isalpha() and w.islower():  # a to z: nothing to normalize, one piece, letters stand for themselves
                found[i] = [t.id for t in tokenize(w.decode())]
            else:
                text = w.decode("utf-8", "replace")
                if text.isalpha() and text.islower() and max(text) < "ƀ":  # composed Latin letters
                    found[i] = [t.id for t in tokenize("".join(map(self.letters.__getitem__, w)))]
                else:
                    rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)):
            found[i] = e.ids
        lengths = np.array([len(f) for f in found], np.int64)
        flat = np.fromiter((x for f in found for x in f), np.uint32, int(lengths.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(len(self.ids), np.uint32))
        self.ids[self.used:self.used + len(flat)] = flat
        offsets = self.used + np.cumsum(lengths) - lengths
        self.used += len(flat)
        return np.column_stack([offsets, lengths])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each whole text."""
        whole = {i for i, t in enumerate(texts) if t and "<|" in t}  # may hold strings of special tokens
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for i in whole:
            parts[i].append(np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32))
        for part in pieces("" if i in whole else t for i, t in enumerate(texts)):
            self.units = Units([t for _, t in part])
            at = self.memo(self.units.hashes())
            rows = self.memo.rows[at]
            offsets, lengths = rows[:, 0], rows[:, 1]
            total = np.cumsum(lengths)
            size = int(total[-1]) if len(total) else 0
            flat = self.ids[np.repeat(offsets - total + lengths, lengths) + np.arange(size)]
            ends = np.cumsum(np.bincount(self.units.which, weights=lengths, minlength=len(part)).astype(np.int64))
            for (i, _), ids in zip(part, np.split(flat, ends[:-1])):
                parts[i].append(ids)
        return [np.concatenate(p) if p else np.zeros(0, np.uint32) for p in parts]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class FileWriter:
    """Appends documents to one file; ``close`` writes the directory and the seek table."""

    def __init__(self, stream, level: int = LEVEL):
        import zstandard

        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.n_ids = 0

    def _frame(self, content: bytes) -> None:
        import xxhash

        frame = self.packer.compress(content)
        if max(len(frame), len(content)) >= 1 << 32:
            raise ValueError("a document of 4 GB of ids or more doesn't fit a seek table")
        self.stream.write(frame)
        self.table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._frame(ids.astype("<u4").tobytes())
        self.doc_ids.append(doc_id)
        self.n_ids += len(ids)

    def close(self) -> None:
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        self._frame(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + known.tobytes())
        table = np.array(self.table, "<u4").tobytes()
        foot = len(self.table).to_bytes(4, "little") + bytes([CHECKSUMS]) + SEEKABLE.to_bytes(4, "little")
        size = len(table) + len(foot)
        self.stream.write(SKIPPABLE.to_bytes(4, "little") + size.to_bytes(4, "little") + table + foot)
        self.stream.close()


class FileReader:
    """Documents of one file (a pyarrow random access file), by place or by doc_id."""

    def __init__(self, file):
        import zstandard

        self.file, self.unpacker = file, zstandard.ZstdDecompressor()
        size = file.size()
        foot = file.read_at(9, size - 9)
        if int.from_bytes(foot[5:], "little") != SEEKABLE:
            raise ValueError("no seek table")
        n = int.from_bytes(foot[:4], "little")
        self.table = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.append(0, np.cumsum(self.table[:, 0]))
        names = self._content(n - 1, file.read_at(int(self.table[-1, 0]), int(self.at[n - 1])))
        self.doc_ids = np.frombuffer(names[:8 * (n - 1)], "<i8")
        self.known = np.frombuffer(names[8 * (n - 1):], np.uint8).astype(bool)

    def _content(self, i: int, frame: bytes) -> bytes:
        import xxhash

        content = self.unpacker.decompress(frame)
        if len(content) != self.table[i, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        return content

    def documents(self, places: np.ndarray | None = None, block: int = 8 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of the wanted places (ascending; all if none are given); neighbours are read at once."""
        places = np.arange(len(self.doc_ids)) if places is None else places
        i = 0
        while i < len(places):
            j = i + 1
            while j < len(places) and places[j] == places[j - 1] + 1 and self.at[places[j] + 1] - self.at[places[i]] <= block:
                j += 1
            low = int(self.at[places[i]])
            data = self.file.read_at(int(self.at[places[j - 1] + 1]) - low, low)
            for p in places[i:j].tolist():
                yield p, np.frombuffer(self._content(p, data[self.at[p] - low:self.at[p + 1] - low]), "<u4")
            i = j

    def places_of(self, doc_ids) -> np.ndarray:
        return np.flatnonzero(self.known & np.isin(self.doc_ids, list(doc_ids)))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files and returns the manifest: part (in ascending doc_id order), path, n_docs, n_ids."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = docs.select("doc_id", "text").repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as arrow_fs

        writer, part = None, TaskContext.get().partitionId()
        words = word_tokenizer(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                doc_ids, texts = (batch.column(c).slice(at, 1000).to_pylist() for c in (0, 1))
                if writer is None and texts:
                    fs, base = arrow_fs.FileSystem.from_uri(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.zst"
                    writer = FileWriter(fs.open_output_stream(f"{base}/{name}", compression=None))
                for doc_id, ids in zip(doc_ids, words.encode(texts)):
                    writer.add(doc_id, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/{name}"], "n_docs": [len(writer.doc_ids)],
                                              "n_ids": [writer.n_ids]}, schema=schema)

    manifest = f"{folder}/manifest"
    rows.mapInArrow(write, "part int, path string, n_docs long, n_ids long").write.mode("overwrite").parquet(manifest)
    return spark.read.parquet(manifest)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Digest of every document read back: doc_id, start (ids before it in all files), n_tokens, ids_crc32.

    The sums over earlier files run over one row per file."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).select("path", "base")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as arrow_fs

        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = arrow_fs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as file:
                    reader, rows = FileReader(file), []
                    for place, ids in reader.documents():
                        doc_id = int(reader.doc_ids[place]) if reader.known[place] else None
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    n = max(1, manifest.count())
    return files.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes ``docs`` to new files in the shared folder and returns the digest read back from them."""
    return read_token_files(write_token_files(docs, scratch_path(spark, "token-files"), tokenizer))

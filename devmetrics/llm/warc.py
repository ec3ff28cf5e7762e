"""WARC archives: a writer with revisit records, and a reader that salvages what it can from damaged files.

Every page is one record, and every record a gzip member of its own. Of pages with equal payloads (SHA-1 of the UTF-8
bytes of the html) the one with the least page_id is a response record that holds the payload; the others are revisit
records that refer to it and hold only the HTTP head, whose Content-Length is that of the full payload. A payload under
``least`` bytes is always a response.

The reader checks every member (gzip's own checksum and length) and every record (version line, header, length, end,
digests of block and payload). After a failed check it searches on for the next place where a member or a version line
begins that passes all checks, goes on from there, and notes the bytes between as a gap, with the check that failed.
If only a digest is wrong and the next unit begins where the record says it ends, the gap is that record and nothing in
it is searched. Compressed and plain files are read, and files that hold both.

Files are written by tasks, straight to the shared folder, under names that no other attempt uses; the manifest,
committed by Spark, names those of the attempts that count. A file is read by one task, in windows of bounded size; one
record at a time is held whole.

Defined cases: null html: an empty payload; null url: no target; control characters and blanks in a url are
percent-encoded; null page_id: refers to the least known page_id of its payload, and is a response if there is none;
rows that repeat the least page_id of their payload are all responses; very long payloads are written and read whole;
empty table: no file, empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.session import materialize, scratch_path

LEAST = 0  # bytes
FILE_BYTES = 256 << 20  # of records, compressed
DATE = "2000-01-01T00:00:00Z"
WINDOW = 4 << 20

#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_UNIT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
_LONGEST_HEAD = 1 << 20
_RECORD_ID = r"^<urn:page:(-?[0-9]+):"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

FOUND = pa.schema([("kind", pa.string()), ("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()),
                   ("type", pa.string()), ("record_id", pa.string()), ("target", pa.string()), ("refers_to", pa.string()),
                   ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{payload_digest}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, date: str = DATE) -> bytes:
    """One record; ``first``: the page_id that a revisit refers to (None: a response)."""
    own = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if first is None else head
    lines = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(page_id, own)), ("WARC-Date", date)]
    if url is not None:
        lines.append(("WARC-Target-URI", re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if first is not None:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, own))]
    lines += [("WARC-Payload-Digest", f"sha1:{own}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines).encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damage(Exception):
    """A failed check; ``end``: where the unit ends, if its frame was whole."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    start: int
    end: int

    def payload(self) -> bytes:
        """The block behind the HTTP head, where there is one."""
        if not self.headers.get("content-type", "").startswith("application/http"):
            return self.block
        return self.block.partition(b"\r\n\r\n")[2]

    def payload_bytes(self) -> int:
        """Of a revisit, what the HTTP head says."""
        if self.headers.get("warc-type") != "revisit":
            return len(self.payload())
        said = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)\r?$", self.block.partition(b"\r\n\r\n")[0])
        return int(said[1]) if said else 0


@dataclass
class Gap:
    start: int
    end: int
    reason: str


class Window:
    """Bytes of a file by place, read in windows; the last one is kept."""

    def __init__(self, read: Callable[[int, int], bytes], size: int, window: int = WINDOW):
        self.read, self.size, self.window, self.at, self.data = read, size, window, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if at < self.at or at + n > self.at + len(self.data):
            self.at, self.data = at, self.read(at, min(max(n, self.window), self.size - at))
        return self.data[at - self.at:at - self.at + n]


def parsed(get: Callable[[int, int], bytes], at: int, size: int) -> Record:
    """The record at a place, with all its checks."""
    n = 4096
    while (stop := (head := get(at, n)).find(b"\r\n\r\n")) < 0 and n < _LONGEST_HEAD and at + n < size:
        n *= 4
    if not _VERSION_LINE.match(head):
        raise Damage("version line")
    if stop < 0:
        raise Damage("header")
    headers = {}
    for line in head[:stop].split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Damage("header")
        headers[name.strip().lower()] = value.strip()
    if not all(headers.get(name) for name in _MANDATORY):
        raise Damage("header")
    length = headers["content-length"]
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Damage("length")
    first = at + stop + 4
    end = first + int(length) + 4
    if end > size:
        raise Damage("length")
    if get(end - 4, 4) != b"\r\n\r\n":
        raise Damage("end of record")
    found = Record(headers, get(first, int(length)), at, end)
    checks = [("warc-block-digest", found.block)]
    if headers.get("warc-type") == "response":
        checks.append(("warc-payload-digest", found.payload()))
    for name, data in checks:
        kind, _, value = headers.get(name, "").partition(":")
        if kind.lower() == "sha1" and value.upper() != digest(data):
            raise Damage(name[5:].replace("-", " "), end)
    return found


def opened(src: Window, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at a place; one that doesn't begin with a version line isn't unpacked."""
    unpacker, parts, place, begun = zlib.decompressobj(31), [], at, b""
    try:
        while not unpacker.eof:
            data = src.get(place, 1 << 14 if place == at else 1 << 20)
            if not data:
                raise Damage("end of member")
            place += len(data)
            parts.append(unpacker.decompress(data))
            if len(begun) < 10:
                begun = b"".join(parts)[:10]
                if not (_VERSION_LINE.match(begun) or VERSION[:5].startswith(begun[:5]) and len(begun) < 10 and not unpacker.eof):
                    raise Damage("version line")
    except zlib.error as e:
        raise Damage("member") from e
    return b"".join(parts), place - len(unpacker.unused_data)


def unit_at(src: Window, at: int) -> tuple[list[Record | Gap], int]:
    """What the member or the plain record at a place holds, and its end."""
    if src.get(at, 3) != b"\x1f\x8b\x08":
        found = parsed(src.get, at, src.size)
        return [found], found.end
    content, end = opened(src, at)
    found, inner = [], 0
    while inner < len(content):
        try:
            one = parsed(lambda a, n: content[a:a + n], inner, len(content))
        except Damage as damage:
            if not found:
                raise Damage(damage.reason, end) from damage
            found.append(Gap(at, end, damage.reason))
            break
        inner = one.end
        one.start, one.end = at, end
        found.append(one)
    return found, end


def next_unit(src: Window, at: int) -> tuple[int, tuple[list[Record | Gap], int] | None]:
    """The next place from ``at`` on with a unit that passes its checks, and that unit; the file's end if there is none."""
    while at < src.size:
        data = src.get(at, src.window)
        hit = _UNIT.search(data)
        if not hit:
            at = max(at + len(data) - 9, at + 1) if at + len(data) < src.size else src.size
            continue
        place = at + hit.start()
        try:
            return place, unit_at(src, place)
        except Damage:
            at = place + 1
    return src.size, None


def salvage(src: Window) -> Iterator[Record | Gap]:
    """All records of a file that pass their checks, and the gaps between them."""
    at, known = 0, None
    while at < src.size:
        # line ends too many before a unit or the file's end
        if known is None and (blank := re.match(rb"[\r\n]+(?=\x1f\x8b\x08|WARC/|\Z)", src.get(at, 64))):
            at += blank.end()
            continue
        try:
            found, end = known or unit_at(src, at)
            known = None
            yield from found
        except Damage as damage:
            end = damage.end
            if end is None or end < src.size and not _UNIT.match(src.get(end, 10)):
                end, known = next_unit(src, at + 1)
            yield Gap(at, end, damage.reason)
        at = end


def found_row(path: str, one: Record | Gap, payloads: bool) -> tuple:
    if isinstance(one, Gap):
        return "gap", path, one.start, one.end, one.reason, *[None] * 7
    h = one.headers
    return ("record", path, one.start, one.end, None, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"),
            h.get("warc-refers-to"), h.get("warc-payload-digest", "").partition(":")[2] or None, one.payload_bytes(),
            one.payload() if payloads and h.get("warc-type") != "revisit" else None)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Rows of all files (column ``path``): kind ``record`` or ``gap``, the place in the file (of the member, where
    there is one), the reason of a gap, and a record's type, record_id, target, refers_to, payload_digest,
    payload_bytes and payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as arrow_fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = arrow_fs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as file:
                    rows, held = [], 0
                    for one in salvage(Window(lambda at, n: file.read_at(n, at), file.size())):
                        rows.append(found_row(path, one, payloads))
                        held += len(rows[-1][-1] or b"")
                        if len(rows) == 1000 or held > WINDOW:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    kinds = "kind string, path string, start long, end long, reason string, type string, record_id string, target string, refers_to string, payload_digest string, payload_bytes long, payload binary"
    return files.select("path").repartition(max(1, files.count())).mapInArrow(read, kinds)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), FOUND)], schema=FOUND)


def with_first(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, html, first): ``first`` is the page_id that a revisit refers to, null for a response.

    Only payloads that occur twice or more meet the pages again; the pages of one payload are split by Spark's skew
    join where they are many (a row of theirs needs nothing of the others)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("payload", F.sha1(F.encode("html", "UTF-8")))
    again = (keyed.where(F.octet_length("html") >= least).groupBy("payload").agg(F.min("page_id").alias("least_id"), F.count("*").alias("n"))
             .where("n > 1").select("payload", "least_id"))
    revisit = F.col("least_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least_id"))
    return keyed.join(again, "payload", "left").select("page_id", "url", "html", F.when(revisit, F.col("least_id")).alias("first"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files and returns the manifest: path, n_records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as arrow_fs

        stream, name, size, n, done = None, "", 0, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100).to_pydict()
                for page_id, url, html, first in zip(part["page_id"], part["url"], part["html"], part["first"]):
                    if stream is None:
                        fs, base = arrow_fs.FileSystem.from_uri(folder)
                        fs.create_dir(base, recursive=True)
                        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        stream, size, n = fs.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                    data = member(record(page_id, url, html.encode("utf-8", "replace"), first))
                    stream.write(data)
                    size, n = size + len(data), n + 1
                    if size >= file_bytes:
                        stream.close()
                        done.append((f"{folder}/{name}", n))
                        stream = None
        if stream is not None:
            stream.close()
            done.append((f"{folder}/{name}", n))
        if done:
            yield pa.RecordBatch.from_pydict({"path": [d[0] for d in done], "n_records": [d[1] for d in done]})

    manifest = f"{folder}/manifest"
    with_first(pages, least).mapInArrow(write, "path string, n_records long").write.mode("overwrite").parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


def archived(spark: SparkSession, pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes ``pages`` to new archives in the shared folder and returns what was read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. The log of gaps is written beside the archives (``quarantine``)."""
    folder = scratch_path(spark, "warc")
    found = materialize(read_archives(write_archives(pages, folder, least), payloads=False).drop("payload"), "warc-read")
    found.where("kind = 'gap'").select("path", "start", "end", "reason").write.mode("overwrite").parquet(f"{folder}/quarantine")
    page = lambda c: F.regexp_extract(c, _RECORD_ID, 1).try_cast("long")
    return found.where("kind = 'record'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"))


def oracle_sql(least: int = LEAST) -> str:
    code = f"(('0x' || substr(hex, (k // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31"
    return f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS least_id FROM p WHERE payload_bytes >= {least} GROUP BY hex),
r AS (SELECT p.*, CASE WHEN least_id IS NOT NULL AND page_id IS DISTINCT FROM least_id THEN least_id END AS refers_to FROM p LEFT JOIN f USING (hex))
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k: substr('{_BASE32}', (({code}) + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r"""

import gzip
import random
import re

import duckdb
import pyarrow.fs
import pytest

from devmetrics.llm import warc
from tests.conftest import SF_CHECK

PAGES = "page_id long, url string, html string, first int"


def read(data, window=warc.WINDOW):
    return list(warc.salvage(warc.Window(lambda at, n: data[at:at + n], len(data), window)))


def ids(found):
    return [int(re.search("page:([0-9]+)", f.headers["warc-record-id"])[1]) for f in found if isinstance(f, warc.Record)]


def gaps(found):
    return [(f.start, f.end, f.reason) for f in found if isinstance(f, warc.Gap)]


def some_records(n=12, seed=1):
    rng = random.Random(seed)
    return [warc.record(i, f"http://h/{i}", bytes(rng.choices(b"ab<>\r\n \xc3\xa9", k=rng.choice([0, 10, 500, 6000]))), None) for i in range(n)]


@pytest.mark.parametrize("pack", [bytes, warc.member])
@pytest.mark.parametrize("window", [64, 1000, warc.WINDOW])
def test_whole_files(pack, window):
    units = [pack(r) for r in some_records()]
    found = read(b"".join(units), window)
    assert ids(found) == list(range(12)) and gaps(found) == []
    assert [f.end for f in found] == [sum(map(len, units[:i + 1])) for i in range(12)]
    mixed = b"".join((warc.member(r) if i % 3 else r) for i, r in enumerate(some_records()))
    assert ids(read(mixed, window)) == list(range(12))


@pytest.mark.parametrize("pack", [bytes, warc.member])
@pytest.mark.parametrize("window", [64, warc.WINDOW])
def test_damage_costs_one_record(pack, window):
    units = [pack(r) for r in some_records(seed=2)]
    edges = [sum(map(len, units[:i])) for i in range(13)]
    rng = random.Random(3)
    for k in range(12):
        # in a plain record no check covers the fields of the header
        low = edges[k] + (units[k].index(b"\r\n\r\n") + 4 if pack is bytes else 0)
        for at in {edges[k], edges[k] + 5, *(rng.randrange(low, edges[k + 1]) for _ in range(12))}:
            data = bytearray(b"".join(units))
            data[at] ^= 0x15
            found = read(bytes(data), window)
            lost = [i for i in range(12) if i not in ids(found)]
            # free fields of gzip's header aren't covered either
            assert lost in ([], [k]), (k, at - edges[k], lost)
            if lost:
                assert [(s, e) for s, e, _ in gaps(found)] == [(edges[k], edges[k + 1])]


@pytest.mark.parametrize("pack", [bytes, warc.member])
def test_cut_and_foreign_bytes(pack):
    units = [pack(r) for r in some_records(seed=4)]
    junk = bytes(random.Random(5).choices(range(256), k=5000)) + b"\x1f\x8b\x08 WARC/1.0\r\nno record\r\n\r\n"
    cut = units[3][:len(units[3]) // 2]
    data = b"".join(units[:3]) + cut + b"".join(units[4:6]) + junk + b"".join(units[6:]) + units[0][:-9]
    found = read(data)
    assert ids(found) == [0, 1, 2, *range(4, 12)]
    a, b, c = sum(map(len, units[:3])), len(cut), sum(map(len, units[4:6]))
    assert [(s, e) for s, e, _ in gaps(found)] == [(a, a + b), (a + b + c, a + b + c + len(junk)), (len(data) - len(units[0]) + 9, len(data))]
    # bytes lost inside a unit, so that its length leads beyond its end
    short = units[5][:-40] if pack is bytes else units[5][:20] + units[5][60:]
    assert ids(read(units[4] + short + units[6] + units[7])) == [4, 6, 7]
    assert read(b"") == [] and [(g[0], g[1]) for g in gaps(read(b"xyz"))] == [(0, 3)]


def test_wrong_digest_skips_the_record_only():
    inner = warc.record(99, None, b"inner", None)
    outer = warc.record(1, None, b"before " + inner + b" after", None)
    bad = outer.replace(b"before", b"BEFORE")
    for pack in (bytes, warc.member):
        found = read(pack(bad) + pack(warc.record(2, None, b"x", None)))
        assert ids(found) == [2] and gaps(found) == [(0, len(pack(bad)), "block digest")]
    other = warc.record(1, None, b"payload", None)
    wrong = other.replace(re.search(rb"Payload-Digest: (\S+)", other)[1], b"sha1:" + warc.digest(b"other").encode())
    assert gaps(read(wrong)) == [(0, len(wrong), "payload digest")]


def test_member_of_several_records():
    a, b, c = some_records(3)
    found = read(warc.member(a + b) + gzip.compress(c))
    assert ids(found) == [0, 1, 2]
    found = read(warc.member(a + b[:-3]) + warc.member(c))
    assert ids(found) == [0, 2] and len(gaps(found)) == 1


def brute(rows):
    payload = lambda r: (r[2] or "").encode()
    out = []
    for r in rows:
        known = [x[0] for x in rows if payload(x) == payload(r) and x[0] is not None]
        n = sum(payload(x) == payload(r) for x in rows)
        first = min(known) if known and n > 1 and r[0] != min(known) else None
        out.append((r[0], len(payload(r)), warc.digest(payload(r)), "response" if first is None else "revisit", first))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r])


def test_odd_pages(spark):
    rows = [(5, "http://a/ x\r\nWARC/1.0", "same é", 1), (3, None, "same é", 1), (None, "u", "same é", None), (None, "u", "alone", 0), (7, "u", None, 1), (8, "u", "", 1),
            (8, "u", "", 1), (9, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n", 1), (-4, "日本", "x" * 300_000, 2), (6, "v", "\x00\x1f\x8b\x08", 1),
            (None, "a", "twice", 0), (None, "b", "twice", 0)]
    pages = spark.createDataFrame(rows, PAGES)
    assert ordered(warc.archived(spark, pages).collect()) == ordered(brute(rows))
    assert warc.archived(spark, pages.limit(0)).collect() == []
    big = warc.archived(spark, pages, least=6).collect()
    assert {r.record_type for r in big if r.payload_bytes < 6} == {"response"} and sum(r.record_type == "revisit" for r in big) == 2


def test_table_and_sql(spark):
    got = warc.archived(spark, spark.read.parquet(f"{SF_CHECK}/pages.parquet")).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF_CHECK}/pages.parquet'")
    assert ordered(got) == ordered(con.sql(warc.oracle_sql()).fetchall()) and len(got) == 250


def test_files_payloads_and_damage(spark, tmp_dir):
    rows = [(i, f"http://h/{i}", f"page {i % 40} " * 50, 0) for i in range(200)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    manifest = warc.write_archives(pages, f"file://{tmp_dir}/w", file_bytes=2000)
    files = manifest.collect()
    assert sum(f.n_records for f in files) == 200 and len(files) > 3
    read_back = warc.read_archives(manifest).collect()
    assert {(r.type, r.payload.decode()) for r in read_back if r.payload} == {("response", r[2]) for r in rows[:40]}
    # any gzip reader gets the records
    local = pyarrow.fs.LocalFileSystem()
    path = files[0].path.removeprefix("file://")
    data = local.open_input_file(path).read()
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == files[0].n_records
    with open(path, "wb") as out:
        out.write(data[:30] + b"\xff" + data[31:] + b"rest")
    found = warc.read_archives(manifest).collect()
    assert sum(r.kind == "record" for r in found) == 199
    broken = sorted((r.path, r.start, r.end) for r in found if r.kind == "gap")
    assert len(broken) == 2 and broken[0][1] == 0 and broken[1][1:] == (len(data), len(data) + 4) and broken[0][0] == files[0].path

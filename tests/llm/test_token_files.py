import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
import zstandard
from tokenizers import Tokenizer

from devmetrics.llm import token_files
from devmetrics.llm.wordhash import Memo, pieces
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, " ", "It's 'tis don'T I'LL a.'s b'.c 12ab 3.14 <|endoftext|> x<|startoftext|>y <|STARTOFTEXT|>", "İstanbul ŞıK ẞ W̊ é É áb Å.B̧c",
       "x\x1cy\x1dz \x0b\x0c\x85\xa0 q\x00r\x7fs", "日本語 テスト １２３ ½ Ⅷ", "café. CAFÉ! naïve–dash… “quotes” 'abc' ''' \"'s", "a" * 5000,
       "﻿bom ​zw Ǆ ǆ ſ K we're'VE'm O'Reilly's ΑΣ ΣΑΣ.", "the The THE, the. (the) the's"]


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_units_give_the_library_s_ids(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    words = token_files.WordTokenizer(PATH)
    for again in (False, True):  # the second time from memory
        assert [x.tolist() for x in words.encode(texts)] == [whole(tokenizer, t) for t in texts]


def test_small_memory_and_pieces():
    """A memory that overflows, and a text cut into many pieces, change nothing."""
    words = token_files.WordTokenizer(PATH)
    text = " ".join(f"w{i}x{'y' * (i % 7)}, it's" for i in range(3000))
    want = words.encode([text])[0].tolist()
    words.memo = Memo(words._make, 2, np.int64, bits=9)
    assert words.encode([text])[0].tolist() == want
    assert "".join(t for part in pieces([text, None, "a b"], 100) for i, t in part if i == 0) == text
    assert max(len(t) for part in pieces([text], 100) for _, t in part) <= 100


def digest(rows):
    return sorted((r.doc_id is None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in rows)


def test_digest(spark, odd, empty):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for table in (docs, odd.withColumnRenamed("lang", "part")):
        got = sorted(token_files.token_files(spark, table, PATH).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda d: (d is None, d or 0))
        start = 0
        for r in got:
            assert r.start == start
            start += r.n_tokens
        want = sorted(zlib.crc32(np.array(whole(tokenizer, r.text) + [1], "<u4").tobytes()) for r in table.collect())
        assert sorted(r.ids_crc32 for r in got) == want
    assert token_files.token_files(spark, empty, PATH).collect() == []


def test_file_format(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tokenizer, texts = Tokenizer.from_file(PATH), {r.doc_id: r.text for r in docs.collect()}
    manifest = token_files.write_token_files(docs, f"{tmp_dir}/files", PATH).orderBy("part").collect()
    assert sum(m.n_docs for m in manifest) == len(texts)
    local, seen = pyarrow.fs.LocalFileSystem(), []
    for m in manifest:
        with local.open_input_file(m.path) as file:
            reader = token_files.FileReader(file)
            seen += reader.doc_ids.tolist()
            wanted = reader.doc_ids.tolist()[1::3]
            for place, ids in reader.documents(reader.places_of(wanted)):
                assert ids.tolist() == whole(tokenizer, texts[int(reader.doc_ids[place])]) + [1]
            # any zstandard reader gets all frames; the table is a skippable frame to it
            data = local.open_input_file(m.path).read()
            plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(data)
            assert len(plain) == int(reader.table[:, 1].sum()) == 4 * m.n_ids + 9 * m.n_docs
    assert seen == sorted(texts)


def test_damage_is_found(tmp_dir):
    local = pyarrow.fs.LocalFileSystem()
    writer = token_files.FileWriter(local.open_output_stream(f"{tmp_dir}/x", compression=None))
    for i in range(5):
        writer.add(i if i != 3 else None, np.arange(i * 100, dtype=np.uint32))
    writer.close()
    data = bytearray(open(f"{tmp_dir}/x", "rb").read())
    reader = token_files.FileReader(local.open_input_file(f"{tmp_dir}/x"))
    assert [len(ids) for _, ids in reader.documents()] == [0, 100, 200, 300, 400] and reader.places_of([0, 4]).tolist() == [0, 4]
    data[int(reader.at[2]) + 20] ^= 1
    open(f"{tmp_dir}/y", "wb").write(data)
    reader = token_files.FileReader(local.open_input_file(f"{tmp_dir}/y"))
    assert [p for p, _ in reader.documents(np.array([0, 1, 4]))] == [0, 1, 4]  # the others can still be read
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(reader.documents())

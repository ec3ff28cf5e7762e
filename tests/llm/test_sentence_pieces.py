import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from devmetrics.llm import sentence_pieces as sp
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  a  b ", "x▁y ▁▁", "日本語 テスト 𝔘\n\n\tq", "a\x00b", "\n", "ab" * 3000 + " c", "the cat sat on the mat"]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.Pieces(PATH)


def runs(ids, borders):
    return [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])]


def test_lossless_here_and_in_the_library(vocabulary):
    ids, borders = sp.Sampler(vocabulary).encode(TEXTS, np.arange(len(TEXTS)))
    assert vocabulary.decode(ids, borders) == [t or "" for t in TEXTS]
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert [model.decode(r) for r in runs(ids, borders)] == [t or "" for t in TEXTS]


def test_same_in_any_order_batch_or_memory(vocabulary):
    keys = np.arange(len(TEXTS)) * 977
    want = runs(*sp.Sampler(vocabulary).encode(TEXTS, keys))
    small = sp.Sampler(vocabulary, bits=3)
    assert [runs(*small.encode([t], np.array([k])))[0] for t, k in zip(TEXTS[::-1], keys[::-1])][::-1] == want
    other = runs(*sp.Sampler(vocabulary).encode(TEXTS, keys, seed=99))
    assert other != want


@pytest.mark.parametrize("long", [256, 0])
def test_sampling_follows_the_lattice(vocabulary, long, monkeypatch):
    """All segmentations of a word by brute force, with their shares, against the counts of many samples."""
    monkeypatch.setattr(sp, "LONG", long)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    weight = dict(zip(vocabulary.ids.tolist(), vocabulary.weights.tolist()))
    piece = {model.id_to_piece(i): i for i in weight}
    word = "▁tested"

    def ways(at):
        if at == len(word):
            yield (), 0.0
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in piece:
                i = piece[word[at:end]]
                for rest, w in ways(end):
                    yield (i, *rest), weight[i] + w

    every = dict(ways(0))
    total = np.logaddexp.reduce(list(every.values()))
    n = 20_000
    ids, borders = sp.Sampler(vocabulary).encode(["tested"] * n, np.arange(n))
    seen = Counter(map(tuple, runs(ids, borders)))
    assert set(seen) <= set(every) and len(seen) > 5
    for way, w in every.items():
        p = np.exp(w - total)
        assert abs(seen[way] - n * p) <= 5 * np.sqrt(n * p) + 3


def test_long_text_in_pieces(vocabulary, monkeypatch):
    text = "one two\nthree  four ▁ five " * 400
    monkeypatch.setattr(sp, "PIECE", 64)
    ids, borders = sp.Sampler(vocabulary).encode([text, "x", text], np.array([1, 2, 1]))
    assert vocabulary.decode(ids, borders) == [text, "x", text]
    assert runs(ids, borders)[0] == runs(ids, borders)[2]


def test_long_words_like_short_ones(vocabulary, monkeypatch):
    """The same numbers are drawn on both ways, so the samples are the same, in windows of any size."""
    texts = [*TEXTS, "日本語の文章には空白がない。" * 30, "aGVsbG8gd29ybGQ" * 40 + "\n" + "x▁" * 300, "e" * 700]
    keys = np.arange(len(texts)) * 31
    monkeypatch.setattr(sp, "LONG", 1 << 30)
    want = runs(*sp.Sampler(vocabulary).encode(texts, keys))
    for long, window in ((0, 1 << 14), (0, 1), (3, 7), (256, 100)):
        monkeypatch.setattr(sp, "LONG", long)
        monkeypatch.setattr(sp, "WINDOW", window)
        assert runs(*sp.Sampler(vocabulary).encode(texts, keys)) == want


def test_a_megabyte_without_blanks(vocabulary):
    letters = np.random.default_rng(5).integers(97, 123, 1_000_000).astype(np.uint8).tobytes().decode()
    text = letters[:900_000] + "文字" * 50_000
    begun = time.time()
    encoder = sp.Sampler(vocabulary)
    ids, borders = encoder.encode([text, "a b", text], np.array([1, 2, 1]))
    assert time.time() - begun < 60  # two of them; seconds each, with room for a busy machine
    assert vocabulary.decode(ids, borders) == [text, "a b", text]
    assert runs(ids, borders)[0] == runs(ids, borders)[2]
    assert len(encoder.share) == 1 << 16  # nothing of them is remembered


def test_documents(spark, odd, empty):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for table in (docs, odd):
        encoded = sp.encode_documents(table, PATH).cache()
        rows = encoded.collect()
        assert encoded.columns == ["doc_id", "lang", "source", "n_chars", "ids", "n_ids", "lossless"]
        assert all(r.lossless if r.ids is not None else r.lossless is None and r.n_ids is None for r in rows)
        assert all(r.ids is None or r.n_ids == len(r.ids) for r in rows)
        back = sp.decode_documents(encoded, PATH, ["doc_id"]).collect()
        key = lambda x: (str(x[0]), str(x[1]))
        assert sorted(map(tuple, back), key=key) == sorted(((r.doc_id, r.text) for r in table.collect()), key=key)
    again = {r.doc_id: r.ids for r in sp.encode_documents(docs.repartition(5), PATH).collect()}
    assert again == {r.doc_id: r.ids for r in sp.encode_documents(docs, PATH).collect()}
    assert sp.encode_documents(empty, PATH).collect() == []
    clash = docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "lossless")
    assert sp.encode_documents(clash, PATH).columns == ["doc_id", "n_chars", "ids", "n_ids", "lossless"]

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Nulls in any column, empty and blank texts, repeated rows, repeated ids, odd characters, a long text.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog near the old stone bridge", "en", "a", 69),
    (1, "the quick brown fox jumps over the lazy dog near the old stone bridge", "en", "a", 69),
    (1, "another text under the same id", "en", "b", 30),
    (2, None, None, None, None),
    (None, "a text without an id\nand two lines", "en", None, 34),
    (None, None, None, "a", None),
    (3, "", "en", "", 0),
    (4, " \t\n ", "de", "a", 4),
    (5, "▁ 日本語 𝔘 é é ① ½ İstanbul\x00 <|endoftext|>", "ja", "é", 30),
    (6, "word " * 3000, "en", "a", 15000),
    (7, "x" * 2000, "en", "a", 2000),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make

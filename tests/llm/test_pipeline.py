"""The pipeline's stages, each against a brute-force version on its own input."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from devmetrics.llm import mixing, simhash, toxicity
from devmetrics.session import materialize
from tests.conftest import SF_SMALL
from tests.llm.test_secrets import brute
from tests.llm.test_simhash import brute_components, brute_print


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF_SMALL), "test-stage")
        out[name], docs = (docs, after), after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "simhash near-dedup", "secret scan", "mixing", "sentence pieces"]
    for name, (before, after) in stages.items():
        if name != "sentence pieces":
            assert after.columns == before.columns and [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), toxicity.learnable())
    kept = [r for r in before.collect() if toxicity.Scorer(model).score([r.text])[0][0] < 0.7]
    assert rows(after) == Counter(map(tuple, kept))


def test_near_dedup(stages):
    before, after = stages["simhash near-dedup"]
    docs = sorted(before.collect(), key=lambda r: r.doc_id)
    roots = brute_components(np.array([brute_print(r.text) for r in docs], np.uint64))
    assert rows(after) == Counter(tuple(docs[i]) for i in set(roots))


def test_secret_scan(stages):
    before, after = stages["secret scan"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert after.count() == len(texts)
    for r in after.collect():
        spans = brute(texts[r.doc_id])[1]
        assert (r.text == texts[r.doc_id]) == (not spans) and r.n_chars == len(r.text)
        for a, _, b in spans:
            assert texts[r.doc_id][a:b] not in r.text


def test_mixing(stages):
    before, after = stages["mixing"]
    want = Counter()
    repeats = {r.doc_id: r.repeats for r in mixing.mix_sources(before).collect()}
    for r in before.collect():
        want[tuple(r)] += repeats[r.doc_id]
    assert rows(after) == +want


def test_pieces(stages):
    before, after = stages["sentence pieces"]
    assert after.count() == before.count() and after.where("not lossless").count() == 0


def test_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF_SMALL), "test-odd")
            assert docs.count() <= 2 * n


def test_clashing_names(spark, odd):
    """Extra columns named like those the stages use, or with a dot, come through with their values."""
    names = ["__row", "__fp", "__source", "__whole", "__last", "__copy", "__toxicity", "__spans", "a.b", "x`y", "__text", "__key", "label", "score", "Size"]
    docs = odd.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES:
        plain = materialize(stage(spark, odd, SF_SMALL), "test-names")
        got = materialize(stage(spark, docs, SF_SMALL), "test-names")
        own = [c for c in got.columns if c not in names]
        assert sorted(map(str, got.select(*own).collect())) == sorted(map(str, plain.select(*own).collect())), name
        assert [set(r[i] for r in got.collect()) for i, c in enumerate(got.columns) if c in names] == [{i} for i in range(len(names))], name


def test_texts_without_words_are_not_taken_more_often(spark, odd):
    texts = [(i, t, "en", s, 0) for i, (t, s) in enumerate([("", "a"), (" ", "a"), (None, "a"), ("w " * 50, "a"), ("", "b"), ("x y z " * 9, "b")] * 7)]
    docs = spark.createDataFrame(texts, odd.schema)
    taken = Counter(r.doc_id for r in corpus_pipeline.mix(spark, docs, SF_SMALL).collect())
    assert max(taken.values()) <= 2


def test_registered():
    found = entry.queries()
    assert "pipeline" in found and sum(k.startswith("op") and k[2].isdigit() for k in found) == 13
    assert simhash.MAX_BITS == 3 and simhash.SHINGLE == 3

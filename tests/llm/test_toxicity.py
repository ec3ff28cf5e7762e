import math
import re
import zlib

import numpy as np

from devmetrics.llm import toxicity
from tests.conftest import SF_CHECK

CLEAN = ["the river runs past the old mill", "we walked home in the rain", "bread and cheese for lunch", "a quiet evening by the lake"]


def corpus(n=120):
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(n):
        sentences = [CLEAN[j] for j in rng.integers(0, 4, 6)]
        bad = i % 3 == 0
        if bad:
            sentences[int(rng.integers(0, 6))] = f"you are a {['moron', 'scumbag'][i % 2]} indeed"
        texts.append(". ".join(sentences) + ".")
        labels.append(int(bad))
    return texts, labels


def test_learns_sentences_from_document_labels():
    texts, labels = corpus()
    scorer = toxicity.Scorer(toxicity.train(texts, labels))
    scores, spans = scorer.score(texts, locate=0.5)
    assert all((s >= 0.7) == (y == 1) for s, y in zip(scores, labels))
    for text, found, y in zip(texts, spans, labels):
        assert [text[a:b] for a, b, _ in found] == ([x for x in text.split(". ") if "you are" in x] and [next(x for x in text.rstrip(".").split(". ") if "you are" in x)] if y else [])


def test_noisy_or_of_sentences():
    model = toxicity.Model({"bad": 5.0, "good": -2.0}, -4.0)
    text = "bad thing. good bad? nothing here\nBAD bad!"
    z = [-4 + 5, -4 + 3, -4, -4 + 10]
    want = 1 - np.prod([1 - 1 / (1 + np.exp(-x)) for x in z])
    assert abs(toxicity.Scorer(model).score([text])[0][0] - want) < 1e-9


def by_hand(model, text):
    """The registered score, sentence by sentence."""
    found = []
    for sentence in re.split(r"[.!?\n]", text):
        own = [model.weights[f] for w in re.findall(r"[^\W\d_]+", sentence.lower()) for f in toxicity.word_features(w) if f in model.weights]
        if own:
            found.append(1 / (1 + math.exp(-(model.bias + sum(own)))))
    strong, weak = [p for p in found if p >= 0.5], [p for p in found if p < 0.5]
    return 1 - math.prod(1 - p for p in strong + sorted(weak)[-1:])


def test_registered_score_by_hand():
    model = toxicity.Model({"bad": 3.0, "mild": 1.5, "good": -2.0, "naug-": 0.5, "naugh-": 1.0}, -2.0, toxicity.FLOOR)
    rng = np.random.default_rng(1)
    words = ["bad", "mild", "good", "naughty", "other", "thing", "Bad", "MILD"]
    texts = ["", "other thing", "mild", "mild. mild. mild", "bad. bad", "good. naughty\nmild mild! bad"]
    texts += [" ".join(w + e for w, e in zip(rng.choice(words, 30), rng.choice(["", "", ".", "\n", "?"], 30))) for _ in range(200)]
    scores = toxicity.Scorer(model).score(texts)[0]
    assert np.allclose(scores, [by_hand(model, t) for t in texts], atol=1e-6) and len(set(scores)) > 20
    fitted = toxicity.train(*corpus())
    texts = corpus()[0]
    assert np.allclose(toxicity.Scorer(fitted).score(texts)[0], [by_hand(fitted, t) for t in texts], atol=1e-5)


def test_sentences_that_count_in_training():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(0, 12))
        document, p = np.sort(rng.integers(0, 4, n)), rng.choice([0.1, 0.3, 0.4, 0.5, 0.9], n)
        want = np.zeros(n, bool)
        for d in set(document.tolist()):
            own = [i for i in range(n) if document[i] == d]
            weak = [i for i in own if p[i] < 0.5]
            want[[i for i in own if p[i] >= 0.5] + ([max(weak, key=lambda i: (p[i], -i))] if weak else [])] = True
        assert (toxicity.counted_sentences(document, p, 0.5) == want).all()


def test_offsets_count_code_points():
    model = toxicity.Model({"bad": 9.0}, -4.0)
    text = "é𝔘 ok. so bád é bad, yes. fin"
    (spans,) = toxicity.Scorer(model).score([text], locate=0.5)[1]
    assert [text[a:b] for a, b, _ in spans] == ["so bád é bad, yes"]


def test_long_text_in_pieces(monkeypatch):
    from devmetrics.llm import wordhash

    monkeypatch.setattr(toxicity, "pieces", lambda texts: wordhash.pieces(texts, 50))
    text = "é ok.\nso bad, yes\nfin é fin\n" * 30
    (spans,) = toxicity.Scorer(toxicity.Model({"bad": 9.0}, -4.0)).score([text], locate=0.5)[1]
    assert [text[a:b] for a, b, _ in spans] == ["so bad, yes"] * 30


def test_degenerate_training():
    assert toxicity.train(["a", "b"], [0, 0]).weights == {}
    assert toxicity.Scorer(toxicity.train([], [])).score(["x y", "", None])[0].max() < 1e-9


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    out = [(r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    # few labels at this size: it knows the common words, and leaves clean documents alone
    assert sum(p for p, y in out if not y) == 0 and sum(p for p, y in out if y) >= 0.5 * sum(y for _, y in out)


def test_held_out_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, t, toxicity.learnable()) for t in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd, empty, labels):
    marks = labels([(1, 1, 0), (1, 1, 1), (3, None, None), (None, 1, 1), (6, 0, 0)])
    got = toxicity.toxicity(odd, marks).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(empty, marks).collect() == []
    assert len(toxicity.toxicity(odd, labels([])).collect()) == odd.count()


def joined_to(texts, size):
    text = "\n".join(texts)
    return "\n".join([text] * (size // len(text) + 1))[:size].rpartition("\n")[0]


def test_length_alone_rejects_nothing():
    texts, labels = corpus()
    scorer = toxicity.Scorer(toxicity.train(texts, labels))
    clean = [t for t, y in zip(texts, labels) if not y]
    # "indeed" goes with toxic documents; alone it is weak, however often it stands
    for own in (clean, clean + ["the lake, indeed."]):
        long = [joined_to(own, n) for n in (1_000_000, 10_000_000)]
        scores, spans = scorer.score([own[-1], *long], locate=0.5)
        assert (scores < 0.5).all() and (scores == scores[0]).all() and spans == [[], [], []]
    text = long[1] + "\nyou are a moron indeed. bye"
    (score,), (found,) = scorer.score([text], locate=0.5)
    assert score >= 0.7 and [text[a:b] for a, b, _ in found] == ["you are a moron indeed"]


def test_long_held_out_clean_text(spark):
    """Clean texts that each score low, joined to 1 and 10 MB, stay under the threshold; one toxic text among them is found."""
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    scorer = toxicity.Scorer(toxicity.fit(docs, labels, toxicity.learnable()))
    held = [r for r in docs.select("doc_id", "text").collect() if r.doc_id in marks and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    scores = scorer.score([r.text for r in held])[0]
    clean = [r.text for r, s in zip(held, scores) if not marks[r.doc_id] and s < 0.3]
    long = [joined_to(clean, n) for n in (1_000_000, 10_000_000)]
    assert (scorer.score(long)[0] < 0.3).all()
    bad = next(r.text for r, s in zip(held, scores) if marks[r.doc_id] and s >= 0.7)
    assert scorer.score([long[1] + "\n" + bad])[0][0] >= 0.7

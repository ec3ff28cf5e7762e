import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from devmetrics.llm import langid
from tests.conftest import SF_CHECK

WORDS = {"en": Counter("the then than that this there with whit width their".split() * 2 + ["the"] * 5),
         "de": Counter("der die das und auch nicht schon schön über größe".split() * 2 + ["und"] * 4)}


class Brute:
    """Interpolated Kneser-Ney, recursively, from the definition."""

    def __init__(self, words, order, letters):
        self.order, self.letters = order, letters
        self.counts = [defaultdict(float) for _ in range(order + 1)]
        for w, n in words.items():
            s = " " * (order - 1) + w + " "
            for i in range(order - 1, len(s)):
                self.counts[order][s[i - order + 1:i + 1]] += n
        for k in range(order - 1, 0, -1):
            for g in self.counts[k + 1]:
                self.counts[k][g[1:]] += 1
        self.discount = [0.0] * (order + 1)
        for k in range(1, order + 1):
            once, twice = (sum(c == n for c in self.counts[k].values()) for n in (1, 2))
            self.discount[k] = once / (once + 2 * twice) if once and twice else 0.5

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (self.letters + 2)
        same = {g: c for g, c in self.counts[k].items() if g[:-1] == gram[:-1]}
        if not same:
            return self.p(gram[1:])
        total, d = sum(same.values()), self.discount[k]
        return max(same.get(gram, 0) - d, 0) / total + d * len(same) / total * self.p(gram[1:])

    def minus_log(self, word):
        s = " " * (self.order - 1) + word + " "
        return -sum(math.log(self.p(s[i - self.order + 1:i + 1])) for i in range(self.order - 1, len(s)))


@pytest.mark.parametrize("order", [2, 3, 5])
def test_probabilities(order):
    model = langid.train(WORDS, order)
    letters = len({c for ws in WORDS.values() for w in ws for c in w})
    brutes = [Brute(WORDS[lang], order, letters) for lang in model.languages]
    words = ["the", "und", "thund", "schth", "x", "größten", "q7ü"]
    sums = model.word_sums(words)
    for w, row in zip(words, sums):
        runs = langid.letter_runs(w)
        assert row[0] == sum(len(r) + 1 for r in runs)
        for b, got in zip(brutes, row[1:]):
            assert got == pytest.approx(sum(b.minus_log(r) for r in runs), rel=1e-9)


def test_distribution_sums_to_one():
    brute = Brute(WORDS["en"], 3, 20)
    letters = {c for w in WORDS["en"] for c in w} | {" "}
    seen = sum(brute.p("th" + c) for c in letters)
    assert seen + (20 + 2 - len(letters)) * brute.p("th#") == pytest.approx(1)


def test_keys_are_sorted():
    model = langid.train(WORDS)
    assert all((np.diff(k.astype(object)) > 0).all() for k in model.keys)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.language_id(docs).collect()
    out = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out]
    assert len(got) == docs.count() and len(out) > 100 and np.mean(out) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_rejects_what_it_never_saw(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = langid.fit(docs, langid.learnable())
    found = langid.Identifier(model).judge(["съешь ещё этих мягких французских булок " * 5, "the is was and of"])
    assert found.rejected.tolist()[0] and not found.rejected.tolist()[1]
    assert found.lang_pred.tolist()[1] == "en"


def test_odd_rows(spark, odd, empty):
    got = langid.language_id(odd).collect()
    assert len(got) == odd.count()
    texts = [r.text for r in odd.collect()]
    assert sorted(r.lang_pred == "und" for r in got) == sorted(not any(c.isalpha() for c in t or "") for t in texts)
    assert langid.language_id(empty).collect() == []
    nothing = odd.withColumn("lang", odd.lang.substr(100, 1)).where("false").union(odd.selectExpr("doc_id", "text", "cast(null as string)", "source", "n_chars"))
    assert {r.lang_pred for r in langid.language_id(nothing).collect()} == {"und"}

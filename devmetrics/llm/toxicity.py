"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability (logistic over its words), and the document's is
their noisy-or, 1 - product of (1 - p): a document is toxic if at least one sentence is. Only documents carry
labels; training moves the sentence weights through the noisy-or, so that afterwards the sentences that carry the
label stand out and are returned as spans.

A text's score must not grow with its length alone. So in a fitted model a sentence without any feature adds nothing,
and of the sentences under a probability of ``FLOOR`` (the level at which a sentence is returned as offending) only
the strongest adds: a text of any length without an offending sentence scores less than ``FLOOR``. Training goes through
the same function.

The classifier is fitted on the driver on a bounded sample of the labelled rows: at most ``TOXIC_SAMPLE`` toxic and
``CLEAN_SAMPLE`` other documents, those first in the order of md5(doc_id), and at most ``VOCABULARY`` features. Scoring reads every whole
text, in tasks of Spark.

Defined cases: null, empty or blank text: no sentence, score 0; null doc_id: scored, never learned from, held_out
null counts as false; several labels for an id: toxic if any says so; null labels are ignored; without labels of
both kinds every score is 0; repeated rows are scored row by row; empty table: empty result; other columns are not
read; a sentence over 2^18 characters may be cut at white space.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.common import bounded_sample, crc32_mod
from devmetrics.llm.wordhash import ByteWords, Memo, pieces

TOXIC_SAMPLE = 1200
CLEAN_SAMPLE = 3600
VOCABULARY = 50_000
MIN_ASSOCIATION = 16.0
#: Lengths of the word beginnings that are features beside the words.
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
FLOOR = 0.5
#: Where the bias starts and what it is drawn to: sentences without features, which don't count, can't hold it down.
BIAS = -8.0

#: Bytes that end a sentence.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True


def sample_labelled(docs: DataFrame, labels: DataFrame, value: str, usable, limits: tuple[int, int]) -> DataFrame:
    """At most ``limits[label]`` documents of each label, first in the order of md5(doc_id): (doc_id, text, label)."""
    marked = (labels.where(F.col(value).isNotNull() & F.col("doc_id").isNotNull()).where(usable)
              .groupBy("doc_id").agg(F.max((F.col(value) > 0).cast("int")).alias("label")))
    limit = F.when(F.col("label") == 1, limits[1]).otherwise(limits[0])
    chosen = bounded_sample(marked, "label", limit, max(limits))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")))


def sentence_words(texts: list[str]) -> tuple[ByteWords, np.ndarray]:
    """Words of the texts and the sentence each belongs to (numbered through all texts)."""
    words = ByteWords(texts)
    return words, np.cumsum(ENDS[words.raw], dtype=np.int64)[words.starts]


def sentence_bags(text: str | None) -> Iterator[list[str]]:
    """The features of each sentence that has words."""
    words, which = sentence_words([text or ""])
    data = words.raw.tobytes()
    found = [word_features(data[s:e].decode("utf-8", "replace").lower()) for s, e in zip(words.starts.tolist(), words.ends.tolist())]
    for s in np.split(np.arange(len(which)), np.flatnonzero(np.diff(which)) + 1):
        if len(s):
            yield [f for i in s.tolist() for f in found[i]]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    #: None: the noisy-or of all sentences. Else sentences without a feature don't count, and of those under this
    #: probability only the strongest does.
    floor: float | None = None


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word] + [f"{word[:n]}-" for n in PREFIXES if len(word) > n]


def association(with_toxic: np.ndarray, with_any: np.ndarray, toxic: int, n: int) -> np.ndarray:
    """Log-likelihood ratio (G2) of feature and label over documents; 0 where the feature speaks against the label."""
    out = np.zeros(len(with_any))
    for seen, of in ((with_toxic, toxic), (with_any - with_toxic, n - toxic)):
        for count, expected in ((seen, with_any * of / n), (of - seen, (n - with_any) * of / n)):
            out += 2 * np.where(count > 0, count * np.log(np.maximum(count, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return np.where(with_toxic * n > with_any * toxic, out, 0.0)


def counted_sentences(document: np.ndarray, p: np.ndarray, floor: float) -> np.ndarray:
    """Which sentences (with a feature) count: those of at least ``floor``, and a document's first strongest of the others."""
    counts = p >= floor
    weak = np.flatnonzero(~counts)
    order = weak[np.lexsort((weak, -p[weak], document[weak]))]
    counts[order[np.append(True, document[order][1:] != document[order][:-1])[:len(order)]]] = True
    return counts


def train(texts: list[str], labels: list[int], rounds: int = 400, rate: float = 0.1, l2: float = 5e-2,
          vocabulary: int = VOCABULARY, min_association: float = MIN_ASSOCIATION) -> Model:
    """Noisy-or logistic weights by full-batch Adam; deterministic. The noisy-or is the one that scores, with ``FLOOR``.

    Features are words and word beginnings that go with toxic documents beyond chance (G2 of ``min_association``)."""
    if len(set(labels)) < 2:
        return Model({}, -40.0)
    y = np.array(labels)
    seen: Counter = Counter()
    seen_toxic: Counter = Counter()
    for text, label in zip(texts, labels):
        own = {f for bag in sentence_bags(text) for f in bag}
        seen.update(own)
        if label:
            seen_toxic.update(own)
    names = sorted(seen)
    strength = association(np.array([seen_toxic[f] for f in names], float), np.array([seen[f] for f in names], float), int(y.sum()), len(y))
    kept = [names[i] for i in np.lexsort((np.arange(len(names)), -strength))[:vocabulary] if strength[i] >= min_association]
    number = {f: i for i, f in enumerate(kept)}
    document, hits = [], []
    for d, text in enumerate(texts):
        for bag in sentence_bags(text):
            hits += [(len(document), number[f], n) for f, n in Counter(f for f in bag if f in number).items()]
            document.append(d)
    if not document:
        return Model({}, -40.0)
    n_sentences, document = len(document), np.array(document)
    sentence, feature, times = (np.array(x, np.int64) for x in (zip(*hits) if hits else ((), (), ())))
    some = np.bincount(sentence, minlength=n_sentences) > 0
    sentence, document = (np.cumsum(some) - 1)[sentence], document[some]
    n_sentences = len(document)
    weights, bias = np.full(len(kept), 4.0), BIAS
    moments = np.zeros((2, len(kept) + 1))
    for step in range(1, rounds + 1):
        z = bias + np.bincount(sentence, weights=weights[feature] * times, minlength=n_sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        counts = counted_sentences(document, p, FLOOR)
        total = np.bincount(document, weights=np.where(counts, np.logaddexp(0, z), 0), minlength=len(y))
        outer = np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        dz = np.where(counts, p * outer[document], 0)
        grad = np.append(np.bincount(feature, weights=dz[sentence] * times, minlength=len(kept)) + l2 * weights, dz.sum() + l2 * (bias - BIAS))
        moments[0] += 0.1 * (grad - moments[0])
        moments[1] += 0.001 * (grad**2 - moments[1])
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return Model({f: float(x) for f, x in zip(kept, weights)}, float(bias), FLOOR)


class Scorer:
    """Scores texts; remembers the weight and the number of features of each distinct word of its task."""

    def __init__(self, model: Model):
        self.model, self.memo = model, Memo(self._weights, 2)

    def _weights(self, places: np.ndarray) -> np.ndarray:
        data, get = self.words.raw.tobytes(), self.model.weights.get
        spans = zip(self.words.starts[places].tolist(), self.words.ends[places].tolist())
        words = (data[s:e].decode("utf-8", "replace").lower() for s, e in spans)
        found = ([get(f) for f in word_features(w)] for w in words)
        return np.array([(sum(x for x in f if x is not None), sum(x is not None for x in f)) for f in found], np.float32).reshape(-1, 2)

    def score(self, texts: list[str | None], locate: float | None = None) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Probabilities; with ``locate``, also (start, end, p) in code points of sentences that reach it."""
        total, weak, spans = np.zeros(len(texts)), np.zeros(len(texts)), [[] for _ in texts]
        begun: dict[int, int] = {}
        for part in pieces(texts):
            owner, ahead = np.array([i for i, _ in part]), []
            for i, t in part:
                ahead.append(begun.get(i, 0))
                begun[i] = ahead[-1] + len(t)
            self.words, sentence = sentence_words([t for _, t in part])
            if len(sentence):
                at = self.memo(self.words.hashes())
                first = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
                weight, features = np.add.reduceat(self.memo.rows[at].astype(np.float64), first).T
                z = self.model.bias + weight
                if self.model.floor is not None:
                    z[features == 0] = -np.inf
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                which = self.words.which[first]
                own, share, counted = owner[which], np.logaddexp(0, z), p >= (self.model.floor or 0.0)
                total += np.bincount(own[counted], weights=share[counted], minlength=len(texts))
                np.maximum.at(weak, own[~counted], share[~counted])
                if locate is not None:
                    ends = np.flatnonzero(ENDS[self.words.raw])
                    for k in np.flatnonzero(p >= locate):
                        low = int(self.words.offsets[which[k]])
                        start = int(self.words.starts[first[k]])
                        end = int(ends[np.searchsorted(ends, start)])
                        raw, i = self.words.raw, int(owner[which[k]])
                        before = len(raw[low:start].tobytes().decode()) + ahead[int(which[k])]
                        spans[i].append((before, before + len(raw[start:end].tobytes().decode()), float(1 / (1 + np.exp(-z[k])))))
        return -np.expm1(-total - weak), spans


def fit(docs: DataFrame, labels: DataFrame, usable=None, limits: tuple[int, int] = (CLEAN_SAMPLE, TOXIC_SAMPLE)) -> Model:
    """Model from the labelled rows that ``usable`` (a condition on doc_id) allows."""
    usable = F.lit(True) if usable is None else usable
    rows = sample_labelled(docs, labels, "toxic", usable, limits).collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([r.text for r in rows], [r.label for r in rows])


def with_toxicity(docs: DataFrame, model: Model, locate: float | None = None, name: str = "__toxicity") -> DataFrame:
    """``docs`` with a column ``name``: struct of score and offending (start, end, p in code points of the text)."""

    @F.pandas_udf("score double, offending array<struct<start:int,end:int,p:double>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for batch in batches:
            scores, spans = scorer.score(batch.tolist(), locate)
            yield pd.DataFrame({"score": scores, "offending": [[{"start": a, "end": b, "p": p} for a, b, p in s] for s in spans]})

    return docs.withColumn(name, judge("text"))


def learnable():
    """Rows that may be learned from: crc32 of the id as text modulo 3 is not 1."""
    return crc32_mod("doc_id", 3) != 1


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, offending of every document."""
    model = fit(docs, labels, learnable())
    judged = with_toxicity(docs.select("doc_id", "text"), model, locate=0.5)
    return judged.select("doc_id", F.coalesce(crc32_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                         F.col("__toxicity.score").alias("score"),
                         (F.col("__toxicity.score") >= threshold).cast("int").alias("predicted"),
                         F.col("__toxicity.offending").alias("offending"))

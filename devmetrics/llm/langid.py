"""Language identification with interpolated Kneser-Ney character models.

One model per language over the characters of words: a word's letters and its end are predicted from the
``ORDER`` - 1 characters before them, where a word's beginning counts as blanks. The models share sorted arrays of
n-gram hashes, one per order; each n-gram has its discounted share as an event and its back-off weight as a context
for every language, so that one binary search serves all. A text gets the language of lowest cross-entropy per
character. Scores are posteriors at a temperature that was fitted on sampled documents the counts don't hold, and
so is the cross-entropy beyond which a text is marked ``rejected`` (unlike all that was learned).

The models are fitted on the driver on a bounded sample: at most ``PER_LANGUAGE`` documents of a language, those
first in the order of md5(doc_id). Scoring reads every whole text.

Defined cases: null text or no letter: ``und``, score 0; nothing to learn from: ``und`` everywhere; null lang or
null doc_id: not learned from; ties: the first language by code point; repeated rows are judged row by row; empty
table: empty result; other columns are not read.
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

ORDER = 5
PER_LANGUAGE = 400
HELD_BACK = 5  # every fifth sampled document is kept out of the counts, for the calibration
REJECT_QUANTILE = 0.999
_BASE = np.uint64(0x9E3779B97F4A7C15)


def letter_runs(word: str) -> list[str]:
    """Maximal runs of letters, lower-cased."""
    if word.isalpha():
        return [word]
    return "".join(c if c.isalpha() else " " for c in word).split()


def _grams(runs: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For n = 1..order the hash of the n characters up to each letter or word end; and the run of each place.

    Every run is padded with order - 1 blanks; grams of the blanks alone come as contexts of the first letter."""
    text = "".join(" " * (order - 1) + r + " " for r in runs)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(r) + order for r in runs], np.int64)
    run = np.repeat(np.arange(len(runs)), lengths)
    hashes, h = [], np.zeros(len(codes), np.uint64)
    for n in range(order):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[n:] = codes[:len(codes) - n] if n else codes
        h = h + shifted * _BASE**np.uint64(n + 1)
        hashes.append(h ^ (h >> np.uint64(29)))
    return hashes, run


@dataclass
class Model:
    languages: list[str]
    order: int
    keys: list[np.ndarray]  # per order: sorted hashes
    events: list[np.ndarray]  # per order: (hash, language) discounted share after its context
    backs: list[np.ndarray]  # per order: (hash, language) weight that the order below gets after it
    empty: np.ndarray  # weight of the uniform distribution, by language
    uniform: float
    temperature: float = 1.0
    reject_above: float = float("inf")

    def word_sums(self, words: list[str]) -> np.ndarray:
        """Per word: letters and ends predicted, then minus the log-probability by language."""
        split = [letter_runs(w) for w in words]
        runs = [r for s in split for r in s]
        out = np.zeros((len(words), 1 + len(self.languages)))
        if not runs:
            return out
        owner = np.repeat(np.arange(len(words)), [len(s) for s in split])
        hashes, run = _grams(runs, self.order)
        p = np.full((len(run), len(self.languages)), self.uniform)
        back = np.broadcast_to(self.empty, p.shape)
        for n in range(self.order):
            at = np.minimum(np.searchsorted(self.keys[n], hashes[n]), len(self.keys[n]) - 1)
            known = (self.keys[n][at] == hashes[n])[:, None]
            p = np.where(known, self.events[n][at], 0.0) + back * p
            below = np.where(known, self.backs[n][at], 1.0)
            back = np.ones_like(below)
            back[1:] = below[:-1]
        places = np.concatenate([[0], np.cumsum([len(r) + self.order for r in runs])])
        real = np.arange(len(run)) - places[run] >= self.order - 1
        values = np.column_stack([np.ones(len(run)), -np.log(np.maximum(p, 1e-30))])[real]
        which = owner[run[real]]
        for c in range(out.shape[1]):
            out[:, c] = np.bincount(which, weights=values[:, c], minlength=len(words))
        return out


def train(counts: dict[str, Counter], order: int = ORDER) -> Model:
    """Interpolated Kneser-Ney from words with their frequencies, by language."""
    languages = sorted(counts)
    tables: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []  # language, order: gram, context, count
    letters = set()
    for lang in languages:
        words = sorted(counts[lang])
        letters.update(c for w in words for c in w)
        weight = np.array([counts[lang][w] for w in words], np.float64)
        hashes, run = _grams(words, order)
        places = np.concatenate([[0], np.cumsum([len(w) + order for w in words])])
        real = np.arange(len(run)) - places[run] >= order - 1
        own: list = [None] * order
        at = np.flatnonzero(real)
        top, first, again = np.unique(hashes[order - 1][at], return_index=True, return_inverse=True)
        count = np.bincount(again, weights=weight[run[at]])
        for n in range(order - 1, -1, -1):
            place = at[first]
            context = hashes[n - 1][place - 1] if n else np.zeros(len(place), np.uint64)
            own[n] = (hashes[n][place], context, count)
            if n:  # a lower order counts the distinct grams one longer
                at = place
                _, first, again = np.unique(hashes[n - 1][at], return_index=True, return_inverse=True)
                count = np.bincount(again).astype(np.float64)
        tables.append(own)
    keys = []
    for n in range(order):
        grams = [t[n][0] for t in tables] + ([t[n + 1][1] for t in tables] if n + 1 < order else [])
        keys.append(np.unique(np.concatenate(grams)))
    events = [np.zeros((len(k), len(languages))) for k in keys]
    backs = [np.ones((len(k), len(languages))) for k in keys]
    empty = np.ones(len(languages))
    for j, own in enumerate(tables):
        for n, (gram, context, count) in enumerate(own):
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            _, again = np.unique(context, return_inverse=True)
            total = np.bincount(again, weights=count)
            rest = discount * np.bincount(again) / total
            events[n][np.searchsorted(keys[n], gram), j] = (count - discount) / total[again]
            if n:
                backs[n - 1][np.searchsorted(keys[n - 1], context), j] = rest[again]
            else:
                empty[j] = rest[0]
    return Model(languages, order, keys, events, backs, empty, 1 / (len(letters) + 2))


class Identifier:
    """Judges texts; remembers the sums of each distinct word of its task."""

    def __init__(self, model: Model):
        self.model, self.memo = model, Memo(self._sums, 1 + len(model.languages))

    def _sums(self, places: np.ndarray) -> np.ndarray:
        data = self.words.raw.tobytes()
        spans = zip(self.words.starts[places].tolist(), self.words.ends[places].tolist())
        words = [data[s:e].decode("utf-8", "replace").lower() for s, e in spans]
        out = np.empty((len(words), 1 + len(self.model.languages)))
        for at in range(0, len(words), 8192):
            out[at:at + 8192] = self.model.word_sums(words[at:at + 8192])
        return out

    def sums(self, texts: list[str | None]) -> np.ndarray:
        """Per text: characters predicted and minus log-probability by language."""
        out = np.zeros((len(texts), 1 + len(self.model.languages)))
        for part in pieces(texts):
            owner = np.array([i for i, _ in part])
            self.words = ByteWords([t for _, t in part])
            if not len(self.words.starts):
                continue
            rows = self.memo(self.words.hashes())
            which = owner[self.words.which]
            for c in range(out.shape[1]):
                out[:, c] += np.bincount(which, weights=self.memo.rows[rows, c], minlength=len(texts))
        return out

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        model = self.model
        if not model.languages:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0, "cross_entropy": np.nan, "rejected": True})
        sums = self.sums(texts)
        n = sums[:, 0]
        entropy = sums[:, 1:] / np.maximum(n, 1)[:, None]
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(n)), best]
        odds = np.exp(-np.minimum((entropy - low[:, None]) * np.sqrt(np.maximum(n, 1))[:, None] / model.temperature, 700))
        said = n > 0
        return pd.DataFrame({
            "lang_pred": np.where(said, np.array(model.languages, object)[best], "und"),
            "score": np.where(said, 1 / odds.sum(axis=1), 0.0),
            "cross_entropy": np.where(said, low, np.nan),
            "rejected": ~said | (low > model.reject_above)})


def calibrate(model: Model, texts: list[str], langs: list[str]) -> Model:
    """Temperature of least log-loss on held-back documents, and the rejection bound from their own entropies."""
    number = {lang: i for i, lang in enumerate(model.languages)}
    sums = Identifier(model).sums(texts)
    use = np.flatnonzero(sums[:, 0] > 0)
    if not len(use):
        return model
    truth, n = np.array([number[langs[i]] for i in use]), sums[use, 0]
    entropy = sums[use, 1:] / n[:, None]
    gap = (entropy - entropy.min(axis=1, keepdims=True)) * np.sqrt(n)[:, None]

    def loss(t: float) -> float:
        odds = np.exp(-np.minimum(gap / t, 700))
        return float(-np.log(np.maximum((odds / odds.sum(axis=1, keepdims=True))[np.arange(len(use)), truth], 1e-12)).mean())

    temperatures = np.geomspace(0.02, 20, 40)
    losses = np.array([loss(t) for t in temperatures])
    model.temperature = float(temperatures[losses <= losses.min() + 1e-3].max())
    spread = entropy[np.arange(len(use)), truth]
    model.reject_above = float(np.quantile(spread, REJECT_QUANTILE) + 3 * spread.std())
    return model


def fit_texts(rows: list[tuple[str, str]], order: int = ORDER, held_back: int = HELD_BACK) -> Model:
    """Model of (lang, text) rows in a fixed order."""
    place: Counter = Counter()
    counts: dict[str, Counter] = {}
    kept: list[tuple[str, str]] = []
    for lang, text in rows:
        place[lang] += 1
        if place[lang] % held_back == 0:
            kept.append((lang, text))
            continue
        own = counts.setdefault(lang, Counter())
        own.update(r for w in (text or "").lower().split() for r in letter_runs(w))
    counts = {lang: c for lang, c in counts.items() if c}
    if not counts:
        return Model([], order, [], [], [], np.ones(0), 1.0)
    model = train(counts, order)
    kept = [(lang, text) for lang, text in (kept or rows) if lang in counts]
    return calibrate(model, [t for _, t in kept], [lang for lang, _ in kept])


def learnable():
    """Rows that may be learned from: crc32 of the id as text modulo 4 is not 2."""
    return crc32_mod("doc_id", 4) != 2


def fit(docs: DataFrame, usable=None, per_language: int = PER_LANGUAGE) -> Model:
    usable = F.lit(True) if usable is None else usable
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).where(usable)
    ids = rows.select("lang", "doc_id").distinct()
    chosen = bounded_sample(ids, "lang", F.lit(per_language), per_language)
    picked = rows.select("lang", "doc_id", "text").join(F.broadcast(chosen), ["lang", "doc_id"])
    found = picked.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).collect()
    found.sort(key=lambda r: (r.lang, r.doc_id))
    return fit_texts([(r.lang, r.text) for r in found])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``__lang``: struct of lang_pred, score, cross_entropy, rejected."""

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(model)
        for batch in batches:
            yield identifier.judge(batch.tolist())

    return docs.withColumn("__lang", judge("text"))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected of every document."""
    model = fit(docs, learnable())
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "__lang.*"))

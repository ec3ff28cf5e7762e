"""Quality rules with a hashed n-gram log-likelihood ratio (DataFrame operations only).

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets. Two multinomials are counted over the
buckets: that of the raw corpus, from every document, and that of a trusted target, from every document labelled as
good whose id falls in one of two hash folds. A document's score is the sum of log(p_target / p_raw) over its n-grams,
divided by their number. A document is kept if its score reaches the threshold: a low quantile, less a margin, of the
scores of all trusted documents of the other fold, which the counts don't hold. The quantile is exact and no document is
drawn at random, so the threshold doesn't depend on how rows are dealt out. The base rules (too short, repetitive) come
first.

Defined cases: null, empty or blank text: no words, all counts 0, base_failed; without trusted documents the ratio
is 0 everywhere and only the base rules decide; several labels for an id: good if any says so; null ids or labels:
not trusted; repeated rows are judged row by row and each counts for the corpus; scores that tie with the threshold are
kept; very long texts are read whole, by one task, as arrays of their words' hashes; empty table: empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.secrets import let
from devmetrics.session import materialize

BUCKETS = 1 << 15
#: Weight of the raw distribution in the target's, in n-grams.
SHRINK = 20_000.0
QUANTILE, MARGIN = 0.005, 0.05

#: The white space between words, and the symbols that are counted.
SPACES = (" ", "\t", "\n", "\x0b", "\f", "\r")
SYMBOLS = "#*$%&|<>"


def spaced(text: Column) -> Column:
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words(text: Column) -> Column:
    return F.array_remove(F.split(spaced(text), " "), "")


def ngram_buckets(hashes: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and pairs, from the words' hashes (an array used more than once: bind it first)."""
    pairs = F.zip_with(F.slice(hashes, F.lit(1), F.size(hashes) - 1), F.slice(hashes, F.lit(2), F.size(hashes)),
                       lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    return F.when(F.size(hashes) > 1, F.concat(single, pairs)).otherwise(single)


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def repeated_words(hashes: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    Windows are told apart by their 64-bit hash. Only where some repeat, they are sorted with their places and compared
    with their neighbours. What is sorted is one number, the hash with its low bits replaced by the place (as many as
    the text needs); where two different hashes agree in the bits that are left, pairs of hash and place are sorted."""

    def covered(windows: Column) -> Column:
        bits = F.ceil(F.log2(F.size(windows) + F.lit(2.0))).cast("int")
        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))

        def with_bits(k: Column) -> Column:
            packed = F.transform(windows, lambda h, i: F.call_function("shiftleft", F.call_function("shiftright", h, k), k).bitwiseOR(i.cast("long")))
            high = lambda x: F.call_function("shiftright", x, k)
            low = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1)
            whole = lambda x: F.get(windows, low(x).cast("int"))
            mixed = lambda s: F.exists(neighbours(s, lambda a, b: (high(a) == high(b)) & (whole(a) != whole(b))), lambda e: e)
            by_pair = let(F.sort_array(pairs), lambda s: count(places(s, lambda x: x["h"], lambda x: x["i"])))
            return let(F.sort_array(packed), lambda s: F.when(mixed(s), by_pair).otherwise(count(places(s, high, low))))

        return let(bits, with_bits)

    def neighbours(s: Column, test: Callable[[Column, Column], Column]) -> Column:
        return F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s)), test)

    def places(s: Column, key: Callable[[Column], Column], place: Callable[[Column], Column]) -> Column:
        """In order, the places of windows that equal the one before or the one after them."""
        same = neighbours(s, lambda a, b: key(a) == key(b))
        none = F.array(F.lit(False))
        either = F.zip_with(F.concat(none, same), F.concat(same, none), lambda a, b: a | b)
        return F.sort_array(F.filter(F.zip_with(s, either, lambda x, e: F.when(e, place(x))), lambda p: p.isNotNull()))

    def count(found: Column) -> Column:
        """Words that windows of three at these places cover."""
        step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n"), p.alias("last"))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
        return F.aggregate(found, start, step)["n"]

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered(windows)).otherwise(F.lit(0).cast("long"))

    pairs = F.zip_with(F.slice(hashes, F.lit(1), F.size(hashes) - 2), F.slice(hashes, F.lit(2), F.size(hashes) - 2), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    windows = F.zip_with(pairs, F.slice(hashes, F.lit(3), F.size(hashes)), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    return F.when(F.size(hashes) > 2, let(windows, of_windows)).otherwise(F.lit(0).cast("long"))


def base_columns(text: Column, hashes: Column) -> dict[str, Column]:
    plain = text
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    trimmed = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit("".join(SPACES))) != "")
    return {
        "n_words": F.size(hashes).cast("long"),
        "word_chars": F.length(F.replace(spaced(text), F.lit(" "), F.lit(""))).cast("long"),
        "n_symbols": (F.length(text) - F.length(plain)).cast("long"),
        "n_dup_lines": let(trimmed, lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")),
        "n_repeat_words": repeated_words(hashes),
    }


def counts_for_target(doc_id: Column) -> Column:
    """Whether a trusted document of this id makes the target; the others are held back for the threshold."""
    return F.xxhash64(doc_id) % 2 == 0


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, counted) of all documents labelled as good; ``counted``: ``counts_for_target``."""
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q")).where(F.col("q") > 0)
    return good.select("doc_id", counts_for_target(F.col("doc_id")).alias("counted"))


def target_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The texts that make the target. The documents are cut to the fold before they meet the ids, and both sides are
    dealt out by id whatever their size (a broadcast of ids would grow with the labels): half the texts move once."""
    rows = docs.where(counts_for_target(F.col("doc_id"))).select("doc_id", "text")
    return rows.join(trusted.where("counted").select("doc_id").hint("merge"), "doc_id").select("text")


def bucket_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, shrink: float = SHRINK) -> DataFrame:
    """(bucket, weight), with the documents of the ids ``trusted`` as the target; see ``log_ratios``."""
    return log_ratios(docs, docs.select("doc_id", "text").join(trusted.select("doc_id"), "doc_id"), buckets, shrink)


def log_ratios(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, shrink: float = SHRINK) -> DataFrame:
    """(bucket, weight): log-ratio of the share that the bucket has in ``target`` (some rows of ``docs``) to the raw
    corpus's. At most ``buckets`` rows.

    Counts are combined before the shuffle, so a task never gets more than one row per bucket and task."""
    grams = lambda rows, raw: rows.select(
        F.explode(let(word_hashes(F.col("text")), lambda h: ngram_buckets(h, buckets))).alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("n")).select("bucket", *((F.col("n") if own == raw else F.lit(0).cast("long")).alias(own) for own in ("raw", "target")))
    counts = grams(docs, "raw").unionByName(grams(target, "target")).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counts = materialize(counts, "quality-counts")
    n_raw, n_target = (float(x or 0) for x in counts.agg(F.sum("raw"), F.sum("target")).first())
    p_raw = F.col("raw") / n_raw if n_raw else F.lit(1.0)
    p_target = (F.col("target") + shrink * p_raw) / (n_target + shrink)
    return counts.select("bucket", F.log(p_target / p_raw).alias("weight"))


def weight_list(weights: DataFrame, buckets: int = BUCKETS) -> Column:
    """The weights as one array by bucket: a constant of bounded size that each task gets with its plan."""
    every = weights.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(weights, "bucket", "left").select("bucket", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    rows = dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "weight"))), lambda s: F.round(s["weight"], 6)).alias("w"))
    return F.from_json(F.lit(rows.select(F.to_json("w")).first()[0]), "array<double>")


def score_column(hashes: Column, weights: Column, buckets: int = BUCKETS) -> Column:
    """Mean weight of the n-grams; 0 without words."""
    grams = ngram_buckets(hashes, buckets)
    total = lambda g: F.aggregate(g, F.lit(0.0), lambda acc, b: acc + F.get(weights, b)) / F.size(g)
    return let(grams, lambda g: F.when(F.size(g) > 0, total(g)).otherwise(F.lit(0.0)))


def exact_quantile(values: DataFrame, quantile: float) -> float | None:
    """Of a column ``score``, the value of rank ceil(quantile * rows) (from 1), in ten-thousandths rounded down; null
    without rows.

    Rows are counted, first by tenths, then by ten-thousandths within the tenth that holds the rank: the driver gets a
    row for each tenth between the least and the largest score (mean log-ratios, tens at most), and a thousand."""
    places = values.where(F.col("score").isNotNull()).select(F.floor(F.col("score") * 10_000).cast("long").alias("v"))

    def counted(rows: DataFrame, by: Column) -> list[tuple[int, int]]:
        return sorted((r[0], r[1]) for r in rows.groupBy(by.alias("b")).agg(F.count("*").alias("n")).collect())

    tenths = counted(places, F.floor(F.col("v") / 1000).cast("long"))
    rank = max(1, math.ceil(quantile * sum(n for _, n in tenths)))
    for tenth, n in tenths:
        if rank <= n:
            break
        rank -= n
    else:
        return None
    for value, n in counted(places.where(F.floor(F.col("v") / 1000) == tenth), F.col("v")):
        if rank <= n:
            return value / 10_000
        rank -= n
    raise AssertionError("the scores changed between two passes")


def judge_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score per document.

    Every text is scored once; the threshold comes from the scores of the held-back ids, which are written, without
    their texts."""
    trusted = materialize(trusted_ids(labels), "quality-trusted")
    weights = weight_list(log_ratios(docs, target_texts(docs, trusted)))
    whole = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", let(word_hashes(whole), lambda h: F.struct(
        *(c.alias(n) for n, c in base_columns(whole, h).items()), score_column(h, weights).alias("score"))).alias("f")).select("doc_id", "f.*")
    found = materialize(found, "quality-scores")
    held = found.where(~counts_for_target(F.col("doc_id"))).select("doc_id", "score")
    low = exact_quantile(held.join(trusted.where("not counted").hint("merge"), "doc_id"), quantile)
    threshold = -1e9 if low is None else low - margin
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                        (~failed & (F.col("score") >= threshold)).alias("kept"), "score")

"""Mixing sources to target weights by capped water-filling (DataFrame operations only).

Every source wants ``share * all words * weight / sum of weights`` words. A source can give ``max_epochs`` times its
own words at most: sources above that are clamped, and what they can't give is shared out again among the others in
proportion to their weights, until none is above. A source then takes whole repetitions of all its documents and,
of a last partial repetition, the documents that come first in a seeded order, up to its target.

Defined cases: null source: a source of its own; null or blank text: size 0, takes 0 words, is kept in the table, and is
never in a partial repetition; rows that repeat an (id, text) pair share a place in the seeded order and are taken or
left together, which is also how ties in that order go; very long texts are counted whole, a text never being split;
empty table: empty result; extra columns, whatever their names, pass through ``mixed_documents`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devmetrics.llm.common import WORD, free_names, numbered, quoted
from devmetrics.session import materialize


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sample_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Place of a document in the seeded order: 32 hexadecimal digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(text, F.lit(""))))


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """(source, source_size) with ``weight``: the cycle's values in code point order of the sources, null last."""
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], name="mix-sources")
    weight = F.element_at(F.array(*map(F.lit, cycle)), (F.col("__rank") % len(cycle) + 1).cast("int"))
    return ranked.withColumn("weight", weight.cast("long")).drop("__rank", "__before")


def water_fill(sources: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight).

    The level (words per unit of weight) rises from round to round; a round is one aggregate over the sources of
    which a single row reaches the driver. It ends when no further source is clamped; every round but the last
    clamps at least one, and rounds are few as each raises the level for all."""
    cap = F.col("source_size") * max_epochs
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level, clamped = (wanted / weight if weight else 0.0), -1
    while True:
        above = F.lit(level) * F.col("weight") > cap
        n, given, free = sources.agg(F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == clamped or not free:
            break
        level, clamped = (wanted - (given or 0)) / free, n
    level = F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.when(level > cap, cap.cast("double")).otherwise(level))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds to targets ``whole`` (full repetitions) and ``last_key``: documents up to it are taken once more.

    Sizes are summed per source and per first four digits of the key (65,536 rows a source at most), which finds
    the digits where the partial repetition ends; only the documents with these digits are then put in order."""
    targets = targets.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("__part", F.col("target") - F.col("whole") * F.col("source_size"))
    prefix = F.substring("key", 1, 4)
    by_prefix = sized.groupBy("source", prefix.alias("__p")).agg(F.sum("size").alias("__s"))
    upto = Window.partitionBy("source").orderBy("__p").rowsBetween(Window.unboundedPreceding, 0)
    by_prefix = by_prefix.withColumn("__upto", F.sum("__s").over(upto))
    t = targets.select(F.col("source").alias("__source"), "__part")
    cut = (by_prefix.join(t, F.col("source").eqNullSafe(F.col("__source"))).where(F.col("__upto") > F.col("__part"))
           .groupBy("source").agg(F.min(F.struct("__p", (F.col("__upto") - F.col("__s")).alias("__base"), "__part")).alias("__c"))
           .select(F.col("source").alias("__source"), "__c.*"))
    near = (sized.join(cut, F.col("source").eqNullSafe(F.col("__source")) & (prefix == F.col("__p")))
            .groupBy("source", "key").agg(F.sum("size").alias("__s"), F.first("__base").alias("__base"), F.first("__part").alias("__part")))
    upto = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("__base") + F.sum("__s").over(upto) - F.col("__s") / 2
    last = (near.withColumn("__m", middle).where(F.col("__m") <= F.col("__part"))
            .groupBy("source").agg(F.max("key").alias("__k")).select(F.col("source").alias("__s2"), "__k"))
    cut = cut.select("__source", "__p").join(last, F.col("__source").eqNullSafe(F.col("__s2")), "left")
    cut = cut.select("__source", F.coalesce("__k", "__p").alias("last_key"))
    return (targets.join(cut, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source", "__part")
            .withColumn("last_key", F.coalesce("last_key", F.lit(""))))


def plan_mix(docs: DataFrame, cycle: tuple[int, ...], share: float, max_epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The documents' (doc_id, source, size, key) and the plan per source, both as written tables."""
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                    sample_key(F.col("doc_id"), F.col("text"), seed).alias("key")), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_fill(materialize(cycled_weights(sources, cycle), "mix-weights"), share, max_epochs)
    return sized, materialize(thresholds(sized, targets), "mix-plan")


def repetitions(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with source, size and key, with the plan's columns and ``repeats``: how often the mix takes the document.
    One without words adds nothing to the partial repetition, and is taken as often as the whole ones."""
    plan = plan.withColumnRenamed("source", "__source")
    once_more = ((F.col("key") <= F.col("last_key")) & (F.col("size") > 0)).cast("long")
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
            .withColumn("repeats", F.col("whole") + once_more))


def mix_sources(docs: DataFrame, cycle: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2,
                seed: int = 13) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, weight, target, repeats, taken."""
    sized, plan = plan_mix(docs, cycle, share, max_epochs, seed)
    return (repetitions(sized, plan).withColumn("taken", F.col("repeats") * F.col("size"))
            .select("doc_id", "source", "size", "source_size", "weight", "target", "repeats", "taken"))


def mixed_documents(docs: DataFrame, cycle: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2,
                    seed: int = 13) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``, whatever their names."""
    _, plan = plan_mix(docs, cycle, share, max_epochs, seed)
    source, whole, last, copy = free_names(docs, "source", "whole", "last", "copy")
    plan = plan.select(F.col("source").alias(source), F.col("whole").alias(whole), F.col("last_key").alias(last))
    more = (sample_key(F.col("doc_id"), F.col("text"), seed) <= F.col(last)) & (word_count(F.col("text")) > 0)
    return (docs.join(plan, F.col("source").eqNullSafe(F.col(source)))
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(whole) + F.lit(1))))
            .where((F.col(copy) <= F.col(whole)) | more)
            .select(*map(quoted, docs.columns)))


def oracle_sql(share: float = 1.5, max_epochs: int = 2, seed: int = 13) -> str:
    """The same mix in SQL; the level by the sorted ratios of cap to weight instead of rounds (weights 3, 1, 2)."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(concat('{seed}:', coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, {max_epochs} * source_size AS cap,
         coalesce(sum({max_epochs} * source_size) OVER earlier, 0)::BIGINT AS caps,
         sum(w) OVER ()::BIGINT - coalesce(sum(w) OVER earlier, 0)::BIGINT AS free,
         {share} * sum(source_size) OVER ()::BIGINT AS wanted
  FROM sources WINDOW earlier AS (ORDER BY {max_epochs} * source_size / w, source NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT min_by((wanted - caps) / free, caps) AS lvl FROM ordered WHERE (wanted - caps) / free * w <= cap),
targets AS (
  SELECT source, source_size, w,
         CASE WHEN lvl IS NULL OR lvl * w > cap THEN cap::DOUBLE ELSE lvl * w END AS target
  FROM ordered CROSS JOIN level),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
keys AS (SELECT source, key, sum(size) AS g FROM sized GROUP BY ALL),
places AS (SELECT *, sum(g) OVER (PARTITION BY source ORDER BY key) - g / 2 AS middle FROM keys),
last AS (
  SELECT p.source, max(key) AS last_key FROM places p JOIN parts t ON p.source IS NOT DISTINCT FROM t.source
  WHERE middle <= target - whole * source_size GROUP BY p.source)
SELECT s.doc_id, s.size, t.source_size, t.target,
       s.size * (t.whole + CASE WHEN s.key <= coalesce(l.last_key, '') THEN 1 ELSE 0 END) AS taken
FROM sized s JOIN parts t ON s.source IS NOT DISTINCT FROM t.source
LEFT JOIN last l ON s.source IS NOT DISTINCT FROM l.source"""

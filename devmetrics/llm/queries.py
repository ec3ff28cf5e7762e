"""The registered queries: one per operator, with its production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from devmetrics.llm import ann, langid, mixing, quality, resampling, secrets, sentence_pieces, simhash, token_files, toxicity, url_filter, warc, whitening
from devmetrics.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.usable(table(spark, sf_dir, "embeddings"))
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_nearest": op2_nearest,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality": op4_quality,
    "op5_token_files": op5_token_files,
    "op6_secrets": op6_secrets,
    "op7_simhash": op7_simhash,
    "op8_sentence_pieces": op8_sentence_pieces,
    "op9_language_id": op9_language_id,
    "op10_url_filter": op10_url_filter,
    "op11_warc": op11_warc,
    "op12_whitening": op12_whitening,
    "op13_resampling": op13_resampling,
}

ORACLE = {
    "op3_mix_sources": mixing.oracle_sql(),
    "op6_secrets": secrets.oracle_sql(),
    "op10_url_filter": url_filter.oracle_sql(),
    "op11_warc": warc.oracle_sql(),
}

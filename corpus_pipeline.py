"""Corpus pipeline over ``documents``: five stages, each over all that the one before it kept.

1. toxicity: documents that the classifier rejects go (score of 0.7 or more); the rest stays as it is.
2. SimHash near-dedup: of each group of near copies the document with the least doc_id stays.
3. secret scans: every span found is masked in the text; n_chars follows the new text; no document goes.
4. mixing: every document as often as the mix takes it (not at all, once or twice).
5. SentencePiece: the sampled piece ids of every text, with a check that decoding gives the text back.

A stage is called with the rows that the stage before it wrote; all but the last return the columns of documents.
Nulls, empty texts, repeated rows and empty tables are handled as the operators' modules say; extra columns may have
any names (stage columns take names that are free).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.llm import mixing, secrets, sentence_pieces, simhash, toxicity
from devmetrics.llm.common import free_names, quoted, ship_package, table
from devmetrics.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.learnable())
    name = free_names(docs, "toxicity")[0]
    judged = toxicity.with_toxicity(docs, model, name=name)
    return judged.where(F.col(name)["score"] < toxicity.THRESHOLD).select(*map(quoted, docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship_package(spark)
    # the encoder names columns of its own and takes names as they are written
    odd = [c for c in docs.columns if "." in c or "`" in c or c.lower() in ("__text", "__key")]
    plain = dict(zip(odd, free_names(docs, *[f"column{i}" for i in range(len(odd))])))
    encoded = sentence_pieces.encode_documents(docs.withColumnsRenamed(plain), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.withColumnsRenamed({v: k for k, v in plain.items()})


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("secret scan", mask_secrets),
    ("mixing", mix),
    ("sentence pieces", encode),
]

#: A trained model, XXH64 fingerprints, sampled segmentations: SQL has no form for these stages. The tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs

"""The corpus pipeline: documents filtered, deduplicated, cleaned of secrets, mixed
and encoded.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that applies one
operator to all documents its predecessor kept.  All but the last return the columns
of ``documents``; the last returns the piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keytally.llm import quality_cnn, secrets, sentencepiece_codec, simhash_dedup, source_mix
from keytally.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the labelled rows."""
    return quality_cnn.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id."""
    return simhash_dedup.keep_one_per_group(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return source_mix.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's piece ids."""
    return sentencepiece_codec.encode(docs.select("doc_id", "source", "text")).drop("text")


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("secret scans", secrets_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece encoding", encoding_stage),
]

#: The classifier, the fingerprints and the encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs

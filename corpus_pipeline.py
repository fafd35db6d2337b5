"""The corpus pipeline: raw documents to packed sequences, one stage after the other.

Every stage takes and returns whole tables of documents (the last returns the packed pieces); its
result is written as Parquet and read again by the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from affinia.llm import decontaminate, packing, pii, quality, simhash
from affinia.llm.common import stage, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"]).select(
        "row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_redaction", pii_redaction),
    ("sequence_packing", sequence_packing),
]

# Fitted models, connected components and token ids are beyond SQL; the tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs

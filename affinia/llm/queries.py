"""The registered queries of the operators: each applies one, with its production parameters, to its
whole table, and derives the digest columns from the operator's output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.llm import (
    ann, clustering, decontaminate, filter_audit, licenses, oracles, packing, pii, quality, sharding, simhash,
    substrings, toxicity, warc,
)
from affinia.llm.common import fresh_folder, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def _judged(scored: DataFrame, score, modulus: int, rest: int, threshold: float) -> DataFrame:
    return scored.select(
        "row.doc_id", quality.held_out(F.col("row.doc_id"), modulus, rest).alias("held_out"),
        score.alias("score"), (score >= threshold).cast("int").alias("predicted"),
    )


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    model = quality.train(docs, table(spark, sf, "labels"))
    return _judged(quality.scored(docs, model, ["doc_id"]), F.col("score"), 4, 2, quality.THRESHOLD)


def _nearest(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"))


def _decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(_documents(spark, sf), table(spark, sf, "benchmark"), ["doc_id"])
    hit = decontaminate.covered(F.col("result.hits"))
    return found.select(
        "row.doc_id", "result.n_words", hit.alias("n_hit"),
        F.size("result.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("result.items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    warc.write(table(spark, sf, "pages"), folder)
    return warc.read(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return _judged(toxicity.scored(docs, model, ["doc_id"]), F.col("result.score"), 3, 1, toxicity.THRESHOLD)


def _pack(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_documents(spark, sf), VOCABULARY, ["doc_id"]).select(
        "row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def _substrings(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(_documents(spark, sf), ["doc_id"]).select(
        "row.doc_id", "result.n_words", "result.n_removed",
        F.sha2(F.col("result.kept").cast("binary"), 256).alias("kept_sha256"),
    )


def _pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(_documents(spark, sf), ["doc_id"], redact=False)

    def count(kind: str):
        return F.size(F.filter("result.base", lambda s: s.startswith(f"{kind}:"))).cast("long")

    return found.select(
        "row.doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(F.array_join("result.base", ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join("result.spans", ",").alias("spans"),
    )


def _licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf), ["doc_id"]).select(
        "row.doc_id", F.size("result.sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("result.sentence_ids", ",").alias("sentences"),
        F.array_join("result.licences", ",").alias("licences"),
    )


def _cluster(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.cluster(table(spark, sf, "embeddings"))


def _shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign(_documents(spark, sf), carry=["doc_id"]).select(
        "row.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


QUERIES = {
    "op1_quality_rules": _quality,
    "op2_collision_counting": _nearest,
    "op3_decontamination": _decontaminate,
    "op4_simhash": _simhash,
    "op5_warc": _warc,
    "op6_toxicity": _toxicity,
    "op7_packing": _pack,
    "op8_substring_dedup": _substrings,
    "op9_pii": _pii,
    "op10_licenses": _licenses,
    "op11_centroid_clustering": _cluster,
    "op12_feistel_shards": _shards,
    "op13_filter_audit": _audit,
}

ORACLES = {
    "op3_decontamination": oracles.DECONTAMINATION,
    "op5_warc": oracles.WARC,
    "op8_substring_dedup": oracles.SUBSTRINGS,
    "op11_centroid_clustering": oracles.CLUSTERING,
    "op12_feistel_shards": oracles.SHARDING,
    "op13_filter_audit": oracles.FILTER_AUDIT,
}

"""The operators as queries over whole tables, with the digest columns of their contracts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    fingerprint,
    langid,
    licenses,
    merkle,
    near_dedup,
    packing,
    quality,
    secrets,
    sharding,
    toxicity,
    trie,
    votes,
    warc,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(documents(spark, sf_dir), ranks)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scored(documents(spark, sf_dir), labels)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir), linking=secrets.PAIRS)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(documents(spark, sf_dir))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.simhash_groups(documents(spark, sf_dir), shingle=3, radius=2)
    return groups.withColumn("fingerprint", votes.as_hex("fingerprint"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(
        documents(spark, sf_dir), vocabulary, capacity=2048, end_id=0, special=True,
        batch_bytes=32_000_000,
    )


def op11_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.round_trip(pages).drop("segments", "problem")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_language_id": op5_language_id,
    "op6_sharding": op6_sharding,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_license_scan": op8_license_scan,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_warc_archives": op11_warc_archives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_trie": op13_conversation_trie,
}

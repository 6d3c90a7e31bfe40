"""The corpus pipeline: documents through five of the operators, each stage a table.

Quality rules and toxicity drop documents, near-dedup keeps one document of each
group, the secret scan replaces what it finds, and packing turns the rest into
token sequences.  Each stage works on all that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import near_dedup, packing, quality, secrets, toxicity
from tallymart.sources.shared import forget, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.7; learned from the labels of what is left."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group linked at 2 or fewer bits."""
    return near_dedup.keep_one_each(docs, shingle=3, radius=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind."""
    return secrets.redacted(docs, linking=secrets.PAIRS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a sequence of at most 2048 tokens."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    # Small batches: earlier stages leave their executors' heaps grown.
    return packing.pack(
        docs, vocabulary, capacity=2048, end_id=0, special=True, batch_bytes=2_500_000
    )


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("near-dedup", near_copies),
    ("secret scan", secret_scan),
    ("packing", best_fit_packing),
]

# Models, hashes and token ids are beyond SQL; tests/llm/test_pipeline.py holds
# each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and read again.

    A stage's table is deleted when the next one is written.  Extra columns of documents
    go through all stages but the last, repeated rows end at the near-dedup, null and empty
    texts at the quality rules, and no documents give no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        before, docs = docs, store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        forget(before)
    return last(spark, docs, sf_dir)

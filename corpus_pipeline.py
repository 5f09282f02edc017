"""Clean a corpus: rules, exact copies, near copies, secrets, packing.

Defined results: documents with null or empty texts fail the rules and go; very long
texts are handled whole; of exact copies the one with most code points stays, then the
smallest doc_id (null last), of near copies the smallest doc_id; rows that agree in
doc_id and text are one document; other columns, whatever their names, pass all stages
but the last; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from scorecard.llm import exact_dedup, packing, quality_rules, secret_scan, simhash
from scorecard.llm.common import prepare
from scorecard.operators.staging import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    prepare(spark)
    return quality_rules.filter_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return simhash.deduplicate(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in them replaced."""
    prepare(spark)
    return secret_scan.redact(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("secret scans", secret_stage),
    ("best-fit packing", packing_stage),
]

# Hashing, fingerprints and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written and read again."""
    folder = f"{shared_dir(spark)}/corpus-pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

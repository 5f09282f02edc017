"""The operators of this folder as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from scorecard.llm import (
    classifier,
    exact_dedup,
    length_packing,
    packing,
    quality_rules,
    revisits,
    role_repair,
    secret_scan,
    simhash,
    superkmers,
    token_files,
    trie_bpe,
    turn_trie,
)
from scorecard.llm.common import prepare

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/documents.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, folder), BYTE_RANKS)


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    files = token_files.write_files(docs, token_files.new_folder(docs), BYTE_TOKENIZER)
    return token_files.read_files(files)


def op3_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, folder)).select(
        "doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id"
    )


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, folder)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return superkmers.remove_repeats(_documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    labels = prepare(spark).read.parquet(f"{folder}/labels.parquet")
    return classifier.classify(_documents(spark, folder), labels)


def op7_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    pages = prepare(spark).read.parquet(f"{folder}/pages.parquet")
    found = revisits.resolve(revisits.captures_of_pages(pages))
    return found.select(
        "record_id",
        "url_key",
        "refers_to",
        "outcome",
        F.sha2(revisits.listed(F.col("headers")), 256).alias("headers_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, folder)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), WORD_TOKENIZER)


def op10_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return trie_bpe.digests(_documents(spark, folder), BYTE_TOKENIZER)


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_trie.rebuilt_trie(prepare(spark).read.parquet(f"{folder}/conversations.parquet"))


def op12_length_packing(spark: SparkSession, folder: str) -> DataFrame:
    return length_packing.pack(_documents(spark, folder), WORD_TOKENIZER)


def op13_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = prepare(spark).read.parquet(f"{folder}/conversations.parquet")
    return role_repair.repair_report(role_repair.damaged(conversations), conversations)


QUERIES = (
    op1_secret_scan,
    op2_token_files,
    op3_simhash_dedup,
    op4_quality_rules,
    op5_substring_dedup,
    op6_quality_classifier,
    op7_warc_revisits,
    op8_exact_dedup,
    op9_best_fit_packing,
    op10_trie_bpe,
    op11_conversation_trie,
    op12_length_packing,
    op13_role_repair,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}

"""The registered queries: each applies an operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.llm import (
    chat, decontamination, lines, merkle, minhash, mixing, personal_data, quality_outliers, secret_scan,
    simhash, substrings, token_files, trie,
)
from growthlake.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(table(spark, sf_dir, "documents")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.removal_counts(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_outliers.quality(table(spark, sf_dir, "documents")).drop("distance")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.personal_spans(table(spark, sf_dir, "documents")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.without_repeats(table(spark, sf_dir, "documents")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


def op10_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicate_sets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_token_files, op3_secret_scan, op4_mixing, op5_line_dedup, op6_quality_rules,
        op7_personal_data, op8_substring_dedup, op9_decontamination, op10_chat_perspectives,
        op11_prefix_trie, op12_merkle_manifest,
        op13_minhash_near_dedup)
}

"""The training-data queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, katz, license_scan, ngram_join, packing, quality, secret_scan, sharding, token_counts
from tidemark.llm.common import load
from tidemark.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]


#: The vocabularies' places; set another for other files.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
#: Free in the rank file, so it can end documents.
SEPARATOR = 50256


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load(spark, sf_dir, "documents"), bpe.rank_file(RANKS), public_tokenizers.PATTERN, SEPARATOR)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(load(spark, sf_dir, "documents"), bpe.rank_file(RANKS), public_tokenizers.PATTERN)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), bpe.rank_file(WORDS).decode())


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(load(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(load(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(load(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(load(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(load(spark, sf_dir, "documents"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(load(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(load(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(own.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if v}

"""The corpus pipeline: quality rules, exact dedup, n-gram join, secret scans, packing.

Each stage takes what its predecessor kept, as a Parquet table with the columns of documents; the last gives packed pieces.
A stage's result must be written before the next stage is called, which then deletes the tables that it was made from.

Further columns are kept, whatever their names. A null text is an empty one, and stays null: the quality rules reject both; exact
dedup takes all such rows for copies of one another; the n-gram join and the secret scan keep them; packing gives each its end
token. Of repeated rows one stays after dedup. An empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, ngram_join, packing, quality, secret_scan
from tidemark.llm.common import discard, free, load, materialise, scratch_paths
from tidemark.llm.queries import WORDS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scratch tables of the stage that was called last.
_left: set[str] = set()


def stage(f: Stage) -> Stage:
    """f, deleting first what the stage before left, unless docs still reads it."""

    @wraps(f)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free(_left, docs)
        before = scratch_paths()
        out = f(spark, docs, sf_dir)
        _left.clear()
        _left.update(scratch_paths() - before)
        return out

    return call


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the others lose the lines that are common in their source."""
    return quality.keep_good(docs, length_col="n_chars")


@stage
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the one with the smallest id stays."""
    return exact_dedup.keep_first(docs)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id stays. Five words and a similarity of 0.8."""
    return ngram_join.keep_one(docs, percent=80, size=5)


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secret_scan.redact(docs, length_col="n_chars")


@stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with their ids."""
    return packing.pack(docs, bpe.rank_file(WORDS).decode(), with_ids=True)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies), ("secret scans", secrets), ("packing", sequences)]

#: SQL can't express the tokenizer of the last stage; a test holds every stage and the run against brute force over planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (_, call) in enumerate(STAGES):
        before, docs = docs, materialise(call(spark, docs, sf_dir), f"stage-{k}")
        free(_left, docs)
        discard(before)
    return docs

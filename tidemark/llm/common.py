"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import clean_up, discard, free, materialise, scope, scratch, scratch_paths, shared_dir, ship

__all__ = ["SPACES", "clean_up", "discard", "free", "fresh", "keyed", "load", "materialise", "scope", "scratch", "scratch_paths", "shared_dir", "ship", "small_batches", "text_of", "without_rows"]

#: White space as the operators define it: the ASCII space and the controls from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, null as the empty one."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, tag: str, *columns: Column) -> tuple[DataFrame, str]:
    """docs (or these columns of it) with a row key, written to the shared folder, and the key's name.

    monotonically_increasing_id() follows the splits of one scan, which change when executors come or go, so a key that is to
    mean the same row twice must be written with it.
    """
    key = fresh(docs, "row_key")
    return materialise(docs.select(*(columns or docs.columns), F.monotonically_increasing_id().alias(key)), tag), key


def without_rows(rows: DataFrame, key: str, decided: DataFrame) -> DataFrame:
    """keyed() rows, without the key, less those that decided (row_key, kept) doesn't keep: no text moves while the rows that go
    are few enough for Spark to broadcast their keys, by the size of the table that is written here."""
    gone = materialise(decided.where(~F.col("kept")).select(F.col("row_key").alias(key)), "rows-gone")
    return rows.join(gone, key, "left_anti").drop(key)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Prepare for Python workers: ship the package, and bound the rows of an Arrow batch, since a row holds a whole text."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))

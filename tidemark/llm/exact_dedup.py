"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so, each chunk becomes a verified identifier, and texts are equal when their
ordered identifier lists are. Only digests move between executors; no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import SPACES, discard, keyed, materialise, text_of, without_rows


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_of(text), SPACES, " ")


def chunks(text: Column, least: int, most: int) -> Column:
    """Consecutive chunks that cover the text: each ends at the first sentence end after `least` characters, or at `most`."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most - 2}}}?[.!?;:] |.{{1,{most}}}"), F.lit(0))


def decided(rows: DataFrame, id_col: str, text_col: str, key: Column, least: int, most: int) -> DataFrame:
    """row_key (from key), the id, keep_id, group_size, kept, text_sha256."""
    text = normalised(text_col)
    digest = lambda c: F.struct(F.xxhash64(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("v"))
    rows = materialise(
        rows.select(key.alias("row_key"), F.col(id_col).alias("id"), text.alias("t")).select(
            "row_key", "id", F.sha2("t", 256).alias("sha"), F.transform(chunks(F.col("t"), least, most), digest).alias("chunks")
        ),
        "dedup-chunks",
    )
    each = rows.select("row_key", F.posexplode_outer("chunks").alias("pos", "chunk")).select("row_key", "pos", "chunk.h", "chunk.v")
    # A chunk's identifier is its 64-bit hash and, among contents that share it, the content's number by SHA-256.
    known = each.where("h IS NOT NULL").groupBy("h", "v").agg(F.count("*").alias("n"))
    clashes = materialise(known.withColumn("k", F.row_number().over(Window.partitionBy("h").orderBy("v"))).where("k > 1").select("h", "v", "k"), "dedup-clashes")
    numbered = each.join(clashes, ["h", "v"], "left").select("row_key", F.when(F.col("h").isNotNull(), F.struct("pos", "h", F.coalesce("k", F.lit(1)).alias("k"))).alias("c"))
    recipes = numbered.groupBy("row_key").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    recipes = recipes.select("row_key", F.transform("cs", lambda c: F.struct(c["h"].alias("h"), c["k"].alias("k"))).alias("recipe"))
    listed = materialise(rows.drop("chunks").join(recipes, "row_key").withColumn("key", F.xxhash64("recipe")), "dedup-recipes")
    discard(rows, clashes)
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row_key")
    groups = materialise(listed.groupBy("key", "recipe").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1"), "dedup-groups")
    return listed.join(groups, ["key", "recipe"], "left").select(
        "row_key",
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row_key") == F.col("row_key"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 512, most: int = 4096) -> DataFrame:
    """One row per input row: the id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one space; null is the empty text, and empty texts
    are equal to each other. Of equal texts the smallest id stays (a null id only if all are null); of repeated rows with
    that id, one stays. An empty table gives no rows; further columns of the input don't matter.
    """
    return decided(docs, id_col, text_col, F.monotonically_increasing_id(), least, most).drop("row_key")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 512, most: int = 4096) -> DataFrame:
    """The rows of docs that dedup() keeps, all columns; nulls, repeated rows and an empty table as there."""
    rows, key = keyed(docs, "dedup-rows")
    return without_rows(rows, key, decided(rows, id_col, text_col, F.col(key), least, most))

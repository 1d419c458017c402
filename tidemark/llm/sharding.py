"""Proportional stratified interleaving, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import materialise, text_of


def _before(counts: DataFrame, by: list[str], cell: str) -> DataFrame:
    """Rows in earlier cells of the same stratum, and the stratum's rows. A stratum has `cells` cells at most."""
    order = Window.partitionBy(*by).orderBy(cell) if by else Window.orderBy(cell)
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    return counts.select(*by, cell, (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("total"))


def interleave(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, cell_rows: int = 50_000) -> DataFrame:
    """One row per input row: the id, size, text_crc32, law, shard, slot, grown_shard.

    Within each source rows are ranked in the order of a seeded hash of the id; all rows are then sorted by their
    fractional rank, and the sorted rows are cut into shards whose counts differ by one at most, so every shard holds each
    source in its overall proportion. Both ranks are taken in cells: a row's rank is the count of rows in earlier cells and
    its rank in its own, so a source with a third of all rows is spread over all cells. There are 1024 cells at least, and more as
    soon as one would hold over cell_rows of all rows on average; only the cells' counts are summed up in one place.

    size is the UTF-8 length of the text plus one (null text: 1), text_crc32 the unsigned CRC-32 of its UTF-8 bytes (null:
    of none). A null source is a source of its own; repeated rows and rows that tie get different slots; a null id is
    hashed as such. An empty table gives no rows; further columns are left out.
    """
    cells = max(1024, -(-docs.count() // cell_rows))
    data = F.encode(text_of(text_col), "UTF-8")
    h = F.xxhash64(F.lit(seed), F.col(id_col))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("crc"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("src"),
        h.alias("h"),
    ).withColumn("cell", F.pmod(F.shiftrightunsigned("h", 20), F.lit(cells)).cast("int"))
    in_source = _before(rows.groupBy("src", "cell").agg(F.count("*").alias("n")), ["src"], "cell")
    inner = Window.partitionBy("src", "cell").orderBy("h", "id", "size", "crc")
    ranked = rows.join(in_source, ["src", "cell"]).withColumn("rank", F.col("before") + F.row_number().over(inner))
    ranked = ranked.withColumn("part", (2 * F.col("rank") - 1) / (2 * F.col("total")))
    ranked = materialise(ranked.select("id", "size", "crc", "src", "h", "rank", "part", F.floor(F.col("part") * cells).cast("int").alias("cell")), "shard-ranks")
    overall = _before(ranked.groupBy("cell").agg(F.count("*").alias("n")), [], "cell")
    outer = Window.partitionBy("cell").orderBy("part", "src", "rank")
    at = ranked.join(overall, "cell").withColumn("at", F.col("before") + F.row_number().over(outer) - 1)
    base, more = F.expr(f"total div {shards}"), F.expr(f"total % {shards}")
    wide = more * (base + 1)  # rows in the shards that hold one more
    at = at.withColumn("shard", F.when(F.col("at") < wide, F.expr(f"`at` div ((total div {shards}) + 1)")).otherwise(more + F.floor((F.col("at") - wide) / F.greatest(base, F.lit(1)))))
    first = F.col("shard") * base + F.least(F.col("shard"), more)
    return at.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("at") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

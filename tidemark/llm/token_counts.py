"""Token counts of flat, unindexed token files: a vectorised separator scan, stitched across blocks by a prefix scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.bpe import encoder
from tidemark.llm.common import scratch, small_batches, text_of


def write_token_files(docs: DataFrame, ranks: bytes, pattern: str, separator: int, path: str, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = 1 << 16, dtype: str = "<u2") -> None:
    """Encode texts into flat streams of ids (dtype: little-endian, unsigned, wide enough for all), each document ended by `separator`, cut into blocks of a fixed size.

    A partition is one file. Blocks (file, block, data, labels) don't follow documents; labels are the ids of the documents
    that end in the block, in their order, and aren't used to find them. A null text is a document without tokens.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(ranks)  # a vocabulary file; it doesn't grow with the data
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary.value, pattern)
        file, block = TaskContext.get().partitionId(), 0
        held, size, labels, id_type = [], 0, [], None

        def row(part: np.ndarray, ended: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([part.tobytes()], pa.binary()), pa.array([ended], pa.list_(id_type))], ["file", "block", "data", "labels"])

        def cut(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, labels, block
            flat = np.concatenate(held) if held else np.zeros(0, dtype)
            at = 0
            while len(flat) - at >= least:
                part = flat[at : at + block_tokens]
                n = int((part == separator).sum())
                yield row(part, labels[:n])
                labels, block, at = labels[n:], block + 1, at + len(part)
            held, size = [flat[at:]], len(flat) - at

        for b in batches:
            id_type = b.column(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.append(np.array([*enc.encode_ordinary(text), separator], dtype=dtype))
                labels.append(key)
                size += len(held[-1])
                if size >= block_tokens:
                    yield from cut(block_tokens)
        yield from cut(1)

    rows = docs.select(F.col(id_col), text_of(text_col).alias(text_col))
    rows.mapInArrow(run, f"file long, block long, data binary, labels array<{kind}>").write.option("compression", "zstd").parquet(path)


def blocks_of(spark: SparkSession, paths: str | list[str], block_bytes: int = 1 << 20) -> DataFrame:
    """Blocks (file, block, data) of raw binary token files, each under 2 GB; block_bytes is a multiple of an id's bytes."""
    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "content", "length")
    at = files.withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(F.expr(f"cast((length - 1) div {block_bytes} as int)"), F.lit(0)))))
    return at.where("length > 0").select("file", F.col("block").cast("long").alias("block"), F.substring("content", F.col("block") * block_bytes + 1, F.lit(block_bytes)).alias("data"))


def separator_scan(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """Documents of each block: the block's columns but data, plus first (number in the file of the first document that
    ends here), lengths (tokens of the documents that end here, without separators) and open (tokens after the last
    separator, carried over blocks; only in a file's last block, else null).

    Every block is searched alone; what a document has in earlier blocks comes from running sums and maxima over the
    file's blocks. Empty blocks and files without a separator are allowed; no rows give no rows.
    """
    kept = [c for c in blocks.columns if c != "data"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, lengths, tails = [], [], []
            for data in b.column("data").to_pylist():
                ids = np.frombuffer(data or b"", dtype)
                ends = np.flatnonzero(ids == separator)
                sizes.append(len(ids))
                lengths.append(np.diff(ends, prepend=-1) - 1)
                tails.append(len(ids) - (int(ends[-1]) + 1 if len(ends) else 0))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(sizes, pa.int64()), pa.array(lengths, pa.list_(pa.int64())), pa.array(tails, pa.int64())], [*kept, "size", "lengths", "tail"])

    types = ", ".join(f"{c} {t}" for c, t in blocks.dtypes if c != "data")
    found = blocks.mapInArrow(search, f"{types}, size long, lengths array<long>, tail long")
    order = Window.partitionBy("file").orderBy("block")
    start = F.sum("size").over(order) - F.col("size")
    found = found.withColumn("start", start).withColumn("first", F.sum(F.size("lengths")).over(order) - F.size("lengths"))
    last_end = F.max(F.when(F.size("lengths") > 0, F.col("start") + F.col("size") - F.col("tail")))
    found = found.withColumn("carry", F.col("start") - F.coalesce(last_end.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    found = found.withColumn("open", F.when(F.lead("block").over(order).isNull(), F.col("tail") + F.when(F.size("lengths") == 0, F.col("carry")).otherwise(0)))
    lengths = F.transform("lengths", lambda n, i: F.when(i == 0, n + F.col("carry")).otherwise(n))
    return found.withColumn("lengths", lengths).select(*kept, "first", "lengths", "open")


def token_counts(docs: DataFrame, ranks: bytes, pattern: str, separator: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents to token files, scan those, and label the counts: the id and n_tokens, without separators.

    A null or empty text has 0 tokens; repeated rows are counted each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch(spark, "token-files")
    small_batches(spark, 256)  # of texts, and of blocks of 128 KB
    dtype = "<u2" if max(separator, ranks.count(b"\n")) < 1 << 16 else "<u4"  # a rank file has a line an id
    write_token_files(docs, ranks, pattern, separator, path, id_col, text_col, dtype=dtype)
    kind = docs.schema[id_col].dataType.simpleString()
    found = separator_scan(spark.read.schema(f"file long, block long, data binary, labels array<{kind}>").parquet(path), separator, dtype)
    return found.select(F.explode(F.arrays_zip("labels", "lengths")).alias("d")).select(F.col("d.labels").alias(id_col), F.col("d.lengths").alias("n_tokens"))

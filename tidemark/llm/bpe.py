"""Byte-level BPE by ranks: overlapping chunk encoding, and decoding by concatenated bytes.

A long text is cut into overlapping chunks that are pre-tokenised in parallel, each from its own start. Where the
boundaries of a chunk and its successor meet inside their overlap, both scans go on alike, so the text can be cut there;
the pieces between such places are then encoded in parallel and their ids joined.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import small_batches, text_of

#: A match that ends this near to the end of a chunk could go on in the whole text, or be taken by a longer alternative.
GUARD = 8

_built: dict[tuple[str, str], object] = {}


def rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoder(ranks: bytes, pattern: str):
    """The tiktoken encoder of a rank file's contents, built once a worker."""
    import hashlib

    import tiktoken

    key = (hashlib.sha256(ranks).hexdigest(), pattern)
    if key not in _built:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        _built[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _built[key]


def byte_table(ranks: bytes) -> list[bytes]:
    table = {int(b): base64.b64decode(a) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    return [table.get(i, b"") for i in range(max(table, default=-1) + 1)]


def id_bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def safe_ends(text: str, pattern: str, first: int, last: int) -> list[int]:
    """Ends of pre-tokens in text[first:last], where the text may be cut: not after white space, not near the text's end."""
    import regex

    n = len(text)
    return [e for m in regex.compile(pattern).finditer(text) if first <= (e := m.end()) <= last and e <= n - GUARD and not text[e - 1].isspace()]


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = 16384, overlap: int = 1024) -> DataFrame:
    """One row per input row: row_key, the id, ids (binary: little-endian unsigned 32-bit), as tiktoken's encode_ordinary.

    A null text is the empty one and has no ids. Repeated rows are encoded each; a null id is kept. Texts over `chunk`
    characters go through chunks; a text in which two neighbours never meet within `overlap` is cut before that place only,
    and the rest of it is one piece. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row_key"), F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    vocabulary = spark.sparkContext.broadcast(ranks)  # a vocabulary file; it doesn't grow with the data

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary.value, pattern)
        for b in batches:
            ids = pa.array([id_bytes(enc.encode_ordinary(t)) for t in b.column("t").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "t"), ids], [*(c for c in b.schema.names if c != "t"), "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    short = rows.where(F.length("t") <= chunk).mapInArrow(whole, f"row_key long, id {kind}, ids binary")

    long = rows.where(F.length("t") > chunk)
    at = F.explode(F.sequence(F.lit(0), F.expr(f"cast((length(t) - 1) div {chunk} as int)"))).alias("k")
    parts = long.select("row_key", "t", at).select("row_key", "k", F.substring("t", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("t"), F.length("t").alias("size"))
    parts = parts.repartition(spark_partitions(spark), "row_key", "k")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for k, t, size in zip(b.column("k").to_pylist(), b.column("t").to_pylist(), b.column("size").to_pylist(), strict=True):
                ends = safe_ends(t, pattern, 0, len(t))
                heads.append([k * chunk + e for e in ends if e <= overlap])
                tails.append([k * chunk + e for e in ends if e >= chunk and k * chunk + e < size])
            yield pa.RecordBatch.from_arrays([b.column("row_key"), b.column("k"), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], ["row_key", "k", "heads", "tails"])

    ends = parts.mapInArrow(scanned, "row_key long, k int, heads array<int>, tails array<int>")
    order = Window.partitionBy("row_key").orderBy("k")
    met = F.array_min(F.array_intersect("heads", F.lag("tails").over(order)))
    cuts = ends.withColumn("met", F.when(F.col("k") > 0, met)).where("k > 0")
    cuts = cuts.withColumn("open", F.max(F.col("met").isNull()).over(order)).where("NOT open")  # the first failure ends the proof
    cuts = cuts.groupBy("row_key").agg(F.sort_array(F.collect_list("met")).alias("cuts"))
    none = F.expr("cast(array() as array<int>)")
    edged = long.join(cuts, "row_key", "left").withColumn("edges", F.concat(F.array(F.lit(0)), F.coalesce("cuts", none), F.array(F.length("t"))))
    pieces = edged.select("row_key", "id", "t", "edges", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("k"))
    start = F.element_at("edges", F.col("k"))
    pieces = pieces.select("row_key", "id", "k", F.substring("t", start + 1, F.element_at("edges", F.col("k") + 1) - start).alias("t")).repartition(spark_partitions(spark), "row_key", "k")
    encoded = pieces.mapInArrow(whole, f"row_key long, id {kind}, k int, ids binary")
    joined = encoded.groupBy("row_key", "id").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("ids"))
    joined = joined.select("row_key", "id", F.unhex(F.array_join(F.transform("ids", lambda x: F.hex(x["ids"])), "")).alias("ids"))
    return short.unionByName(joined).withColumnRenamed("id", id_col)


def spark_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def decoder(spark: SparkSession, ranks: bytes) -> Callable:
    """A pandas UDF from ids (binary) to the bytes that they stand for."""
    vocabulary = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = byte_table(vocabulary.value).__getitem__
        for s in parts:
            yield s.map(lambda b: b"".join(map(of, np.frombuffer(b, "<u4").tolist())))

    return decoded


def digest(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids: the id, n_tokens, ids_sha256, decoded_sha256."""
    ids = encode(docs, ranks, pattern, id_col, text_col)
    both = ids.withColumn("decoded", decoder(docs.sparkSession, ranks)("ids"))
    return both.select(id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

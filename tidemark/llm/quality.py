"""Quality rules: per-document measures, and the frequency of lines across the documents of a host."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, fresh, keyed, materialise, small_batches, without_rows

SYMBOLS = b"#*$%&|<>"


def repeated_words(codes: list[int], kinds: int) -> int:
    """Words in 3-word windows that occur twice or more, the first occurrence included."""
    n = len(codes)
    if n < 4:
        return 0
    a = np.array(codes, np.int64)
    pair = a[:-2] * kinds + a[1:-1]
    if kinds > 2_000_000:  # else three codes would overflow 64 bits
        pair, kinds = np.unique(pair, return_inverse=True)[1].astype(np.int64), n + 1
        third = np.unique(a, return_inverse=True)[1].astype(np.int64)
        key = pair * kinds + third[2:]
    else:
        key = pair * kinds + a[2:]
    _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= again
    return int(inside.sum())


def measure(text: bytes) -> tuple[int, int, int, int, int, list[int], list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the hashes and words of its distinct normalised lines.

    A line is normalised by lower-casing A-Z and joining its words by one space; lines without a word don't count.
    """
    from xxhash import xxh3_64_intdigest

    index: dict[bytes, int] = {}
    codes: list[int] = []
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    worded = 0
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        worded += 1
        seen.add(line)
        codes += [index.setdefault(w, len(index)) for w in words]
        h = xxh3_64_intdigest(b" ".join(words).lower())
        h -= (h >> 63) << 64
        lines[h] = lines.get(h, 0) + len(words)
    raw = np.frombuffer(text, np.uint8)
    chars = len(raw) - int(((raw & 0xC0) == 0x80).sum()) - int(((raw == 0x20) | ((raw >= 9) & (raw <= 13))).sum())
    symbols = sum(text.count(c) for c in (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))
    return len(codes), chars, symbols, worded - len(seen), repeated_words(codes, len(index)), list(lines), list(lines.values())


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str, key: Column) -> DataFrame:
    """row_key, the id, host, the measures, text_hash, lines (hashes) and line_words, written to the shared folder."""
    from xxhash import xxh3_64_intdigest

    small_batches(docs.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column("t").cast(pa.binary()).to_pylist()]
            found = list(zip(*map(measure, texts), strict=True)) or [[]] * 7
            hashes = [h - ((h >> 63) << 64) for h in map(xxh3_64_intdigest, texts)]
            columns = [b.column("row_key"), b.column("id"), b.column("host"), *(pa.array(c, pa.int64()) for c in found[:5]), pa.array(hashes, pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in found[5:])]
            yield pa.RecordBatch.from_arrays(columns, ["row_key", "id", "host", *names, "text_hash", "lines", "line_words"])

    rows = docs.select(key.alias("row_key"), F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit("n")).alias("host"), F.col(text_col).cast("string").alias("t"))
    types = ", ".join(f"{n} long" for n in names)
    return materialise(rows.mapInArrow(run, f"row_key long, id {docs.schema[id_col].dataType.simpleString()}, host string, {types}, text_hash long, lines array<long>, line_words array<long>"), "quality-measures")


@dataclass(frozen=True)
class Limits:
    """A normalised line is above the limits in a host if more than `least` distinct documents of the host hold it, and more than
    `share` of them or more than `most`. A document that would lose more than `depleted` of its words with such lines is
    rejected, as is one with under min_words words.

    Documents with the same text count once. `least` is what it takes to tell boilerplate from a few near copies in a small
    host, `share` what tells it from a large group of them, and `most` is for hosts so large that no group of copies but
    boilerplate gets there.
    """

    least: int = 5
    share: float = 0.05
    most: int = 10_000
    depleted: float = 0.5
    min_words: int = 50


def judge(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits, key: Column) -> DataFrame:
    """The columns of verdicts(), row_key, and cut, the hashes of the row's common lines (null if it has none)."""
    rows = measures(docs, id_col, text_col, host_col, key)
    texts = rows.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    once = rows.select("host", "text_hash", F.explode("lines").alias("line")).distinct()
    counts = once.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > limits.least)
    above = (F.col("n") > limits.share * F.col("texts")) | (F.col("n") > limits.most)
    common = materialise(counts.join(texts, "host").where(above).select("host", "line"), "quality-lines")
    each = rows.select("row_key", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("row_key", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    lost = each.join(common, ["host", "line"]).groupBy("row_key").agg(F.sum("words").alias("lost_words"), F.collect_list("line").alias("cut"))
    out = rows.drop("lines", "line_words").join(lost, "row_key", "left").withColumn("lost_words", F.coalesce("lost_words", F.lit(0)))
    out = out.withColumn("base_failed", (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    kept = ~F.col("base_failed") & (F.col("lost_words") <= limits.depleted * F.col("n_words"))
    return out.select("row_key", F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words", kept.alias("kept"), "cut")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per input row: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_words (words of
    lines above the limits), kept.

    Rejected are documents depleted by the limits, those with few words, and those with over half their words in repeated
    3-word windows; keep_good() removes the lines from the others. A null or empty text has no words and is rejected; a null
    host is a host of its own; repeated rows are judged alike. An empty table gives no rows.
    """
    return judge(docs, id_col, text_col, host_col, limits, F.monotonically_increasing_id()).drop("row_key", "cut")


def without(text: str, cut: set[int]) -> str:
    """The text less the lines whose normalised form has a hash in cut."""
    from xxhash import xxh3_64_intdigest

    left = []
    for line in text.split("\n"):
        words = line.encode().split()
        h = xxh3_64_intdigest(b" ".join(words).lower()) if words else None
        if h is None or h - ((h >> 63) << 64) not in cut:
            left.append(line)
    return "\n".join(left)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", length_col: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """The rows of docs that verdicts() keeps, all columns, with every line above the limits removed from their texts.

    length_col is set to the new length in the texts that lose a line; the others stay as they are. The measures are those of
    the whole text: what is left isn't judged again. Nulls, repeated rows and an empty table as in verdicts().
    """
    rows, key = keyed(docs, "quality-rows")
    cut = fresh(rows, "cut")
    found = materialise(judge(rows, id_col, text_col, host_col, limits, F.col(key)).select("row_key", "kept", "cut"), "quality-verdicts")
    cuts = materialise(found.where("kept AND cut IS NOT NULL").select(F.col("row_key").alias(key), F.col("cut").alias(cut)), "quality-cuts")
    rows = without_rows(rows.join(cuts, key, "left"), key, found)
    discard(found)

    @F.arrow_udf("string")
    def shorten(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        return pa.array([None if c is None else without(t, set(c)) for t, c in zip(texts.to_pylist(), cuts.to_pylist(), strict=True)], pa.string())

    loses = F.col(cut).isNotNull()
    rows = rows.withColumn(text_col, F.when(loses, shorten(F.when(loses, F.col(text_col).cast("string")), F.col(cut))).otherwise(F.col(text_col)))
    if length_col:
        rows = rows.withColumn(length_col, F.when(loses, F.length(text_col)).otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType))
    return rows.select(*docs.columns)

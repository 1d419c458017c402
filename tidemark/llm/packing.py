"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

Documents stream through windows of a bounded number of tokens. Within a window, pieces in descending order of their
estimated attention cost (linear plus quadratic in their length) go to the sequence with the lowest cost so far among those
that have room. The window's sequences hold exactly its tokens: all are full but the last few, whose lengths are powers of
two. Nothing is shuffled, so a lost task is repeated alone.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import small_batches

_built: dict[str, "WordBpe"] = {}

#: A word's end in the byte alphabet of the merges; no UTF-8 text holds this byte.
WORD_END = b"\xff"


def byte_letters() -> dict[str, int]:
    """The printable letters by which byte-level vocabularies write bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordBpe:
    """A tokenizers file of the word-end BPE kind, by words: equal words have equal ids, so each is merged once.

    Words of ASCII and Latin-1 letters are merged by tiktoken's routine over the file's own merge order; all others go
    through the tokenizers library. Both see one stretch between white space at a time, which that kind of file never
    merges across. The file's added tokens are ids of their own wherever a text holds them, as the library reads them; a file
    whose added tokens need more than their own letters to be found goes through the library as a whole. `most` bounds the
    words that are remembered.
    """

    def __init__(self, data: str, most: int = 100_000) -> None:
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(data)
        spec = json.loads(data)
        added = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.simple = not any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.added = {k: np.array([v], dtype="<u4").tobytes() for k, v in added.items()}
        self.cut = regex.compile(b"(" + b"|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + b")").split if added else None
        of = byte_letters()
        end = spec["model"]["end_of_word_suffix"]
        special = {x["content"] for x in spec["added_tokens"]}
        raw = lambda t: bytes(of[c] for c in t.removesuffix(end)) + WORD_END * t.endswith(end)
        ranks = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.fast = len(ranks) == len(spec["model"]["vocab"]) - len(special & set(spec["model"]["vocab"])) and all(spec["model"]["vocab"]["".join(m)] == 512 + i for i, m in enumerate(merges))
        self.merge = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece if self.fast else None
        self.plain = regex.compile(r"[!-~\xa1-\xac\xae-\xff]*").fullmatch
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.known: dict[bytes, bytes] = {}
        self.most = most

    def stretch(self, b: bytes) -> bytes:
        """Ids of what stands between two white spaces, little-endian unsigned 32-bit."""
        s = b.decode()
        if self.fast and self.plain(s):
            ids = [i for w in self.split(s.lower()) for i in self.merge(w.encode() + WORD_END)]
        else:
            ids = self.whole.encode(s, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def words(self, text: bytes) -> bytes:
        known, out = self.known, []
        for w in text.split():
            x = known.get(w)
            if x is None:
                x = self.stretch(w)
                if len(w) <= 64:
                    if len(known) >= self.most:
                        known.clear()
                    known[w] = x
            out.append(x)
        return b"".join(out)

    def encode(self, text: bytes) -> bytes:
        if not self.simple:
            return np.array(self.whole.encode(text.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        if any(k in text for k in self.added):
            return b"".join(self.added.get(part) or self.words(part) for part in self.cut(text))
        return self.words(text)


def word_bpe(data: str) -> WordBpe:
    import hashlib

    key = hashlib.sha256(data.encode()).hexdigest()
    if key not in _built:
        _built[key] = WordBpe(data)
    return _built[key]


def plan(lengths: list[int], limit: int = 4096, linear: float = 1.0, quadratic: float = 1.0 / 4096) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that fill sequences of `limit` tokens, costs balanced.

    A piece of n tokens costs linear * n + quadratic * n * n. It goes whole to the cheapest sequence with room for it; if
    none has, the cheapest with any room takes what fits and the rest is dealt out like any other piece. The capacities
    add up to the tokens: full sequences, then the powers of two in the rest.
    """
    total = sum(lengths)
    rest = total % limit
    room = np.array([limit] * (total // limit) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1], dtype=np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    heap = [(-min(limit, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, limit)]
    heapq.heapify(heap)
    out = []
    while heap:
        n, d, s = heapq.heappop(heap)
        n = -n
        fits = room >= n
        i = int(np.where(fits, cost, np.inf).argmin())
        take = n
        if not fits[i]:
            i = int(np.where(room > 0, cost, np.inf).argmin())
            take = int(room[i])
            heapq.heappush(heap, (take - n, d, s + take))
        out.append((d, s, take, i, int(used[i])))
        room[i] -= take
        used[i] += take
        cost[i] += linear * take + quadratic * take * take
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, limit: int = 4096, window: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids adds their ids (binary).

    tokenizer is the content of a tokenizers file, whose ids are those of the library without adding special tokens (those that
    a text itself holds are kept); end_id is appended to each document. A null or empty text is a document
    of that one token. Repeated rows are packed each. sequence_id is unique over the table (partition and number in it);
    offsets in a sequence are gapless from 0. A window holds `window` tokens, more only to end a document, so memory is
    bounded by the longest document. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    data = spark.sparkContext.broadcast(tokenizer)  # a vocabulary file; it doesn't grow with the data
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_bpe(data.value)
        first = TaskContext.get().partitionId() << 32
        names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

        def packed(keys: list, ids: list[bytes], id_type: pa.DataType, first: int) -> tuple[pa.RecordBatch, int]:
            sizes = [len(x) // 4 for x in ids]
            pieces = plan(sizes, limit)
            cut = [ids[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in pieces]
            columns = [
                pa.array([keys[p[0]] for p in pieces], id_type),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([p[2] for p in pieces], pa.int64()),
                pa.array(map(zlib.crc32, cut), pa.int64()),
                pa.array([sizes[p[0]] for p in pieces], pa.int64()),
                pa.array([first + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array(cut, pa.binary())] * with_ids], names), max(p[3] for p in pieces) + 1

        keys, ids, size, id_type = [], [], 0, None
        for b in batches:
            id_type = b.column(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                keys.append(key)
                ids.append(words.encode(text or b"") + end)
                size += len(ids[-1]) // 4
                if size >= window:
                    out, n = packed(keys, ids, id_type, first)
                    yield from (out.slice(i, 64) for i in range(0, out.num_rows, 64))
                    del out
                    first, keys, ids, size = first + n, [], [], 0
        if keys:
            out, _ = packed(keys, ids, id_type, first)
            yield from (out.slice(i, 64) for i in range(0, out.num_rows, 64))

    schema = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return docs.select(id_col, docs[text_col].cast("string").alias(text_col)).mapInArrow(run, schema)

"""Katz back-off language model: Good-Turing discounted bigram and unigram counts, scored over whole documents.

Counts live in two tables of partitions (unigrams by word hash, bigrams by history, frequent histories also by word), each
row a compressed column block. A group of documents asks the partitions for exactly the n-grams that it holds, each once, so
what is shuffled is distinct n-grams by group, not tokens; answers come back in the order of the questions. A document's
probability is then evaluated token by token: the discounted bigram estimate if the bigram was seen in training, else the
history's back-off weight times the same rule for the unigram. Back-off weights are ratios of exact sums over integer
count classes, so each history's probabilities add up to one over the vocabulary and the unknown word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import materialise, small_batches
from tidemark.llm.words import mixed

#: Counts up to K are discounted.
K = 5
#: A history with over 1 / HOT of all tokens is dealt out by history and word; there are fewer than HOT of them.
HOT = 4096
#: No word holds a space.
END = b" "
#: The history of a document's first token; word ids stay below.
START = 1 << 62

BLOCK = "g long, part int, a binary, b binary, c binary, id long, vec array<long>"
NAMES = ["g", "part", "a", "b", "c", "id", "vec"]


def squeeze(x: np.ndarray, sorted_: bool = False) -> bytes:
    """Unsigned numbers (rising ones as differences) as compressed byte planes."""
    import zstandard

    x = np.ascontiguousarray(x, np.uint64)
    d = np.diff(x, prepend=np.uint64(0)) if sorted_ else x
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    return bytes([width, sorted_]) + zstandard.compress(d.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), 1)


def unsqueeze(b: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(b[2:]), np.uint8).reshape(b[0], -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, : b[0]] = planes.T
    x = full.view(np.uint64).ravel()
    return np.cumsum(x, dtype=np.uint64) if b[1] else x


def rows_of(**columns: list) -> dict[str, list]:
    n = len(next(iter(columns.values())))
    return {k: columns.get(k, [None] * n) for k in NAMES}


def table_of(*parts: dict[str, list]) -> pa.Table:
    types = dict(zip(NAMES, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64())), strict=True))
    return pa.table({k: pa.array([x for p in parts for x in p[k]], types[k]) for k in NAMES})


def classes(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, ..., K + 1."""
    return np.bincount(counts[counts <= K + 1].astype(np.int64), minlength=K + 2)[1 : K + 2].tolist()


def discounts(n: list[int]) -> np.ndarray:
    """d[r] for counts r up to K, 1 above, from the counts of counts n[r - 1]: Good-Turing renormalised to leave counts above
    K alone. Where that is undefined or not between 0 and 1 (few data), half a count is taken off."""
    d = np.ones(K + 2)
    over = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        good = ((r + 1) * n[r] / n[r - 1] / r - over) / (1 - over) if n[r - 1] and over < 1 else 0.0
        d[r] = good if 0 < good < 1 else (r - 0.5) / r
    return d


@dataclass(frozen=True)
class Totals:
    """What a scorer needs besides the counts of its own n-grams."""

    tokens: int
    kinds: int
    unigram: tuple[int, ...]
    bigram: tuple[int, ...] = ()

    def unigram_p(self) -> tuple[np.ndarray, float, float]:
        """Discounts, what counts are divided by, and the unknown word's probability."""
        d = discounts(list(self.unigram))
        low = sum((1 - d[r]) * r * self.unigram[r - 1] for r in range(1, K + 1))
        return (d, float(self.tokens), low / self.tokens) if low > 0 else (d, self.tokens + 1.0, 1 / (self.tokens + 1.0))


def gather(docs: DataFrame, id_col: str, text_col: str, parts: int, group_tokens: int) -> DataFrame:
    """Groups of documents as local word numbers, and each group's words with their training counts, by part of the hash range."""
    from xxhash import xxh3_64_intdigest

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    width = np.uint64((1 << 64) // parts + 1)
    names = ["g", "ids", "sizes", "words", "part", "keys", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 24, 0
        local: dict[bytes, int] = {}
        ids, sizes, codes, id_type = [], [], [], None

        def group() -> Iterator[pa.RecordBatch]:
            g = base + number
            hashes, to = np.unique(np.array([xxh3_64_intdigest(w) for w in local], np.uint64), return_inverse=True)
            words = to[np.array(codes, np.int64)]
            train = np.repeat(np.array([not held_out(x) for x in ids]), sizes)
            counts = np.bincount(words[train], minlength=len(hashes)).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())), pa.array([squeeze(words)], pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())], names)
            part = (hashes // width).astype(np.int64)
            cut = np.flatnonzero(np.diff(part)) + 1
            ks, cs, ps = np.split(hashes, cut), np.split(counts, cut), [int(p[0]) for p in np.split(part, cut)]
            n = len(ps)
            yield pa.RecordBatch.from_arrays([pa.array([g] * n, pa.int64()), pa.nulls(n, pa.list_(id_type)), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()), pa.array(ps, pa.int32()), pa.array([squeeze(k, True) for k in ks], pa.binary()), pa.array(map(squeeze, cs), pa.binary())], names)

        for b in batches:
            id_type = b.column(0).type
            for key, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").lower().split()
                codes += [local.setdefault(w, len(local)) for w in words]
                codes.append(local.setdefault(END, len(local)))
                ids.append(key)
                sizes.append(len(words) + 1)
                if len(codes) >= group_tokens:
                    yield from group()
                    number += 1
                    local, ids, sizes, codes = {}, [], [], []
        if ids:
            yield from group()

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("t"))
    return materialise(rows.mapInArrow(run, f"g long, ids array<{kind}>, sizes array<long>, words binary, part int, keys binary, counts binary"), "lm-groups")


def held_out(key: object) -> bool:
    return zlib.crc32(b"" if key is None else str(key).encode()) % 10 == 0


def merge(keys: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the distinct keys (sorted by the first, then the second), their summed counts, and each row's number among them."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    if len(new):
        new[0] = True
    first = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    total = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return order[first], total, which


def unigrams(groups: DataFrame, parts: int) -> DataFrame:
    """The unigram table: its blocks (g -1: hashes, counts, ids), answers to groups (ids, counts), totals (id -1) and frequent words."""

    def count(part: pa.Table) -> pa.Table:
        p = part.column("part")[0].as_py()
        keys = [unsqueeze(b) for b in part.column("keys").to_pylist()]
        counts = np.concatenate([unsqueeze(b) for b in part.column("counts").to_pylist()])
        sizes = [len(k) for k in keys]
        every = np.concatenate(keys)
        at, total, which = merge([every], counts)
        rank = np.empty(len(at), np.uint64)
        rank[np.argsort(-total.astype(np.int64), kind="stable")] = np.arange(len(at), dtype=np.uint64)
        ids = rank * np.uint64(parts) + np.uint64(p)  # frequent words get small numbers
        cut = np.cumsum(sizes)[:-1]
        answers = rows_of(g=part.column("g").to_pylist(), part=[p] * len(keys), a=[squeeze(x) for x in np.split(ids[which], cut)], b=[squeeze(x) for x in np.split(total[which], cut)])
        seen = total > 0
        table = rows_of(g=[-1], part=[p], a=[squeeze(every[at][seen], True)], b=[squeeze(total[seen])], c=[squeeze(ids[seen])])
        often = np.flatnonzero(total * np.uint64(HOT) > total.sum(dtype=np.uint64))
        hot = rows_of(id=ids[often].astype(np.int64).tolist(), vec=[[int(c)] for c in total[often]]) if len(often) else rows_of(id=[])
        totals = rows_of(id=[-1], vec=[[int(total.sum(dtype=np.uint64)), int(seen.sum()), *classes(total)]])
        return table_of(answers, table, hot, totals)

    asked = groups.where("part IS NOT NULL").select("g", "part", "keys", "counts")
    return materialise(asked.groupBy("part").applyInArrow(count, BLOCK), "lm-unigrams")


def summed(table: DataFrame, n: int) -> list[int]:
    row = table.where("id = -1").agg(*(F.sum(F.col("vec")[i]) for i in range(n))).first()
    return [int(x or 0) for x in row]


class Group:
    """A group's tokens and distinct bigrams, the latter in the order in which they are asked for."""

    def __init__(self, docs: pa.Table, answers: pa.Table, parts: int, hot: np.ndarray) -> None:
        self.ids = docs.column("ids")[0].as_py()
        self.sizes = np.array(docs.column("sizes")[0].as_py(), np.int64)
        self.words = unsqueeze(docs.column("words")[0].as_py()).astype(np.int64)
        mine = sorted(zip(answers.column("part").to_pylist(), answers.column("a").to_pylist(), answers.column("b").to_pylist(), strict=True), key=lambda x: x[0])
        word_id = np.concatenate([*(unsqueeze(a) for _, a, _ in mine), np.array([START], np.uint64)])
        self.counts = np.concatenate([unsqueeze(b) for _, _, b in mine])
        start, kinds = len(word_id) - 1, np.int64(len(word_id))
        self.first = np.cumsum(self.sizes) - self.sizes
        before = np.concatenate([[start], self.words[:-1]])
        before[self.first] = start
        key, self.pair = np.unique(before * kinds + self.words, return_inverse=True)
        one, two = word_id[key // kinds], word_id[key % kinds]
        self.is_hot = np.isin(one, hot)
        self.part = (mixed(one * np.uint64(3) + mixed(two) * self.is_hot.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        self.order = np.lexsort((two, one, self.part))
        self.one, self.two, self.word = one, two, key % kinds

    def training(self) -> np.ndarray:
        train = np.repeat(np.array([not held_out(x) for x in self.ids]), self.sizes)
        return np.bincount(self.pair[train], minlength=len(self.one)).astype(np.uint64)


def questions(groups: DataFrame, words: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """(g, part, a, b, c, d): a group's distinct bigrams of a part: histories, words, training counts, the words' counts."""

    def ask(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"g": pa.array([], pa.int64()), "part": pa.array([], pa.int32()), **{k: pa.array([], pa.binary()) for k in "abcd"}})
        x = Group(docs, answers, parts, hot)
        o = x.order
        part = x.part[o]
        cut = np.flatnonzero(np.diff(part)) + 1
        split = lambda v: np.split(v[o], cut)
        ps = [int(p[0]) for p in np.split(part, cut)]
        return pa.table(
            {
                "g": pa.array([docs.column("g")[0].as_py()] * len(ps), pa.int64()),
                "part": pa.array(ps, pa.int32()),
                "a": pa.array([squeeze(v, True) for v in split(x.one)], pa.binary()),
                "b": pa.array([squeeze(v) for v in split(x.two)], pa.binary()),
                "c": pa.array([squeeze(v) for v in split(x.training())], pa.binary()),
                "d": pa.array([squeeze(v) for v in split(x.counts[x.word])], pa.binary()),
            }
        )

    left = groups.where("part IS NULL").select("g", "ids", "sizes", "words")
    right = words.where("g >= 0").select("g", "part", "a", "b")
    return left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(ask, "g long, part int, a binary, b binary, c binary, d binary")


def bigrams(asked: DataFrame, hot: np.ndarray) -> DataFrame:
    """The bigram table: its blocks (g -1: histories, words, counts), answers to groups (counts; history classes), totals
    (id -1) and the classes of frequent histories.

    The classes of a history are 2 * (K + 1) integers over the words that were seen after it: how many bigrams occur 1 to K
    times and the sum of higher counts; how many of the words occur 1 to K times and the sum of higher counts.
    """

    def count(part: pa.Table) -> pa.Table:
        p = part.column("part")[0].as_py()
        blocks = {k: [unsqueeze(b) for b in part.column(k).to_pylist()] for k in "abcd"}
        sizes = [len(x) for x in blocks["a"]]
        one, two, counts, word_counts = (np.concatenate(blocks[k]) for k in "abcd")
        del blocks
        at, total, which = merge([one, two], counts)
        one_at, c, w = one[at], total.astype(np.int64), word_counts[at].astype(np.int64)
        histories, h = np.unique(one_at, return_inverse=True)
        vec = np.zeros((len(histories), 2 * (K + 1)), np.int64)
        seen = c > 0
        for x, start in ((c, 0), (w, K + 1)):
            for r in range(1, K + 1):
                vec[:, start + r - 1] = np.bincount(h[seen & (x == r)], minlength=len(histories))
            np.add.at(vec[:, start + K], h[seen & (x > K)], x[seen & (x > K)])
        cut = np.cumsum(sizes)[:-1]
        answers = [squeeze(x) for x in np.split(total[which], cut)]
        told = []
        for x in np.split(one, cut):
            own = np.searchsorted(histories, x[np.concatenate([[True], x[1:] != x[:-1]])])
            told.append(squeeze(vec[own].T.ravel()))
        n = len(sizes)
        often = np.flatnonzero(np.isin(histories, hot))
        return table_of(
            rows_of(g=part.column("g").to_pylist(), part=[p] * n, a=answers, b=told),
            rows_of(g=[-1], part=[p], a=[squeeze(one_at[seen], True)], b=[squeeze(two[at][seen])], c=[squeeze(total[seen])]),
            rows_of(id=[-1], vec=[classes(total)]),
            rows_of(id=histories[often].astype(np.int64).tolist(), vec=vec[often].tolist()),
        )

    return materialise(asked.groupBy("part").applyInArrow(count, BLOCK), "lm-bigrams")


def log_p(c: np.ndarray, w: np.ndarray, vec: np.ndarray, totals: Totals) -> np.ndarray:
    """log10 of P(word | history) from the bigram's count, the word's count and the history's classes."""
    e, over, unknown = totals.unigram_p()
    d = discounts(list(totals.bigram))
    r = np.arange(1, K + 1)
    low = lambda x, v: v[np.minimum(x, K + 1)] * x
    unigram = np.where(w > 0, low(w, e) / over, unknown)
    m, mine = vec[:, :K], (vec[:, :K] * r).sum(1) + vec[:, K]
    some = m.any(1)  # else no bigram of the history is discounted: one count is kept for the unseen
    whole = np.where(some, mine, mine + 1).astype(float)
    left = np.where(some, (m * r * (1 - d[1 : K + 1])).sum(1), 1.0) / whole
    seen = ((vec[:, K + 1 : 2 * K + 1] * r * e[1 : K + 1]).sum(1) + vec[:, 2 * K + 1]) / over
    with np.errstate(divide="ignore", invalid="ignore"):
        back = np.where(mine > 0, left / (1 - seen), 1.0)
        return np.log10(np.where(c > 0, low(c, d) / whole, back * unigram))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_tokens: int = 2_000_000, word_part: int = 64_000_000, pair_part: int = 16_000_000) -> DataFrame:
    """Train on the documents that aren't held out, and score all: the id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Held out is a document whose id as text (null: empty) has a CRC-32 divisible by 10. A-Z is lower-cased, words are split
    at ASCII white space, and each document ends by an end token. A null or empty text is its end token only. Repeated rows
    are counted and scored each. Without training documents every token is unknown and has probability one. An empty table
    gives no rows. Words are told apart by a 64-bit hash.

    word_part and pair_part are the characters of text for a partition of the unigram and the bigram table, so a partition
    is of fixed size; group_tokens bounds a group of documents, but for the end of its last.
    """
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    parts, pair_parts = max(12, -(-chars // word_part)), max(12, -(-chars // pair_part))
    groups = gather(docs, id_col, text_col, parts, group_tokens)
    words = unigrams(groups, parts)
    tokens, kinds, *n = summed(words, K + 3)
    often = words.where(F.col("id") >= 0).where(F.col("vec")[0] * HOT > tokens).select("id").collect()  # fewer than HOT
    hot = np.array([START, *(r[0] for r in often)], np.uint64)
    pairs = bigrams(questions(groups, words, pair_parts, hot), hot)
    totals = Totals(tokens, kinds, tuple(n), tuple(summed(pairs, K + 1)))
    sums = F.array(*(F.sum(F.col("vec")[i]) for i in range(2 * K + 2)))
    by_hot = pairs.where(F.col("id") >= 0).groupBy("id").agg(sums.alias("vec")).collect()  # at most HOT rows
    frequent = dict((int(r[0]), list(r[1])) for r in by_hot)
    kind = docs.schema[id_col].dataType.simpleString()

    def evaluate(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return empty
        is_word = pa.array([k == 1 for k in answers.column("kind").to_pylist()])
        x = Group(docs, answers.filter(is_word), pair_parts, hot)
        mine = answers.filter(pc.invert(is_word))
        mine = sorted(zip(mine.column("part").to_pylist(), mine.column("a").to_pylist(), mine.column("b").to_pylist(), strict=True), key=lambda y: y[0])
        o = x.order
        c = np.concatenate([unsqueeze(a) for _, a, _ in mine]).astype(np.int64)
        classes_ = np.concatenate([unsqueeze(b).astype(np.int64).reshape(2 * K + 2, -1).T for _, _, b in mine])
        new = np.ones(len(o), bool)
        new[1:] = (x.one[o][1:] != x.one[o][:-1]) | (x.part[o][1:] != x.part[o][:-1])
        vec = classes_[np.cumsum(new) - 1]
        is_hot = x.is_hot[o]
        if is_hot.any():
            keys, at = np.unique(x.one[o][is_hot], return_inverse=True)
            vec[is_hot] = np.array([frequent.get(int(k), [0] * (2 * K + 2)) for k in keys], np.int64)[at]
        logs = np.empty(len(o))
        logs[o] = log_p(c, x.counts[x.word[o]].astype(np.int64), vec, totals)
        w = x.counts[x.words].astype(np.int64)
        base = np.log10((w + 0.1) / (totals.tokens + 0.1 * (totals.kinds + 1)))
        by_doc = lambda v: np.add.reduceat(v, x.first)
        n = len(x.ids)
        return pa.table([pa.array(x.ids, id_type), pa.array([held_out(i) for i in x.ids]), pa.array(x.sizes), pa.array(by_doc((w > 0).astype(np.int64))), pa.array([totals.tokens] * n, pa.int64()), pa.array(by_doc(base)), pa.array(by_doc(logs[x.pair]))], names)

    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    empty = pa.table([pa.array([], t) for t in (id_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names)
    left = groups.where("part IS NULL").select("g", "ids", "sizes", "words")
    answers = words.where("g >= 0").select("g", "part", "a", "b", F.lit(1).alias("kind")).union(pairs.where("g >= 0").select("g", "part", "a", "b", F.lit(2).alias("kind")))
    return left.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(evaluate, f"{id_col} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

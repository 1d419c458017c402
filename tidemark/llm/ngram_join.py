"""Jaccard join of documents' word n-gram sets: a size-aware heavy-light join, and the groups that its links make.

Sets up to a boundary are light: each enumerates its subsets of every size that an intersection may have, and two light
sets that link have such a subset in common. Larger sets are heavy: they are entered into the inverted lists of their first
n-grams in an order of all n-grams, so many that two sets that link have one of those in common, and the lists are scanned.
In that order frequent n-grams come last, so a passage that many documents share makes no long lists. Any order gives all
links; how frequent n-grams are only decides the cost. The boundary is the size at which enumerating a set begins to cost
more than its entries in lists.

A list is split where its members' sizes leave a gap that no link crosses, and members leave it that parity sketches, which rule
links out and never in, leave no partner in it. Lists name candidates only. They are resolved in rounds: each set is compared
with the list head that it meets most often, by sketch and then by text; links are joined to groups, and lists whose members are
all in one group are done. Lists that stay open are compared in full within bounded tiles. Every link follows from the texts themselves. Each table in the shared folder goes
once its successor is written.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, keyed, materialise, small_batches, without_rows
from tidemark.llm.words import M3, flat, gram_sets, mixed
from tidemark.operators.graph import components


def salted(x: np.ndarray | int, *salts: np.ndarray | int) -> np.ndarray:
    out = np.atleast_1d(np.asarray(x, np.uint64))
    for s in salts:
        out = mixed(out + (np.atleast_1d(np.asarray(s, np.uint64)) + np.uint64(1)) * M3)
    return out


class Scheme:
    """How a set of n n-grams is entered, for links at a Jaccard similarity of percent / 100 or more. list_cost is the cost of
    an entry in a list, which is scanned, over that of a subset, which hardly any other set shares by chance."""

    def __init__(self, percent: int = 90, list_cost: float = 10.0) -> None:
        self.percent = percent
        self.boundary = next(n for n in range(1, 1 << 20) if self.enumerated(n + 1) > list_cost * self.entered(n + 1))

    def least(self, n: int) -> int:
        """The smallest intersection that a set of n can have with a set it links to."""
        return -(-self.percent * n // 100)

    def enumerated(self, n: int) -> int:
        return sum(comb(n, c) for c in range(self.least(n), n + 1))

    def entered(self, n: int) -> int:
        """Of so many first n-grams in any order, linked sets have one in common."""
        return n - self.least(n) + 1

    def keys(self, grams: np.ndarray, frequent: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The keys of the subsets and lists in which a set is found; frequent n-grams (sorted) have places in the order
        after all others."""
        n, out = len(grams), []
        if not n:
            return np.zeros(0, np.uint64)
        if n <= self.boundary:
            m = mixed(grams)
            whole = m.sum(dtype=np.uint64)
            for c in range(self.least(n), n + 1):
                gone = np.array([m[list(x)].sum(dtype=np.uint64) for x in combinations(range(n), n - c)], np.uint64)
                out.append(salted(whole - gone, 1 << 32, c))
        if n >= self.least(self.boundary + 1):
            first = grams
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
                often = frequent[at] == grams
                if often.any():
                    first = np.concatenate([grams[~often], grams[often][np.argsort(place[at[often]], kind="stable")]])
            out.append(salted(first[: self.entered(n)], 1))
        return np.concatenate(out)


_NODE_BITS = 64


def identity(grams: np.ndarray, bits: int) -> tuple[int, int]:
    """A set's 128-bit hash, as a node (its first bits) and a check."""
    from xxhash import xxh3_128_intdigest

    h = xxh3_128_intdigest(grams.tobytes())
    return h >> (128 - bits), h & ((1 << 64) - 1)


def survey(rows: DataFrame, size: int, flush: int = 4_000_000, least: int = 2) -> DataFrame:
    """Rows of two kinds, written to the shared folder: (row_key, id, n, node, check, s) a document, where s, the set's sketch, is
    there for the first of the copies in a run of rows; (gram, times) an n-gram that `least` distinct sets of a run hold.

    All texts are read and counted; a run ends at `flush` n-grams.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    bits = _NODE_BITS
    names = ["row_key", "id", "n", "node", "check", "s", "gram", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        count, id_type = 0, None

        def counted() -> pa.RecordBatch:
            g, n = np.unique(np.concatenate(held), return_counts=True)
            g, n = g[n >= least], n[n >= least]
            none = [pa.nulls(len(g), t) for t in (pa.int64(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*none, signed(g), pa.array(n, pa.int64())], names)

        for b in batches:
            id_type = b.column("id").type
            n, marks = [], []
            ids = np.zeros((b.num_rows, 2), np.uint64)
            for i, g in enumerate(gram_sets(b.column("t"), size)):
                n.append(len(g))
                who = identity(g, bits)
                ids[i] = who
                new = len(g) > 0 and who not in seen
                marks.append(sketch(g) if new else None)
                if new:
                    seen.add(who)
                    held.append(g)
                    count += len(g)
                    if count >= flush:
                        yield counted()
                        held, seen, count = [], set(), 0
            k = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("row_key"), b.column("id"), pa.array(n, pa.int64()), signed(ids[:, 0].copy()), signed(ids[:, 1].copy()), pa.array(marks, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)
        if held:
            yield counted()

    return materialise(rows.select("row_key", "id", "t").mapInArrow(run, f"row_key long, id {kind}, n long, node long, check long, s binary, gram long, times long"), "ngram-survey")


def frequent_grams(surveyed: DataFrame, most: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that stand in the most distinct sets, sorted, and their places by that number: `most` at most, cut where 16
    steps to a doubling of the number allow, so only the steps' counts and the list itself reach the driver."""
    counts = surveyed.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("n")).withColumn("step", F.floor(16 * F.log2("n")).cast("int"))
    counts = materialise(counts, "ngram-counts")
    room, cut = most, None
    for r in counts.groupBy("step").agg(F.count("*").alias("k")).orderBy(F.desc("step")).collect():  # 16 rows to a doubling
        room -= r["k"]
        if room < 0:
            break
        cut = r["step"]
    top = counts.where(F.col("step") >= cut).select("gram", "n").toPandas() if cut is not None else None
    discard(counts)
    if top is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams, n = top["gram"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.lexsort((grams, -n))
    place = np.empty(len(grams), np.int64)
    place[order] = np.arange(len(grams))[::-1]
    order = np.argsort(grams)
    return grams[order], place[order]


def clashes(surveyed: DataFrame) -> list[int]:
    """Nodes that two sets share, of which N sets have N * N / 2^65 on average: 271 at 10^11. Such sets go by their check."""
    two = surveyed.where("n > 0").groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo < hi")
    return [r[0] for r in two.select("node").collect()]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def squeezed(x: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed differences, byte planes apart."""
    import zstandard

    d = np.diff(x, prepend=np.uint64(0))
    return zstandard.compress(d.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unsqueezed(b: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def entries(rows: DataFrame, scheme: Scheme, size: int, ranges: int, frequent: tuple[np.ndarray, np.ndarray], clashing: list[int], flush: int = 4_000_000) -> DataFrame:
    """(part, keys, nodes): blocks of parts of the key range, whose keys are sorted and whose nodes, with their sizes, stand in
    the same order. They are read once, by lists(), so they are only written for its exchange."""
    often = rows.sparkSession.sparkContext.broadcast(frequent)  # a list of bounded length
    twice, bits = {x & ((1 << 64) - 1) for x in clashing}, _NODE_BITS
    width = np.uint64((1 << 64) // ranges + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int, int]] = []
        seen: set[int] = set()
        count = 0

        def blocks() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _, _ in held])
            at = np.repeat(np.arange(len(held)), [len(k) for k, _, _ in held])
            nodes, sizes = np.array([x for _, x, _ in held], np.uint64), np.array([n for _, _, n in held], np.uint32)
            order = np.argsort(keys)
            keys, at = keys[order], at[order]
            part = (keys // width).astype(np.int32)
            cut = np.flatnonzero(np.diff(part)) + 1
            ks = np.split(keys, cut)
            parts = [int(p[0]) for p in np.split(part, cut)]
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(map(squeezed, ks), pa.binary()), pa.array([node_bytes(nodes, sizes, x) for x in np.split(at, cut)], pa.binary())], ["part", "keys", "nodes"])

        for b in batches:
            for g in gram_sets(b.column("t"), size):
                if not len(g):
                    continue
                node, check = identity(g, bits)
                node = check if node in twice else node
                if node not in seen:  # a set's copies in this run are entered once
                    seen.add(node)
                    held.append((scheme.keys(g, *often.value), node, len(g)))
                    count += len(held[-1][0])
                    if count >= flush:
                        yield blocks()
                        held, count, seen = [], 0, set()
        if held:
            yield blocks()

    return rows.select("t").mapInArrow(run, "part int, keys binary, nodes binary")


def node_bytes(nodes: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> bytes:
    """nodes[at] and sizes[at]: the distinct ones, and places among them."""
    import zstandard

    used, place = np.unique(at, return_inverse=True)
    kind = np.uint16 if len(used) <= 1 << 16 else np.uint32
    return len(used).to_bytes(4, "little") + zstandard.compress(nodes[used].tobytes() + sizes[used].tobytes() + place.astype(kind).tobytes(), 1)


def nodes_from(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    n, raw = int.from_bytes(b[:4], "little"), zstandard.decompress(b[4:])
    at = np.frombuffer(raw[12 * n :], np.uint16 if n <= 1 << 16 else np.uint32)
    return np.frombuffer(raw[: 8 * n], np.uint64)[at], np.frombuffer(raw[8 * n : 12 * n], np.uint32)[at]


def lists(found: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, weight): the members of every key that two or more nodes have, split where a member is too large for the
    one before it. Lists with the same members are one bucket, named by a hash of those, whose weight is their number."""

    def scan(part: pa.Table) -> pa.Table:
        keys = np.concatenate([unsqueezed(b) for b in part.column("keys").to_pylist()])
        both = [nodes_from(b) for b in part.column("nodes").to_pylist()]
        nodes, n = np.concatenate([x for x, _ in both]), np.concatenate([x for _, x in both]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        again = np.zeros(len(k), bool)
        again[1:] = k[1:] == k[:-1]
        again[:-1] |= again[1:]
        order = order[again]  # keys that one node alone has are most
        keys, nodes, n = keys[order], nodes[order], n[order]
        order = np.lexsort((nodes, n, keys))
        keys, nodes, n = keys[order], nodes[order], n[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes, n = keys[new], nodes[new], n[new]
        begins = np.ones(len(keys), bool)
        begins[1:] = (keys[1:] != keys[:-1]) | (100 * n[:-1] < percent * n[1:])
        starts = np.flatnonzero(begins)
        sizes = np.diff(starts, append=len(keys))
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(nodes), dtype=np.uint64)])
        shared = sizes > 1
        s, m = starts[shared], sizes[shared]
        if not len(s):
            return pa.table({"bucket": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "weight": pa.array([], pa.int64())})
        names, first, weight = np.unique(salted(prefix[s + m] - prefix[s], m.astype(np.uint64)), return_index=True, return_counts=True)
        s, m = s[first], m[first]
        rows = np.repeat(s - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(m.sum())
        return pa.table({"bucket": signed(np.repeat(names, m)), "node": signed(nodes[rows]), "weight": pa.array(np.repeat(weight, m), pa.int64())})

    members = found.groupBy("part").applyInArrow(scan, "bucket long, node long, weight long")
    return materialise(members.groupBy("bucket", "node").agg(F.sum("weight").alias("weight")), "ngram-lists")


def sketch(grams: np.ndarray) -> bytes:
    """In which of one to two classes an n-gram a set has an odd number of n-grams. Two sketches differ in no more classes than
    the number of n-grams that only one of the sets has, so they can rule a link out, never in."""
    width = 1 << max(7, len(grams).bit_length())
    return np.packbits((np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(bool), bitorder="little").tobytes()


def folded(x: bytes, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, words), axis=0)


def apart(x: bytes, y: bytes) -> int:
    words = min(len(x), len(y)) // 8
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches don't rule out."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("na", "nb", "sa", "sb")), strict=True)
            hit = [(100 + percent) * apart(x, y) <= (100 - percent) * (n + m) for n, m, x, y in rows]
            yield b.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    side = lambda k: sketches.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("s").alias(f"s{k}"))
    near = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(near).mapInArrow(test, "a long, b long")


def texts_of(nodes: DataFrame, first: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, t): the texts of these nodes, from the row that stands for each. Where Spark finds the nodes few by the size of
    their table, it broadcasts their row keys, so only their texts move."""
    wanted = materialise(nodes.distinct().join(first, "node"), "ngram-wanted")
    return rows.join(wanted, "row_key").select("node", "t")


def compared(pairs: DataFrame, first: DataFrame, rows: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) of nodes whose texts link."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, None
        for b in batches:
            hit = []
            for k, x, i in zip(b.column("b").to_pylist(), gram_sets(b.column("ta"), size), range(b.num_rows), strict=True):
                if k != last:
                    last, mine = k, next(gram_sets(b.column("tb").slice(i, 1), size))
                hit.append(linked(x, mine, percent))
            yield b.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    texts = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), first, rows)
    side = lambda k: texts.select(F.col("node").alias(k), F.col("t").alias(f"t{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(test, "a long, b long")


class Marks:
    """Sets by size, with their sketches: which pairs of them a link isn't ruled out for."""

    def __init__(self, sizes: np.ndarray, marks: pa.Array | list[bytes], percent: int) -> None:
        self.n, self.percent = np.asarray(sizes, np.int64), percent
        self.data, at = flat(marks if isinstance(marks, pa.Array) else pa.array(marks, pa.binary()))
        self.start, self.width = at[:-1], np.diff(at) // 8

    def rows(self, at: np.ndarray, words: int) -> np.ndarray:
        """The sketches of these sets, of one width, folded to `words` words."""
        wide = int(self.width[at[0]])
        m = self.data[self.start[at][:, None] + np.arange(8 * wide)].view(np.uint64)
        return m if wide == words else np.bitwise_xor.reduce(m.reshape(len(at), wide // words, words), axis=1)

    def possible(self, a: np.ndarray, b: np.ndarray, block: int = 1 << 16) -> np.ndarray:
        """Which pairs (a, b) may link."""
        n, p = self.n, self.percent
        a, b = np.where(n[a] <= n[b], a, b), np.where(n[a] <= n[b], b, a)
        ok = 100 * n[a] >= p * n[b]
        kinds = self.width[a] * (1 << 32) + self.width[b]
        for kind in np.unique(kinds[ok]):
            words = int(min(kind >> 32, kind & 0xFFFFFFFF))
            of_kind = np.flatnonzero(ok & (kinds == kind))
            step = max(1, block // words)
            for i in range(0, len(of_kind), step):
                at = of_kind[i : i + step]
                far = np.bitwise_count(self.rows(a[at], words) ^ self.rows(b[at], words)).sum(1, dtype=np.int64)
                ok[at] = (100 + p) * far <= (100 - p) * (n[a[at]] + n[b[at]])
        return ok

    def candidates(self, members: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each of these sets, and those of them no smaller that may link with it."""
        order = members[np.argsort(self.n[members], kind="stable")]
        n = self.n[order]
        ends = np.searchsorted(n, n * 100 // self.percent, "right")
        for i, end in enumerate(ends):
            others = order[i + 1 : end]
            if len(others):
                others = others[self.possible(np.full(len(others), order[i]), others)]
                if len(others):
                    yield int(order[i]), others


def unit_rows(units: np.ndarray) -> dict[int, np.ndarray]:
    """Of rows by unit: for each size that a unit has, a matrix of the rows of those units."""
    order = np.argsort(units, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], units[order][1:] != units[order][:-1]])) if len(units) else np.zeros(0, np.int64)
    sizes = np.diff(starts, append=len(units))
    return {int(k): order[starts[sizes == k][:, None] + np.arange(k)] for k in np.unique(sizes)}


def hopeful(members: DataFrame, sketches: DataFrame, percent: int, tile: int = 4096, task_rows: int = 20_000, short: int = 32) -> DataFrame:
    """The rows (unit, node, label) of units (with total) whose node has a possible partner with another label there, by the
    sketches. Units are compared in tiles; in short ones all pairs are told at once."""

    def test(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        labels = group.column("label").to_numpy()
        marks = Marks(group.column("n").to_numpy(), group.column("s").chunk(0), percent) if group.num_rows else None
        keep = np.zeros(group.num_rows, bool)
        for k, rows in unit_rows(group.column("unit").to_numpy()).items():
            if k == 1:
                continue
            if k <= short:
                i, j = np.triu_indices(k, 1)
                a, b = rows[:, i].ravel(), rows[:, j].ravel()
                told = labels[a] != labels[b]
                a, b = a[told], b[told]
                ok = marks.possible(a, b)
                keep[a[ok]] = keep[b[ok]] = True
                continue
            for unit in rows:
                for i, found in marks.candidates(unit):
                    other = found[labels[found] != labels[i]]
                    if len(other):
                        keep[i] = True
                        keep[other] = True
        return group.select(["unit", "node", "label"]).filter(pa.array(keep))

    return dealt(members, tile, task_rows).join(sketches, "node").groupBy("u", "x", "y").applyInArrow(test, "unit long, node long, label long").distinct()


def dealt(members: DataFrame, tile: int, task_rows: int) -> DataFrame:
    """(u, x, y, unit, node, label): units (unit, node, label, total) dealt out as pairs of tiles of about `tile` members, small
    units several to a task."""
    bins = max(1, members.count() // task_rows)
    tiles = members.withColumn("tiles", F.greatest(F.ceil(F.col("total") / tile), F.lit(1)).cast("int"))
    tiles = tiles.withColumn("mine", F.pmod(F.xxhash64("node", "unit"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiles = tiles.select("unit", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "node", "label", F.pmod(F.xxhash64("unit"), F.lit(bins)).alias("bin"), "tiles")
    one = F.col("tiles") == 1
    task = [F.when(one, -1).otherwise(F.col("unit")).alias("u"), F.when(one, F.col("bin")).otherwise(F.col("lo")).cast("int").alias("x"), F.when(one, 0).otherwise(F.col("hi")).alias("y")]
    return tiles.select(*task, "unit", "node", "label")


def compared_in_full(members: DataFrame, sketches: DataFrame, first: DataFrame, rows: DataFrame, percent: int, size: int, tile: int = 512, task_rows: int = 250) -> DataFrame:
    """Links (a, b) that join all linked members of each unit (unit, node, label, total) across labels.

    Sketches tell first which members have any possible partner; only their texts are moved, in tiles of `tile`. In each of
    those, only pairs that no link found before has joined are emitted, so a tile gives fewer links than members.
    """

    def test(group: pa.Table) -> pa.Table:
        sets = [g for chunk in group.column("t").chunks for g in gram_sets(chunk, size)]
        nodes, labels = group.column("node").to_pylist(), group.column("label").to_pylist()
        marks = Marks(np.array([len(x) for x in sets]), [sketch(x) for x in sets], percent)
        root = {x: x for x in labels}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for of_size in unit_rows(group.column("unit").to_numpy()).values():
            for unit in of_size:
                for i, found in marks.candidates(unit):
                    for j in found:
                        x, y = find(labels[i]), find(labels[j])
                        if x != y and linked(sets[i], sets[j], percent):
                            root[x] = y
                            out.append((nodes[i], nodes[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    told = materialise(hopeful(members, sketches, percent), "ngram-hopeful")
    total = materialise(told.groupBy("unit").agg(F.count("*").alias("total")), "ngram-sizes")
    texts = texts_of(told.select("node"), first, rows)
    return dealt(told.join(total, "unit"), tile, task_rows).join(texts, "node").groupBy("u", "x", "y").applyInArrow(test, "a long, b long")


def units(left: DataFrame, tile: int = 4096) -> DataFrame:
    """Open buckets as units of full comparison. Buckets that overlap make a family; a family is one unit where that hands out
    fewer sketches than its buckets would, which is told from the numbers of its members and entries.

    A family may hold most of the rows, so its sizes are taken after a distinct by member, and written: Spark broadcasts them
    if they are few, else splits the join.
    """
    tied = left.select(F.col("label").alias("a"), F.col("head.label").alias("b"))  # groups, of which there are fewer than members
    labels = components(tied).toDF("label", "family")
    family = materialise(left.join(labels, "label"), "ngram-families")
    discard(labels)
    entered = family.groupBy("family", "node").agg(F.count("*").alias("k")).groupBy("family").agg(F.count("*").alias("n"), F.sum("k").alias("entries"))
    whole = materialise(entered.where(F.col("n") * F.ceil(F.col("n") / tile) <= F.col("entries")).select("family", "n"), "ngram-family-sizes")
    chosen = family.join(whole, "family", "left")
    one = chosen.where("n IS NOT NULL").select(F.col("family").alias("unit"), "node", "label", F.col("n").alias("total")).distinct()
    out = materialise(one.union(chosen.where("n IS NULL").select("bucket", "node", "label", "total")), "ngram-units")
    discard(family, whole)
    return out


def decided(rows: DataFrame, percent: int, size: int, part_grams: int = 4_000_000) -> DataFrame:
    """row_key, id, n, component of written rows (row_key, id, t). A part of the key range stands for part_grams n-grams of all sets, so a
    task's share is of fixed size."""
    spark = rows.sparkSession
    scheme = Scheme(percent)
    surveyed = survey(rows, size)
    total = surveyed.agg(F.sum("n")).first()[0] or 0
    clashing = clashes(surveyed)
    members = lists(entries(rows, scheme, size, max(12, -(-total // part_grams)), frequent_grams(surveyed), clashing), percent)
    named = surveyed.where("row_key IS NOT NULL").withColumn("node", F.when(F.col("node").isin(clashing), F.col("check")).otherwise(F.col("node")) if clashing else F.col("node"))
    sets = materialise(named.select("row_key", "id", "n", "node"), "ngram-sets")
    some = materialise(members.select("node").distinct(), "ngram-members")
    first = materialise(sets.where("n > 0").groupBy("node").agg(F.min("row_key").alias("row_key")).join(some, "node"), "ngram-first")
    sketches = materialise(named.where("s IS NOT NULL").join(some, "node").groupBy("node").agg(F.first("n").alias("n"), F.first("s").alias("s")), "ngram-sketches")
    discard(surveyed, some)
    # Most lists are met by chance or by a passage; what the sketches leave of them is near copies.
    size_of = materialise(members.groupBy("bucket").agg(F.count("*").alias("total")), "ngram-sizes")
    open_lists = hopeful(members.join(size_of, "bucket").select(F.col("bucket").alias("unit"), "node", F.col("node").alias("label"), "total"), sketches, percent)
    met_by = materialise(open_lists.select(F.col("unit").alias("bucket"), "node").join(members, ["bucket", "node"]), "ngram-lists")
    discard(members, size_of)
    members = met_by

    links, written = spark.createDataFrame([], "a long, b long"), []
    for step in range(3):
        labels = components(links) if step else None
        at = F.coalesce("label", "node") if step else F.col("node")
        with_labels = (members.join(labels, "node", "left") if step else members).withColumn("label", at)
        of_list = with_labels.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("total"), F.min(F.struct("node", "label")).alias("head"))
        heads = materialise(of_list.where("lo < hi").select("bucket", "total", "head"), "ngram-heads")
        left = materialise(with_labels.join(heads, "bucket"), "ngram-open")
        discard(heads)
        if labels is not None:
            discard(labels)
        discard(members)
        members = left.select("bucket", "node", "weight")  # a list that is closed stays closed
        if step < 2:
            met = left.where("label <> head.label").groupBy("node", F.col("head.node").alias("head")).agg(F.sum("weight").alias("weight"))
            best = met.groupBy("node").agg(F.max(F.struct("weight", "head")).alias("best")).select(F.col("node").alias("a"), F.col("best.head").alias("b"))
            pairs = materialise(possible(best, sketches, percent), "ngram-pairs")
            new = materialise(compared(pairs, first, rows, percent, size), "ngram-links")
            discard(pairs)
        else:
            unit = units(left)
            discard(left)
            new = materialise(compared_in_full(unit, sketches, first, rows, percent, size), "ngram-links")
            discard(unit)
        written.append(new)
        links = links.union(new)
    labels = components(links)
    discard(first, sketches, *written)
    named = materialise(sets.join(labels, "node", "left").select("row_key", "id", "n", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("component")), "ngram-named")
    discard(sets, labels)
    return named


def resolved(rows: DataFrame, percent: int, size: int) -> DataFrame:
    """row_key, id, n, first (the component's smallest id), kept."""
    named = decided(rows, percent, size)
    smallest = materialise(named.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("first"), F.min(F.struct(F.col("id").isNull(), "id", "row_key")).alias("keep"), F.count("*").alias("rows")).where("rows > 1"), "ngram-components")
    return named.join(smallest, "component", "left").select(
        "row_key", "id", "n", F.when(F.col("rows").isNull(), F.col("id")).otherwise(F.col("first")).alias("first"), F.coalesce(F.col("keep.row_key") == F.col("row_key"), F.lit(True)).alias("kept")
    )


def groups(docs: DataFrame, percent: int = 90, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, n_shingles, component_id (the smallest id reachable by links).

    Words are split at ASCII white space after lower-casing A-Z. Two texts link when their sets of distinct word n-grams
    have a Jaccard similarity of percent / 100 or more; a text with fewer words than `size` has its word sequence as the
    only n-gram. A null or empty text has none and links with nothing, not even another. Repeated rows are copies of one
    another; ids that tie or are null are allowed (a component of null ids only has a null one). Texts of any length are
    taken whole. An empty table gives no rows.
    """
    rows, key = keyed(docs, "ngram-rows", F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    out = resolved(rows.withColumnRenamed(key, "row_key"), percent, size)
    discard(rows)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = 90, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay when each group keeps its smallest id, all columns. Texts without words all stay; nulls,
    repeated rows and an empty table as in groups()."""
    rows, key = keyed(docs, "ngram-rows")
    out = resolved(rows.select(F.col(key).alias("row_key"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")), percent, size)
    return without_rows(rows, key, out)

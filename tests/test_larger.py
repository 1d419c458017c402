"""Queries against their SQL on tables that are larger, or repeat more, than the smallest ones."""

import random

import duckdb
import pytest

from tidemark import catalog
from tidemark.operators import mining, resolution, seeds
from tidemark.sources import archives


@pytest.fixture
def same(spark, tmp_path):
    """Checks a query against its SQL over these tables, by their names, in the rows' order."""

    def check(name, **tables):
        c = duckdb.connect()
        c.sql("set threads = 1")
        for t, sql in tables.items():
            c.sql(f"copy ({sql}) to '{tmp_path}/{t}.parquet'")
            c.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
        got = catalog.queries()[name](spark, str(tmp_path))
        columns = sorted(got.columns)
        want = c.sql(catalog.oracle_sql()[name]).select(*columns).fetchall()
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want, key=key)
        return want

    return check


def test_ties_take_the_first_row(same):
    for flags, status in (("R", "A"), "confirmed"), (("A", "R"), "conflicting"):
        rows = ", ".join(f"({k}, {supplier}, '{flag}')" for k in (1, 2, 4) for supplier, flag in ((0, flags[0]), (4, flags[1]), (1, "R")))
        got = same("a4_cross_source_agreement", lineitem=f"select k::bigint as l_orderkey, s::bigint as l_suppkey, f as l_returnflag, 1 as l_linenumber, timestamp '2020-01-01' as l_shipdate from (values {rows}) v(k, s, f)")
        assert len(got) == 3 and all(status in r for r in got)


LINES = "select k::bigint as l_orderkey, n::int as l_linenumber, (k % 50)::double as l_quantity from (select unnest([1, 2, 3, 4, 1000001, 1000002, 1000003, 1000004]) as k), (select unnest([1, 2, 3, 4]) as n)"


def test_seed_numbers_that_repeat(same):
    same("p19_seed_ingest", lineitem=LINES, orders="select k::bigint as o_orderkey, 'F' as o_orderstatus from (select unnest([2, 1000004]) as k)")


def test_a_new_study_is_named_as_told(spark):
    got = seeds.ingest(spark.createDataFrame([(7, "acc", "x"), (8, "acc", "x")], "seed_id long, type string, value string"), spark.createDataFrame([], "doi string"), spark.createDataFrame([], "type string, value string, study_id string"), lambda k: k.cast("string"))
    assert {tuple(r) for r in got.collect()} == {(7, "7"), (8, "7")}


def test_uids_of_several_records(same, spark):
    same("sc7_resolved_uids", lineitem=LINES)
    found = archives.resolved_uids(spark.createDataFrame([("B", 1, 9), ("B", 2, 5)], "accession string, position int, uid long"), spark.createDataFrame([(5, "A"), (5, " b"), (5, "b"), (9, None)], "uid long, own string"))
    assert [tuple(r) for r in found.collect()] == [("B", 5, False)]


@pytest.mark.parametrize("form", ["pairs", "classes"])
def test_resolution_without_pairs(spark, form):
    """Identifiers of many studies against brute force: the smallest study that no lineage links, and the consistent one."""
    rng = random.Random(7)
    studies = [(s, rng.choice([None, rng.randrange(400)]), rng.choice([None, None, rng.randrange(3)])) for s in range(390)]
    known = [(rng.randrange(400), "doi", str(rng.choice([0, 0, 1, 2]))) for _ in range(600)] + [(9, "doi", "7"), (8, "biosample_accession", "1")]
    evidence = [(i, rng.choice([None, *range(0, 400, 7)]), rng.choice(["doi", "doi", "biosample_accession"]), str(rng.choice([0, 1, 2, 7, 8])), rng.choice(["structured_source", "explicit", "inferred"]), i % 5) for i in range(700)]
    parent, root = {s: p for s, p, _ in studies}, {s: s if r is None else r for s, _, r in studies}
    ok = lambda s, o: o % 5 < 2 and (s + o) % 2 == 0
    have, firsts = {}, {}
    for s, t, v in known:
        have.setdefault((t, v), set()).add(s)
    for i, s, t, v, _, at in sorted(evidence, key=lambda e: (e[5], e[0])):
        if (t, v) not in have:
            firsts.setdefault((t, v), (i, s))
    want = set()
    for i, s, t, v, how, _ in evidence:
        others = have.get((t, v)) or {firsts[t, v][1]}
        free = sorted(o for o in others if None not in (s, o) and o != s and not (parent.get(s) == o or parent.get(o) == s or (s in root and o in root and root[s] == root[o])))
        good = [o for o in free if ok(s, o)]
        merged = free[0] if free and len(others) == 1 and how == "structured_source" else good[0] if good and how != "inferred" else None
        what = "record" if firsts.get((t, v), (None,))[0] == i else "noop" if s in others and s is not None else "share" if t != "doi" or not free else "sibling" if merged is None else "merge"
        want.add((i, what, {"merge": merged, "sibling": free[0] if free else None}.get(what)))
    ids = range(400)
    of = spark.createDataFrame
    pairs = of([(s, o, ok(s, o)) for s in range(0, 400, 7) for o in ids], "study_id long, other long, consistent boolean")
    classes = of([(s, s % 2) for s in ids], "study_id long, class int"), of([(o, o % 2) for o in ids if o % 5 < 2], "other long, class int")
    got = resolution.resolve(of(evidence, "evidence_id long, study_id long, type string, value string, confidence string, created_at long"), of(known, "study_id long, type string, value string"), of(studies, "study_id long, parent_id long, root_id long"), pairs if form == "pairs" else classes)
    assert {(r.evidence_id, r.decision, r.other) for r in got.collect()} == want


@pytest.mark.parametrize(("members", "visits"), [(10**6, 10**9), (300, 2000)])
def test_siblings_without_pairs(spark, members, visits):
    """Shared prefixes, equal lists, repeated links, nulls and lonely studies against brute force, in one cell and in a grid."""
    rng = random.Random(3)
    links = [(f"s{rng.randrange(150)}", min(rng.randrange(60), rng.randrange(60))) for _ in range(900)] * 2 + [("lone", 99), (None, 1), ("s1", None), ("x", 98), ("y", 98), ("z", 98)]
    own, of = {}, {}
    for s, e in links:
        if s is not None and e is not None:
            own.setdefault(s, set()).add(e)
            of.setdefault(e, set()).add(s)
    want = {s: len(set().union(*(of[e] for e in es))) - 1 for s, es in own.items()}
    out = mining.siblings(spark.createDataFrame(links, "study_id string, entity_id long"), members, visits)
    assert "SortMergeJoin" not in out._jdf.queryExecution().toString() and "BroadcastHashJoin" not in out._jdf.queryExecution().toString()
    assert {r.study_id: r.n for r in out.collect()} == {s: n for s, n in want.items() if n}


def test_a_long_text_fills_no_more_than_the_bound():
    from tidemark.llm import bpe, packing
    from tidemark.llm.queries import WORDS

    words = packing.WordBpe(bpe.rank_file(WORDS).decode(), most=100)
    text = " ".join(f"w{i}" for i in range(1000)).encode()
    assert words.encode(text) == b"".join(map(words.stretch, text.split()))
    assert len(words.known) <= 100

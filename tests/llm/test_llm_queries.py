"""Registered queries: SQL oracles where there are some, the pipeline's stages, and the entry's guard."""

import importlib
import sys

import duckdb
import pytest

from tidemark.llm import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_names():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 11)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda x: sorted(map(repr, x))
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want.select(*columns).fetchall())


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        path = __import__("tidemark.shared", fromlist=["scratch"]).scratch(spark, "test-stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.count())
    assert kept[0] > kept[1] > kept[2] >= kept[3] == kept[4] > 0
    out = corpus_pipeline.run(spark, sf)
    assert out.select("doc_id").distinct().count() == kept[4]


def test_entry_registers_all():
    entry = importlib.import_module("__spark_entry__")
    assert {*queries.queries(), "pipeline"} <= set(entry.queries())
    assert "pipeline" not in entry.oracle_sql()
    assert "tidemark.llm" in sys.modules

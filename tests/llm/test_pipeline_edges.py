"""The pipeline's stages over null, empty and repeated rows, clashing column names, and an empty table."""

import corpus_pipeline
import pytest

from tidemark.llm.common import materialise

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row_key long, row_key_ string, kept boolean, cut string, found int, blob string, id int, t string, node long, label int"
WORDS = " ".join(f"word{i}" for i in range(60))


def rows():
    extra = (5, "k", False, "c", 1, "b", 2, "t", 3, 4)
    docs = [(1, WORDS, "en", "a", 9), (1, WORDS, "en", "a", 9), (None, WORDS, "en", "a", 9), (2, None, "en", "a", None), (3, "", None, None, 0), (4, WORDS.upper() + " password = 'abcdefghijklmn0'", "en", None, 3), (5, WORDS.replace(" ", "\n"), "en", "b", 1)]
    return [(*d, *extra) for d in docs]


def expected(k, docs):
    """What each stage keeps of the rows, by id and text."""
    own = [(d[0], d[1]) for d in docs]
    if k == 0:
        return [x for x in own if x[1] and len(x[1].split()) >= 50]
    if k == 1:
        return [(1, WORDS), (2, None), (4, own[5][1])]  # a null is an empty text, so 3 is a copy of 2; 5 differs in white space only
    if k == 2:
        return [(1, WORDS), (2, None), (3, "")]  # without words texts are linked with nothing
    return [(d, t and t.replace("password = 'abcdefghijklmn0", "[SECRET]")) for d, t in own]


@pytest.mark.parametrize("k", range(4))
def test_stage(spark, k):
    _, stage = corpus_pipeline.STAGES[k]
    docs = spark.createDataFrame(rows(), COLUMNS)
    out = stage(spark, docs, "")
    assert out.dtypes == docs.dtypes
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=key) == sorted(expected(k, rows()), key=key)
    assert {tuple(r)[5:] for r in out.collect()} == {rows()[0][5:]}
    assert stage(spark, docs.where("false"), "").count() == 0


def test_packing(spark):
    docs = materialise(spark.createDataFrame(rows(), COLUMNS), "edges")
    _, stage = corpus_pipeline.STAGES[4]
    out = stage(spark, docs, "").collect()
    assert {r.doc_id for r in out} == {None, 1, 2, 3, 4, 5}
    assert [(r.doc_tokens, r.length) for r in out if r.doc_id in (2, 3)] == [(1, 1)] * 2
    tokens = {r.doc_id: r.doc_tokens for r in out}
    for d in tokens:  # document 1 is there twice
        assert sum(r.length for r in out if r.doc_id == d) == tokens[d] * (2 if d == 1 else 1)
    assert stage(spark, docs.where("false"), "").count() == 0


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

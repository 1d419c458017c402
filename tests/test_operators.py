"""Semantics that the tables don't exercise: nulls, ties, order, edge values, files, streams."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark import keys as K
from tidemark.functions import identifiers as I
from tidemark.functions import values as V
from tidemark.operators import checks, extraction, graph, links, mapping, predicates, seeds, tasks, texts
from tidemark.plans import export
from tidemark.sources import payloads, supplements
from tidemark.sources import seeds as seed_files
from tidemark.streaming import events as stream


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(column(F.col("v"))).collect()]


def test_identifiers(spark):
    assert one(spark, I.doi, " https://doi.org/10.1234/AbC/ ", "doi:10.1234/x open_in_new", "10.12/x", None, "10.1234/xexternal link") == ["10.1234/abc", "10.1234/x", None, None, "10.1234/x"]
    assert one(spark, I.guess, "PRJEB12", "samn3", "ERP9", "PMC12", "12", "GCF_000001405.40", "what", "10.1234/Q") == ["bioproject_accession", "biosample_accession", "ena_study_accession", "pmcid", "pmid", "assembly_accession", None, "doi"]
    df = spark.createDataFrame([(1, "SRR008-SRR011 and srr009; ERS5 - 900, PRJNA7")], "k int, t string")
    got = {r.accession for r in I.accessions(df, "k", "t").collect()}
    assert got == {"SRR008", "SRR009", "SRR010", "SRR011", "ERS5", "PRJNA7"}


def test_depths_dates_coordinates(spark):
    assert one(spark, V.metres, "5cm", "5 mm", "5 cm", "1,500 m", "2 km", "deep", "0.05") == ["5", "5", "0.05", "1500", "2000", None, "0.05"]
    assert one(spark, V.max_metres, "0–20 m", "20 to 5 m", "7") == ["20", "20", "7"]
    assert one(spark, V.event_date, "14 March 2021", "March 2021", "2021", "2021-03-14", "spring") == ["2021-03-14", "2021-03", "2021", "2021-03-14", None]
    assert one(spark, V.latitude, "38.03 N 122.15 W", "-38.5, 10", "90 s 180 w", "north") == ["38.030000", "-38.500000", "-90.000000", None]
    assert one(spark, lambda c: checks.coordinates(c)["status"], "90 N 180 E", "90.1 N 0 E", "x", None) == ["confirmed", "unsupported", "not_assessed", "not_assessed"]
    assert one(spark, lambda c: checks.primer(c)["status"], "ACGTRY", "ACGT", "515F-Y") == ["confirmed", "not_assessed", "not_assessed"]


def test_flags_and_absence(spark):
    assert one(spark, lambda c: V.control_flag(c, V.NEGATIVE_CONTROLS), "y", "none", "a field blank", "stuff", "") == ["1", "0", "1", None, None]
    assert one(spark, predicates.absent, "Not Reported.", "n/a", "soil", None, "not explicitly stated in the text") == [True, True, False, True, True]
    assert one(spark, V.licence_url, '[{"a": 1}, {"URL": " u "}]', '{"url": "w"}', "plain", '"q"', " ") == ["u", "w", "plain", "q", None]
    assert one(spark, V.column_letters, ) == []


def test_piped_values(spark):
    df = spark.createDataFrame([("A | b", "B | c"), ("not found", "x"), ("not found", None), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(K.pipe_union(F.col("x"), F.col("y"))).collect()] == ["A | b | c", "x", "not found", ""]


def test_first_accepted_breaks_ties_by_id(spark):
    rows = [(1, "a", 5, "rejected", 1), (2, "a", 5, "accepted", 2), (3, "a", 5, "accepted", 2), (4, "b", 1, "accepted", 9)]
    df = spark.createDataFrame(rows, "fact_id int, k string, v int, review_status string, created_at int")
    for order in (df, df.orderBy(F.desc("fact_id"))):
        assert sorted(r.fact_id for r in K.first_accepted(order, "k").collect()) == [2, 4]


def test_insert_absent_is_idempotent(spark):
    new = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (2, 4)], "k int, v int")
    once = K.insert_absent(spark.createDataFrame([], "k int, v int"), new, ["k"], ["v"])
    again = K.insert_absent(once, new.where("k IS NOT NULL"), ["k"], ["v"])
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect())) and once.count() == 3


def test_components(spark):
    links_ = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a int, b int")
    got = {r.node: r.label for r in graph.components(links_).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert graph.components(links_.where("false")).count() == 0


def test_merge_chain(spark):
    m = graph.merged_ids(spark.createDataFrame([("c", "b"), ("b", "a"), ("z", "y")], "study_id string, into_id string"))
    assert {tuple(r) for r in m.collect()} == {("c", "a"), ("b", "a"), ("z", "y")}


def test_replicate_signals_are_exclusive(spark):
    names = ["S_rep1", "S_rep2", "LM 6", "LM_7", "Site_A", "Site_B", "Site_C", "Pair-A", "Pair-B", "sample 1", "sample 2", "X_A", "X_C", "X_D"]
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate(names)], "g int, sample_id int, name string")
    got = {names[r.sample_id]: r.signal for r in links.replicates(df, ["g"]).collect()}
    assert set(got) == {"S_rep1", "S_rep2", "LM 6", "LM_7", "Site_A", "Site_B", "Site_C"}


def test_layers_and_fused_primers(spark):
    a = spark.createDataFrame([(1, None, "f", "x")], "study_id int, entity_id int, field string, value string")
    b = spark.createDataFrame([(1, None, "f", "y"), (1, None, "g", "z")], "study_id int, entity_id int, field string, value string")
    assert {(r.field, r.value) for r in mapping.layered([a, b], ["study_id", "entity_id", "field"]).collect()} == {("f", "x"), ("g", "z")}
    s = spark.createDataFrame([(1, "ACGTACGTACGTACGTA"), (1, "TTTTTTTTTTTTACGTACGTACGTACGTA"), (2, "ACGTACGTACGTACGTA")], "study_id int, sequence string")
    assert [(r.study_id, r.adapter) for r in mapping.fused_primers(s, ["study_id"]).collect()] == [(1, "TTTTTTTTTTTT")]


def test_budget_skips_small_rests(spark):
    parts = spark.createDataFrame([(["a" * 60, "b" * 60, "c" * 30, "d" * 5],)], "p array<string>")
    assert [len(x) for x in parts.select(texts.budgeted(F.col("p"), 100, 30)).first()[0]] == [60, 40]
    assert [len(x) for x in parts.select(texts.budgeted(F.col("p"), 100, 50)).first()[0]] == [60, 30, 5]
    assert parts.select(texts.chunked(F.col("p"), 100)).first()[0] == ["a" * 60, "\n\n".join(["b" * 60, "c" * 30, "d" * 5])]


def test_seed_batch_merges(spark):
    seeds_ = spark.createDataFrame([(1, "doi", "a"), (1, "pmid", "1"), (2, "pmid", "1"), (3, "doi", "no"), (4, "doi", "k")], "seed_id int, type string, value string")
    got = {r.seed_id: r.study_id for r in seeds.ingest(seeds_, spark.createDataFrame([("no",)], "doi string"), spark.createDataFrame([("doi", "k", "OLD")], "type string, value string, study_id string")).collect()}
    assert got == {1: "NEW-1", 2: "NEW-1", 4: "OLD"}


def test_merged_candidates(spark):
    rows = spark.createDataFrame([(1, 1, "d", None, None, 0.5), (1, 2, None, "p", "T", 0.9), (1, 3, "d", "p", None, 0.1), (2, 4, "d", None, None, 0.2)], "study_id int, id int, doi string, pmid string, title string, score double")
    got = {(r.study_id, r.candidate_id): (r.doi, r.pmid, r.title, r.score) for r in seeds.merged_candidates(rows, ["doi", "pmid"], ["title"], "score").collect()}
    assert got == {(1, 1): ("d", "p", "T", 0.9), (2, 4): ("d", None, None, 0.2)}


def test_enqueue_is_idempotent(spark):
    w = spark.createDataFrame([("k1",), ("k1",), ("k2",)], "idempotency_key string")
    assert tasks.enqueue(w.limit(0), w).count() == 2 and tasks.enqueue(w, w).count() == 0


def test_seed_files(spark, tmp_path):
    head = seed_files.SEED.replace(" string", "").replace(", ", ",")
    (tmp_path / "s.csv").write_text(f"{head}\ns1,T, ,,,,,,,,,\n")
    (tmp_path / "s.jsonl").write_text(json.dumps({"seed_id": "s1", "title": "T", "doi": ""}) + "\n")
    for name in ("s.csv", "s.jsonl"):
        r = seed_files.seed_rows(spark, str(tmp_path / name)).collect()
        assert len(r) == 1 and r[0].title == "T" and r[0].doi is None
    with pytest.raises(ValueError, match="csv or"):
        seed_files.seed_rows(spark, "x.xml")


def test_payloads(spark):
    body = {"DOI": "10.1/X", "title": ["A"], "issued": {"date-parts": [[2020, 1]]}}
    df = spark.createDataFrame([(1, json.dumps(body))], "payload_id int, body string")
    assert {(r.field, r.value) for r in payloads.facts(df, "crossref").collect()} == {("doi", "10.1/X"), ("title", "A"), ("publication_year", "2020")}
    files = spark.createDataFrame([(1, json.dumps({"files": [{"key": "a.fastq", "size": 5}, {"key": "b"}]}))], "payload_id int, body string")
    assert [(r.name, r.size_bytes) for r in payloads.listing(files, "zenodo").collect()] == [("a.fastq", 5), ("b", None)]
    assert [tuple(x) for x in df.select(payloads.leaves(F.col("body"))).first()[0]][-1] == ("date-parts", "$.issued.date-parts[0][1]", "1")
    assert [extraction.parse(x) for x in ('```json\n{"a": 1}\n```', '[{"a": 1}, {"b": 2}, {"c"', "nothing")] == [{"a": 1}, [{"a": 1}, {"b": 2}], None]


def test_landed_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"data": [{"id": 1}, {"id": 2}]}))
    spark.dataSource.register(payloads.LandedPages)
    assert spark.read.format("landed_pages").option("paths", str(tmp_path / "p1.json")).load().count() == 2


def test_supplements(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Table S1\nSample ID,Depth (m),Note\nX1,5,caf\xe9\n,,\n".encode("latin-1"))
    (tmp_path / "b.json").write_text('{"s": [{"temp": 4}]}')
    (tmp_path / "c.xml").write_text("<r><s><temp>4</temp></s></r>")
    (tmp_path / "bad.json").write_text("{")
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("in.tsv", "lat\tlon\n1\t2\n")
        z.writestr("nested.zip", b"x")
    (tmp_path / "d.zip").write_bytes(data.getvalue())
    got = {(r.member.rpartition("/")[2], r.field, r.locator, r.value) for r in supplements.cells(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got == {("a.csv", "samp_name", "A3", "X1"), ("a.csv", "depth", "B3", "5"), ("a.csv", "note", "C3", "café"), ("b.json", "temp", "$.s[0].temp", "4"), ("c.xml", "temp", "/r/s/temp", "4"), ("nested.zip", "skipped", "", "nested"), ("bad.json", "unreadable", "", "JSONDecodeError"), ("in.tsv", "decimalLatitude", "A2", "1"), ("in.tsv", "decimalLongitude", "B2", "2")}


def test_export_removes_stale_classes(spark, tmp_path):
    v = spark.createDataFrame([(1, "a", "f", "x"), (1, "b", "g", "y")], "study_id int, target_table string, field string, value string")
    export.classes(v, {"a": ["f", "none"], "b": ["g"]}, str(tmp_path), ["study_id"])
    export.classes(v, {"a": ["f", "none"]}, str(tmp_path), ["study_id"])
    assert export.listed(spark, str(tmp_path)) == ["a"]
    assert spark.read.csv(f"{tmp_path}/a", header=True).collect()[0].asDict() == {"study_id": "1", "f": "x", "none": None}
    with pytest.raises(export.NotApplicable):
        export.bebop()


def test_task_machine():
    state, n = "pending", 0
    for e, want in (("start", "pending"), ("claim", "claimed"), ("start", "running"), ("fail", "retry_pending"), ("claim", "claimed"), ("fail", "manual_review_required"), ("claim", "manual_review_required")):
        state, n = stream.advance(state, n, e, 2)
        assert state == want
    assert n == 2


def test_windows_over_a_stream(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.select("event_id", "ts", "user_id", "event_type", "value").write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value").schema).parquet(str(tmp_path / "in"))
    q = stream.tumbling(live, "1 day").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("windows").agg(F.sum("n")).first()[0] == events.count()
    assert stream.sessions(events, "2 hours").agg(F.sum("n")).first()[0] == events.count()
    assert stream.sliding(events, "2 hours", "1 hour").agg(F.sum("n")).first()[0] == 2 * events.count()


def test_extraction_contract(spark):
    from tidemark.operators import extraction as E

    assert E.parse("```json\n[{\"a\": 1}]\n```") == [{"a": 1}] and E.parse('[{"a": 1}, {"b"') == [{"a": 1}] and E.parse("no") is None
    with pytest.raises(RuntimeError):
        E.Disabled().generate_json("x")
    docs = spark.createDataFrame([("s", "first part\nsecond part")], "section_id string, text string")
    mock = E.Mock({"[recall]": '[{"fact_type": "f", "value": "v", "evidence_id": "s.P002"}, {"fact_type": "f", "value": "n/a", "evidence_id": "s.P001"}, {"fact_type": "g", "value": "v", "evidence_id": "s.P001"}, {"fact_type": "f", "value": "w", "evidence_id": "s.P009"}]'}, "nothing readable")
    got = E.extract(docs, texts.paragraphs(F.col("text")), mock, ["f"], "q").collect()
    assert [tuple(r) for r in got] == [("s", "f", "v", "s.P002", "second part")]

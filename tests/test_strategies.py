"""Value strategies, techniques, resolution, adapters and sinks on small cases."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.operators import extraction, resolution, routing, sections, seeds, strategies, techniques
from tidemark.plans import export
from tidemark.sources import adapters, archives, supplements


def one(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_phrases_occupy_their_place_unless_found_before(spark):
    p = (r"(?i)red kit(?: \d)?", r"[A-Z]\w+ \w+ kit(?: \d)?")
    df = spark.createDataFrame([(["Big red kit 1 and.", "Big red kit 1 again.", "none"],), ([],), (None,)], "s array<string>")
    got = [r.v for r in df.select(strategies.phrases(F.col("s"), p).alias("v")).collect()]
    assert got == [["red kit 1", "Big red kit 1"], [], []]  # the second time the first pattern's value is known, so its place is free


def test_primers_by_direction(spark):
    s = "The 515F-Y forward primer 5′ GTG YCA GCM 3′ and 806RB reverse primer 5' GGACTACNVGGGT 3' were used; universal forward primers too"
    names = lambda d: lambda c: strategies.primer_names(c, d)
    assert one(spark, names("forward"), s, "no such thing", "universal forward primer, 18S rRNA F") == [["515F-Y"], [], ["18S rRNA F"]]
    assert one(spark, lambda c: strategies.primer_sequences(c, "forward"), s) == [["GTGYCAGCM"]]
    assert one(spark, lambda c: strategies.primer_sequences(c, "reverse"), s) == [["GGACTACNVGGGT"]]


def test_mixtures_trim_tools_and_lengths(spark):
    assert one(spark, lambda c: strategies.mixture(c, True), "Master mix was used, with cycling conditions as given", "Phusion polymerase only", "Taq polymerase and buffer") == [["Master mix was used"], [], []]
    assert one(spark, lambda c: strategies.mixture(c, False), "Taq polymerase and buffer were mixed.") == [["Taq polymerase and buffer were mixed."]]
    far = "SeqPrep 1.2 removed adapters" + " x" * 60 + " while Trimmomatic v0.39 cut low quality reads"
    assert one(spark, lambda c: strategies.trim_tools(c, "adapter"), far) == [["SeqPrep 1.2"]]
    assert one(spark, lambda c: strategies.trim_tools(c, "length_quality"), far) == [["Trimmomatic v0.39"]]
    assert one(spark, strategies.minimum_length, "MINLEN:36", "reads shorter than 50 bases were discarded", "reads of 50 bp", "Trimmomatic; minimum read length of 75 nt", "trimmed to 100") == [["36 bp"], ["50 bp"], [], ["75 bp"], ["100 bp"]]


def test_dictionary_of_techniques(spark):
    import re

    known = techniques.dictionary()
    assert len(known) == 149
    for name, (p, _) in known.items():  # every name that is written as itself is found by its pattern
        if name not in ("total-sum scaling", "z-score standardization", "CLR", "ALR", "ILR", "CPM", "CSS", "TMM", "RLE", "MDS", "MCA", "PLS", "CAP", "partial CCA", "ACE", "MEM"):
            assert re.search(p, name, re.I), name
    df = spark.createDataFrame([("Partial least squares regression, then PLS-DA and canonical correspondence analysis of GAM fits", "spline"), ("a GAM was fit", ""), ("partial Mantel test, Mantel tests", "")], "s string, w string")
    got = [r.v for r in df.select(techniques.named_in(F.col("s"), F.col("w")).alias("v")).collect()]
    assert got == [["partial least squares regression", "PLS-DA", "canonical correspondence analysis", "generalized additive model"], [], ["partial Mantel test", "Mantel test"]]


def test_segments_are_told_apart_above_999(spark):
    parts = F.transform(F.sequence(F.lit(1), F.lit(1200)), lambda i: F.concat(F.lit("t"), i.cast("string")))
    got = extraction.segmented(spark.createDataFrame([("s",)], "section_id string"), "section_id", parts)
    assert got.select("segment_id").distinct().count() == 1200
    assert {"s.P001", "s.P999", "s.P1000", "s.P1200"} <= {r.segment_id for r in got.collect()}


def test_a_section_is_asked_once_for_the_first_pass(spark, tmp_path):
    class Counting(extraction.Backend):
        def generate(self, prompt):
            with open(tmp_path / "asked", "a") as f:
                f.write("recall\n" if prompt.startswith("[recall]") else "first\n")
            return '[{"fact_type": "x", "value": "yes", "evidence_id": "a.P001"}]' if "a.P001" in prompt else "[]"

    docs = spark.createDataFrame([("a", "yes indeed"), ("b", "nothing")], "section_id string, text string")
    got = extraction.extract(docs, F.array("text"), Counting(), ["x"], "What?").collect()
    assert [(r.section_id, r.value) for r in got] == [("a", "yes")]
    assert sorted((tmp_path / "asked").read_text().split()) == ["first", "first", "recall"]


def test_excluded_seeds_go_whole(spark):
    rows = spark.createDataFrame([(1, "doi", "10.1/x"), (1, "acc", "A1"), (2, "acc", "A1"), (3, "acc", "A2")], "seed_id long, type string, value string")
    none = spark.createDataFrame([], "type string, value string, study_id string")
    got = seeds.ingest(rows, spark.createDataFrame([("10.1/x",)], "doi string"), none).collect()
    assert sorted(tuple(r) for r in got) == [(2, "NEW-2"), (3, "NEW-3")]


def test_members_that_are_not_read_are_told(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.csv", "x,y\n1,2\n")
        z.writestr("inner.zip", b"PK")
        z.writestr("big.txt", "z" * 100)
    found = list(supplements.members("b.zip", buffer.getvalue(), 50))
    assert [(n, str(d) if isinstance(d, supplements.Skipped) else "read") for n, d in found] == [("a.csv", "read"), ("inner.zip", "nested"), ("big.txt", "too_large")]
    (tmp_path / "b.zip").write_bytes(buffer.getvalue())
    rows = supplements.cells(spark.read.format("binaryFile").load(str(tmp_path / "b.zip"))).where("field = 'skipped'").collect()
    assert [(r.member, r.value) for r in rows] == [("inner.zip", "nested")]


def test_fetch_repeats_what_is_worth_it(spark):
    wanted = adapters.missing(spark.createDataFrame([("u/200",), ("u/503",), ("u/404",), ("u/200",), ("u/old",)], "url string"), spark.createDataFrame([("u/old", 200), ("u/503", 500)], "url string, status int").withColumn("url_key", adapters.url_key(F.col("url"))))
    got = adapters.fetch(wanted, lambda url: (int(url[2:]), "body"), adapters.Limits(attempts=3), sleep=lambda s: None).collect()
    assert sorted((r.url, r.status, r.attempts, r.body) for r in got) == [("u/200", 200, 1, "body"), ("u/404", 404, 1, None), ("u/503", 503, 3, None)]
    assert [adapters.Limits().wait(n) for n in (1, 2, 5, 9)] == [1.0, 2.0, 16.0, 30.0]
    assert adapters.fetch(wanted.where("false"), lambda url: (200, ""), sleep=lambda s: None).count() == 0


def test_damaged_records_give_no_facts(spark):
    bad = spark.createDataFrame([(1, "<RecordSet><DocumentSummary>"), (2, "no xml"), (3, None), (4, "<BioSampleSet></BioSampleSet>")], "payload_id int, body string")
    assert archives.project_facts(bad).count() == 0
    assert archives.samples(bad).count() == 0


def test_sample_type_needs_one_type_in_the_sentence(spark):
    df = spark.createDataFrame([("5 L", "We took 5 L of water. Soil too."), ("5 L", "5 L of water and sediment."), ("5 L", "Water. 6 L of soil."), ("5 l", "Soils came first. Then 5 L of Soil!")], "v string, q string")
    assert [r.t for r in df.select(routing.type_of_quote(F.col("v"), F.col("q")).alias("t")).collect()] == ["water", None, None, "sediment"]


def test_resolve_settles_new_identifiers_within_a_batch(spark):
    e = spark.createDataFrame([(1, 10, "doi", "a", "structured_source", 1), (2, 20, "doi", "a", "structured_source", 2), (3, 20, "biosample_accession", "b", "explicit", 3), (4, 10, "biosample_accession", "b", "explicit", 4), (5, 30, "doi", "a", "inferred", 5)], "evidence_id long, study_id long, type string, value string, confidence string, created_at int")
    known = spark.createDataFrame([], "study_id long, type string, value string")
    studies = spark.createDataFrame([(10, None, None), (20, None, None), (30, 10, None)], "study_id long, parent_id long, root_id long")
    got = resolution.resolve(e, known, studies, spark.createDataFrame([], "study_id long, other long, consistent boolean"))
    assert sorted((r.evidence_id, r.decision, r.other) for r in got.collect()) == [(1, "record", None), (2, "merge", 10), (3, "record", None), (4, "share", None), (5, "share", None)]


def test_long_runs_are_asked_about_in_batches(spark):
    rows = spark.createDataFrame([("r", "c", f"s.P{i:03d}", f"value V{i} here") for i in range(50)], "run string, category string, segment_id string, text string")
    facts, left = sections.term_facts(rows, sections.ByWords({"v": r"V(\d*[02468])\b"}), {"c": ["v"]}, 100)
    assert facts.count() == 25 and left.count() == 25
    assert {r.value for r in facts.collect()} == {str(i) for i in range(0, 50, 2)}


def test_files_of_registry_benchmark_and_checklist(spark, tmp_path):
    terms = spark.createDataFrame([("T1", "Depth", None, "s"), ("T2", "", "T9", "s")], "id string, name string, parent string, standard string")
    fields = spark.createDataFrame([("f", "p", "depth", "1"), ("f", "q", "Other", "2")], "template_file string, protocol_section string, field_name string, value string")
    tables = export.registry(terms, fields, spark.createDataFrame([("Depth", "T1")], "name string, target string"), spark.createDataFrame([], "alias string, target string"))
    assert export.write_registry(tables, f"{tmp_path}/r") == {"terms": 2, "template_terms": 1, "term_crosswalk": 2, "template_field_usage": 2, "validation_report": 2}
    assert sorted(export.listed(spark, f"{tmp_path}/r")) == ["template_field_usage", "template_terms", "term_crosswalk", "terms", "validation_report"]
    cases = spark.createDataFrame([("m", "c1", 2), ("m", "c2", 1)], "model string, case_id string, tp int")
    export.benchmark_report(cases.groupBy("model").agg(F.sum("tp").alias("tp")), cases, f"{tmp_path}/b", "model")
    detail = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/b/detail").collect()]
    assert detail == [{"model": "m", "tp": 3, "cases": [{"case_id": "c1", "tp": 2}, {"case_id": "c2", "tp": 1}]}]
    values = spark.createDataFrame([(1, "sample", "depth", "5")], "study_id long, target_table string, field string, value string")
    known = spark.createDataFrame([("depth", "M", None, "float", ["x:y"])], "field string, requirement_level_code string, requirement_level_condition string, range string, exact_mappings array<string>")
    corrected = spark.createDataFrame([(1, 1, "elev")], "study_id long, created_at int, api_faire_term string")
    export.checklist(values, {"sample": ["depth"]}, f"{tmp_path}/c", ["study_id"], known, corrected, spark.createDataFrame([(1, "doi", "10.1/x")], "study_id long, type string, value string"))
    assert sorted(export.listed(spark, f"{tmp_path}/c")) == ["api_paper_corrections", "field_reference", "sample"]
    assert len(export.RAW_FACT_COLUMNS) == 18


def test_scratch_goes_when_it_is_consumed(spark):
    a = shared.materialise(spark.range(5), "a")
    with shared.scope():
        b = shared.materialise(a.where("id > 2"), "b")
        assert b.count() == 2
    assert a.count() == 5
    before = shared.scratch_paths()
    c = shared.materialise(a, "c")
    shared.free(shared.scratch_paths() - before, c)
    assert c.count() == 5
    shared.discard(a, c)
    assert shared.scratch_paths() < before
    with pytest.raises(Exception, match="(?i)path|file"):
        a.count()

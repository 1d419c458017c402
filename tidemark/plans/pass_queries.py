"""Queries over fact passes and model-assisted extraction with a mock backend."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.operators import extraction as E
from tidemark.operators import passes as P
from tidemark.operators import texts as X
from tidemark.plans.text_queries import PARAGRAPHS


@query("p2_experiment_runs", "SELECT DISTINCT l_orderkey AS study_id, l_orderkey * 10 + l_linenumber AS run_id, CASE WHEN l_linenumber % 2 = 0 THEN concat('LIB', l_orderkey) ELSE concat('internal:run:', l_orderkey * 10 + l_linenumber) END AS experiment_id, CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey::VARCHAR END AS sample_id FROM lineitem WHERE l_linenumber < 6 AND l_orderkey % 3 <> 0")
def experiment_runs(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").withColumn("run_id", F.expr("l_orderkey * 10 + l_linenumber"))
    facts = li.selectExpr("l_orderkey AS study_id", "run_id", "l_shipdate AS created_at", "stack(3, 'library_name', CASE WHEN l_linenumber % 2 = 0 THEN concat('LIB', CAST(l_orderkey AS STRING)) END, 'sample_accession', CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_orderkey AS STRING) END, 'library_strategy', CASE WHEN l_linenumber < 6 THEN 'AMPLICON' END) AS (kind, value)").where("value IS NOT NULL")
    return P.experiment_runs(facts, li.where("l_orderkey % 3 = 0").select("run_id"), ("library_name", "sample_accession", "library_strategy"), ("library_strategy",))


@query("p5_filtration_default", "SELECT o_custkey AS study_id, max(CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END) AS value FROM orders GROUP BY 1 HAVING max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 0")
def filtration(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    facts = o.selectExpr("o_custkey AS study_id", "'accepted' AS review_status", "'filter_name' AS kind", "o_orderpriority AS value", "CAST(NULL AS STRING) AS quote").unionByName(o.where("o_orderstatus = 'P'").selectExpr("o_custkey AS study_id", "'accepted' AS review_status", "'active' AS kind", "'0' AS value", "CAST(NULL AS STRING) AS quote"))
    return P.filtration_default(facts, "active", ("filter_name",), "(?i)urgent")


@query("p6_recorded_by", """
    WITH s AS (SELECT o_custkey AS study_id, o_orderpriority AS v, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2), r AS (SELECT study_id, string_agg(v, ' | ' ORDER BY k) AS value FROM s GROUP BY 1)
    SELECT study_id, value, 'submitter' AS method FROM r UNION ALL SELECT c_custkey, c_name, 'first_author' FROM customer WHERE c_custkey NOT IN (SELECT study_id FROM r)""")
def recorded_by(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE ' ' END AS submitter", "o_orderkey AS created_at")
    return P.recorded_by(s, table(spark, sf, "customer").selectExpr("c_custkey AS study_id", "concat(c_name, ' | B. Second') AS authors"))


@query("p16_primer_traceability", "SELECT c_custkey AS study_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') AND c_nationkey % 2 = 1")
def traceability(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr("c_custkey AS study_id", "'accepted' AS review_status", "'name' AS kind", "concat('Primer', CAST(c_nationkey AS STRING)) AS value")
    o = table(spark, sf, "orders").where("o_orderstatus = 'O'").selectExpr("o_custkey AS study_id", "'accepted' AS review_status", "'sequence' AS kind", "'ACGTACGT' AS value")
    return P.untraceable_primers(c.unionByName(o), "name", "sequence", "reference", table(spark, sf, "nation").where("n_nationkey % 2 = 0").selectExpr("concat('primer', CAST(n_nationkey AS STRING)) AS primer"))


@query("p17_detection_flags", "SELECT c_custkey AS study_id, max(CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END) AS F, max(CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '0' END) AS O, max(CASE WHEN o_orderstatus = 'P' THEN '1' ELSE '0' END) AS P FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def detection(spark: SparkSession, sf: str) -> DataFrame:
    return P.detection_flags(table(spark, sf, "customer").select(F.col("c_custkey").alias("study_id")), table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "o_orderstatus AS section"), ["F", "O", "P"])


@query("a6_replicate_range", "WITH g AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, CASE WHEN min(n) = max(n) THEN min(n)::VARCHAR ELSE concat(min(n), '-', max(n)) END AS replicates FROM g GROUP BY 1")
def replicate_range(spark: SparkSession, sf: str) -> DataFrame:
    return P.replicate_range(table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n")), "l_orderkey")


@query("f14_exported_studies", "SELECT c_custkey AS study_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)")
def exported(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE -1 END AS home_study_id")
    return P.exported_studies(table(spark, sf, "customer").select(F.col("c_custkey").alias("study_id")), links)


@query("f15_accessible_studies", "SELECT c_custkey AS study_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') OR c_mktsegment = 'BUILDING'")
def accessible(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    facts = c.selectExpr("c_custkey AS study_id", "'accepted' AS review_status", "'sequence_data_status' AS kind", "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Likely' ELSE 'absent' END AS value")
    return P.accessible(c.select(F.col("c_custkey").alias("study_id")), table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("study_id")), facts)


@query("a11_weekly_plan", "SELECT count(*) FILTER (event_type <> 'error') AS refreshable, count(*) FILTER (event_type <> 'error' AND date_diff('day', ts::DATE, DATE '2024-02-10') >= 20) AS stale FROM events")
def weekly(spark: SparkSession, sf: str) -> DataFrame:
    return P.weekly_plan(table(spark, sf, "events").selectExpr("event_type <> 'error' AS refreshable", "CAST(ts AS DATE) AS last_checked"), F.lit("2024-02-10").cast("date"), 20)


@query("a14_registry_problems", "SELECT 'duplicate_id' AS problem, p_brand AS term FROM part GROUP BY p_brand HAVING count(*) > 1 UNION ALL SELECT 'blank_name', p_brand FROM part WHERE p_size % 10 = 0 UNION ALL SELECT DISTINCT 'unknown_parent', concat(p_brand, '0') FROM part WHERE concat(p_brand, '0') NOT IN (SELECT p_brand FROM part)")
def registry(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return P.registry_problems(p.selectExpr("p_brand AS id", "CASE WHEN p_size % 10 = 0 THEN ' ' ELSE p_name END AS name"), p.selectExpr("p_brand AS id", "concat(p_brand, '0') AS parent"))


@query("j15_title_matches")
def title_matches(spark: SparkSession, sf: str) -> DataFrame:
    # pairs are made by study: a customer and its orders
    pairs = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    score = P.title_similarity(F.concat_ws(" ", F.lit("The study of"), "c_name", "c_mktsegment"), F.concat_ws(" ", F.lit("Study of a"), "c_name", "o_orderpriority"))
    return pairs.select("o_orderkey", F.round(score, 6).alias("score")).withColumn("confidence", P.title_confidence(F.col("score")))


@query("x10_checksum_labels", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'SHA-256 | MD5' WHEN 1 THEN 'MD5' ELSE '' END AS labels FROM part")
def checksum_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", P.labels_found(F.expr("CASE p_partkey % 3 WHEN 0 THEN 'by sha256 and md5' WHEN 1 THEN concat('MD5 of ', p_name) ELSE p_name END"), P.CHECKSUMS).alias("labels"))


@query("x16_match_context", "SELECT doc_id, regexp_extract(text, '(?is).{0,40}(?:license).{0,40}', 0) AS context FROM documents WHERE regexp_matches(text, '(?i)license')")
def match_context(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where(F.col("text").rlike("(?i)license")).select("doc_id", P.around(F.col("text"), "license").alias("context"))


class LicenceReader(E.Backend):
    """A mock that reports each segment that names a licence; its answer is cut off, as a model's may be."""

    label = "mock"

    def generate(self, prompt: str) -> str:
        found = [line.partition(": ") for line in prompt.splitlines() if "License" in line]
        return "[" + ",".join(json.dumps({"fact_type": "licence", "value": text.strip(), "evidence_id": at}) for at, _, text in found) + (', {"fact_type": "lic' if found else "]")


@query("m1_section_extraction", f"""
    WITH {PARAGRAPHS}, s AS (SELECT doc_id, unnest(ps) AS t, generate_subscripts(ps, 1) AS i FROM p),
    h AS (SELECT doc_id::VARCHAR AS section_id, concat(doc_id, '.P', lpad(i::VARCHAR, greatest(3, length(i::VARCHAR))::INTEGER, '0')) AS id, t FROM s WHERE contains(t, 'License'))
    SELECT section_id, 'licence' AS fact_type, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS value, string_agg(id, ',' ORDER BY id) AS evidence, first(t ORDER BY id) AS quote FROM h GROUP BY section_id, regexp_replace(t, '^\\s+|\\s+$', '', 'g')""")
def section_extraction(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("section_id"), "text")
    return E.extract(docs, X.paragraphs(F.col("text")), LicenceReader(), ["licence"], "Which licence?")


@query("m2_quote_candidates", "WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) AS a FROM documents), e AS (SELECT doc_id, trim(unnest(a)) AS s, generate_subscripts(a, 1) AS i FROM s), k AS (SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM e WHERE s <> '' AND regexp_matches(s, '(?i)the')) SELECT doc_id, count(*) AS n, max(n) AS top FROM k WHERE n <= 40 GROUP BY 1")
def quote_candidates(spark: SparkSession, sf: str) -> DataFrame:
    s = X.posexploded(table(spark, sf, "documents"), "doc_id", X.sentences(F.col("text")), "sentence")
    return E.candidates(s, "doc_id", "(?i)the").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n").cast("long").alias("top"))


@query("m7_to_verify", "SELECT event_id AS fact_id FROM events WHERE event_type = 'view' AND user_id % 2 = 0 AND event_id % 5 <> 0")
def verify(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    facts = e.selectExpr("event_id AS fact_id", "CASE WHEN event_type = 'view' THEN 'explicit' ELSE 'structured_source' END AS support_type", "'llm_text_extraction' AS extraction_method", "CASE WHEN user_id % 2 = 0 THEN 'q' ELSE ' ' END AS evidence_quote")
    return E.to_verify(facts, e.where("event_id % 5 = 0").selectExpr("event_id AS fact_id")).select("fact_id")

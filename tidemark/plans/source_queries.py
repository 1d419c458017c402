"""Queries over archive records, adapters, the response cache, handlers, schedules and backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.operators import dispatch as D
from tidemark.sources import adapters, archives
from tidemark.sources import persist

PROJECTS = (
    "concat('<RecordSet><DocumentSummary uid=\"', CAST(p_partkey AS STRING), '\"><Project><ProjectID><ArchiveID accession=\"PRJNA', CAST(p_partkey AS STRING), '\" archive=\"NCBI\"/></ProjectID><ProjectDescr><Name>', p_name, '</Name><Title>', p_type, ' &amp; more</Title>', "
    "CASE WHEN p_size % 2 = 0 THEN '<Description> </Description>' ELSE concat('<Description>', p_brand, '</Description>') END, '</ProjectDescr><ProjectType><ProjectTypeSubmission><Target><Organism><OrganismName>metagenome</OrganismName></Organism></Target></ProjectTypeSubmission></ProjectType></Project>', "
    "CASE WHEN p_size % 3 = 0 THEN '<Submission submitted=\"2020-01-02\"/>' ELSE '' END, '</DocumentSummary></RecordSet>')"
)
PROJECT_FACTS = """SELECT p_partkey AS payload_id, unnest(['name', 'title', 'description', 'organism', 'submitted']) AS field, unnest([p_name, concat(p_type, ' & more'), CASE WHEN p_size % 2 = 1 THEN p_brand END, 'metagenome', CASE WHEN p_size % 3 = 0 THEN '2020-01-02' END]) AS value FROM part"""


def projects(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr("p_partkey AS payload_id", f"{PROJECTS} AS body")


@query("sc7_project_facts", f"WITH f AS ({PROJECT_FACTS}) SELECT payload_id, concat('PRJNA', payload_id) AS accession, field, value FROM f WHERE value IS NOT NULL")
def project_facts(spark: SparkSession, sf: str) -> DataFrame:
    return archives.project_facts(projects(spark, sf))


@query("sc7_resolved_uids", "SELECT concat('PRJNA', l_orderkey) AS accession, coalesce(min(l_linenumber) FILTER (l_quantity > 25), min(l_linenumber)) AS uid, count(*) > 1 AND count(*) FILTER (l_quantity > 25) = 0 AS ambiguous FROM (SELECT l_orderkey, (l_linenumber * 1000000 + l_orderkey)::BIGINT AS l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def resolved_uids(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q")).withColumn("uid", F.expr("CAST(l_linenumber AS BIGINT) * 1000000 + l_orderkey"))
    return archives.resolved_uids(li.selectExpr("concat('PRJNA', CAST(l_orderkey AS STRING)) AS accession", "l_linenumber AS position", "uid"), li.selectExpr("uid", "concat(CASE WHEN q > 25 THEN 'prjna' ELSE 'PRJEB' END, CAST(l_orderkey AS STRING)) AS own"))


SAMPLES = (
    "concat('<BioSampleSet>', array_join(transform(rows, r -> concat('<BioSample accession=\"SAMN', CAST(r.k AS STRING), '\" submission_date=\"2021-03-04\" package=\"', CASE WHEN r.k % 7 = 0 THEN 'MIMAG.6.0' ELSE 'MIMS.me' END, '\"><Ids><Id db_label=\"Sample name\">S', CAST(r.k AS STRING), '</Id></Ids><Description><Title>T', CAST(r.k AS STRING), '</Title><Organism taxonomy_id=\"408172\" taxonomy_name=\"marine metagenome\"/></Description><Owner><Name>Lab</Name><Contacts><Contact><Name><First>A</First><Last>B', CAST(r.k % 3 AS STRING), '</Last></Name></Contact></Contacts></Owner><Attributes><Attribute attribute_name=\"Depth\">', CAST(r.size AS STRING), ' m</Attribute>', "
    "CASE WHEN r.k % 2 = 0 THEN '<Attribute attribute_name=\"cultivar\">wild</Attribute>' ELSE '' END, CASE WHEN r.k % 5 = 0 THEN '<Attribute attribute_name=\"sample_name\">own</Attribute>' ELSE '' END, '</Attributes></BioSample>')), ''), '</BioSampleSet>')"
)


def sample_payloads(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").groupBy(F.expr("p_partkey % 50").alias("payload_id")).agg(F.expr("array_sort(collect_list(struct(p_partkey AS k, p_size AS size)))").alias("rows"))
    return p.selectExpr("payload_id", f"{SAMPLES} AS body")


@query("sc8_sample_facts", """
    WITH s AS (SELECT p_partkey AS k, concat('SAMN', p_partkey) AS accession, p_size FROM part WHERE p_partkey % 7 <> 0)
    SELECT accession, 'Depth' AS field, concat(p_size, ' m') AS value FROM s UNION ALL SELECT accession, 'depth', concat(p_size, ' m') FROM s UNION ALL SELECT accession, 'cultivar', 'wild' FROM s WHERE k % 2 = 0 UNION ALL SELECT accession, 'host_species', CASE WHEN k % 2 = 0 THEN 'wild' ELSE 'marine metagenome' END FROM s
    UNION ALL SELECT accession, 'sample_name', CASE WHEN k % 5 = 0 THEN 'own' ELSE concat('S', k) END FROM s UNION ALL SELECT accession, 'organism', 'marine metagenome' FROM s UNION ALL SELECT accession, 'eventDate_submitted', '2021-03-04' FROM s""")
def sample_facts(spark: SparkSession, sf: str) -> DataFrame:
    return archives.sample_facts(archives.samples(sample_payloads(spark, sf)))


@query("sc8_sample_contacts", "SELECT concat('SAMN', p_partkey) AS accession, concat('A B', p_partkey % 3) AS contact, 'Lab' AS owner, concat('T', p_partkey) AS title FROM part")
def sample_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return archives.samples(sample_payloads(spark, sf)).select("accession", "contact", "owner", "title")


@query("sc8a_capped_samples", "WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS k FROM orders) SELECT o_custkey AS project, o_orderkey::VARCHAR AS value FROM r WHERE n <= 6 UNION ALL SELECT DISTINCT o_custkey, concat('Only the first 6 of ', k, ' were processed') FROM r WHERE k > 6")
def capped_samples(spark: SparkSession, sf: str) -> DataFrame:
    rows, note = archives.capped(table(spark, sf, "orders").selectExpr("o_custkey AS project", "o_orderkey"), "project", ["o_orderkey"], 6, "coverage_note")
    return rows.selectExpr("project", "CAST(o_orderkey AS STRING) AS value").unionByName(note.select("project", "value"))


@query("sc9a_run_report", """
    WITH r AS (SELECT concat('PRJ', l_orderkey) AS st, concat('ERR', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey, l_returnflag) AS run, CASE WHEN l_linenumber % 2 = 0 THEN concat('ERX', l_orderkey) WHEN l_linenumber % 3 = 0 THEN concat('lib', l_linenumber) ELSE concat('internal:ena:ERR', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey, l_returnflag) END AS e, l_linenumber, l_shipmode, l_orderkey, concat('SAM', l_suppkey) AS sam
        FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_returnflag AS l_shipmode FROM lineitem)),
    n AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY run) AS n, count(*) OVER (PARTITION BY st) AS k FROM r), c AS (SELECT * FROM n WHERE n <= 5)
    SELECT st AS study_accession, 'project' AS level, st AS entity, 'study_title' AS field, concat('About ', l_orderkey) AS value FROM c WHERE n = 1 UNION ALL SELECT st, 'project', st, 'study_accession', st FROM c WHERE n = 1
    UNION ALL SELECT st, 'sequencing_run', run, 'instrument_model', l_shipmode FROM c UNION ALL SELECT st, 'sequencing_run', run, 'sample_accession', sam FROM c UNION ALL SELECT st, 'sequencing_run', run, 'experiment_accession', e FROM c WHERE l_linenumber % 2 = 0
    UNION ALL SELECT DISTINCT st, 'experiment_run', e, 'sequenced_in_run', run FROM c UNION ALL SELECT DISTINCT st, 'experiment_run', e, 'derived_from_sample', sam FROM c UNION ALL SELECT DISTINCT st, 'experiment_run', e, 'library_name', concat('lib', l_linenumber) FROM c WHERE l_linenumber % 3 = 0
    UNION ALL SELECT DISTINCT st, 'project', st, 'run_coverage_note', concat('Only the first 5 of ', k, ' were processed') FROM n WHERE k > 5""")
def run_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").distinct().selectExpr(
        "concat('PRJ', CAST(l_orderkey AS STRING)) AS study_accession", "concat('ERR', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING), '_', CAST(l_partkey AS STRING), '_', CAST(l_suppkey AS STRING), l_returnflag) AS run_accession", "CASE WHEN l_linenumber % 2 = 0 THEN concat('ERX', CAST(l_orderkey AS STRING)) END AS experiment_accession",
        "CASE WHEN l_linenumber % 3 = 0 THEN concat('lib', CAST(l_linenumber AS STRING)) ELSE ' ' END AS library_name", "concat('SAM', CAST(l_suppkey AS STRING)) AS sample_accession", "concat('About ', CAST(l_orderkey AS STRING)) AS study_title", "l_returnflag AS instrument_model")
    return archives.run_report(rows, 5)


def landed(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    crossref = "concat('{\"DOI\": \"10.1/', CAST(p_partkey AS STRING), '\", \"title\": [\"', p_name, '\"], \"publisher\": \"\"}')"
    return p.selectExpr("p_partkey AS payload_id", "'ncbi_bioproject' AS source", "concat('PRJNA', CAST(p_partkey AS STRING)) AS identifier", f"{PROJECTS} AS body", "p_size AS fetched_at").unionByName(p.selectExpr("p_partkey AS payload_id", "'crossref' AS source", "concat('10.1/', CAST(p_partkey % 60 AS STRING)) AS identifier", f"{crossref} AS body", "p_size AS fetched_at"))


@query("sc2_adapter_facts", f"WITH f AS ({PROJECT_FACTS} UNION ALL SELECT p_partkey, 'accession', concat('PRJNA', p_partkey) FROM part) SELECT 'ncbi_bioproject' AS source, payload_id, field, value FROM f WHERE value IS NOT NULL UNION ALL SELECT 'crossref', p_partkey, unnest(['doi', 'title']), unnest([concat('10.1/', p_partkey), p_name]) FROM part")
def adapter_facts(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.all_facts(landed(spark, sf), ["ncbi_bioproject", "crossref"])


@query("u3_adapter_contract", "SELECT 'fetch' AS what, count(DISTINCT p_partkey % 60) AS n FROM part WHERE p_partkey % 60 < 40 UNION ALL SELECT 'search', count(*) FROM part WHERE lower(p_name) LIKE '%widget%' UNION ALL SELECT 'related', count(*) FROM part UNION ALL SELECT 'watermark', max(p_size) FROM part")
def contract(spark: SparkSession, sf: str) -> DataFrame:
    a, rows = adapters.ADAPTERS["crossref"], landed(spark, sf)
    wanted = spark.range(40).selectExpr("concat('10.1/', CAST(id AS STRING)) AS identifier")
    n = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return n(a.fetch(rows, wanted), "fetch").union(n(a.search(rows, "widget WIDGET"), "search")).union(n(a.related(rows), "related")).union(a.watermark(rows).select(F.lit("watermark"), F.col("last_fetched").cast("long")))


@query("sc3_missing_responses", "SELECT DISTINCT concat('https://x.org/', l_partkey) AS url FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size % 3 = 0)")
def missing(spark: SparkSession, sf: str) -> DataFrame:
    url = lambda c: F.concat(F.lit("https://x.org/"), F.col(c).cast("string"))
    bronze = table(spark, sf, "part").select(adapters.url_key(url("p_partkey")).alias("url_key"), F.expr("CASE WHEN p_size % 3 = 0 THEN 200 ELSE 503 END").alias("status"))
    return adapters.missing(table(spark, sf, "lineitem").select(url("l_partkey").alias("url")), bronze).select("url")


@query("u6_persisted", "SELECT p_partkey AS identifier, 'normal' AS mode, p_partkey AS source_id, NULL::BIGINT AS parent_source_id FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT p_partkey, 'refresh', p_partkey, CASE WHEN p_size % 3 = 0 THEN 1000000 + p_partkey END FROM part WHERE p_size % 3 <> 0 OR p_size % 2 = 0")
def persisted(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    fetched = p.selectExpr("p_partkey AS identifier", "p_partkey AS source_id", "concat('new', CAST(p_size % 2 AS STRING)) AS content_hash", "2 AS created_at")
    have = p.where("p_size % 3 = 0").selectExpr("p_partkey AS identifier", "1000000 + p_partkey AS source_id", "'new1' AS content_hash", "1 AS created_at")
    out = None
    for mode, put in persist.MODES.items():
        got = put(have, fetched).select("identifier", F.lit(mode).alias("mode"), "source_id", "parent_source_id")
        out = got if out is None else out.unionByName(got)
    return out


@query("u2_dispatched_tasks", "SELECT event_id AS task_id, CASE WHEN event_type = 'error' THEN 'manual_review_required' WHEN event_type = 'view' AND user_id % 5 = 0 THEN 'retry_pending' WHEN event_type IN ('view', 'click') THEN 'completed' ELSE 'pending' END AS status FROM events")
def dispatched(spark: SparkSession, sf: str) -> DataFrame:
    tasks = table(spark, sf, "events").selectExpr("event_id AS task_id", "event_type AS task_type", "user_id", "'pending' AS status", "CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS attempt_count", "3 AS max_attempts", "CAST('2024-03-01' AS TIMESTAMP) AS available_after")
    handlers = {"view": lambda t: t.select("task_id", (F.col("user_id") % 5 != 0).alias("ok")), "click": lambda t: t.select("task_id", F.lit(True).alias("ok")), "error": lambda t: t.select("task_id", F.lit(False).alias("ok"))}
    return D.dispatched(tasks, F.lit("2024-03-02").cast("timestamp"), handlers).select("task_id", "status")


@query("r3_settle_polls", "SELECT c_nationkey::BIGINT AS component_id, CASE WHEN c_nationkey % 3 = 0 THEN 'settled' WHEN c_nationkey % 5 = 0 THEN 'stalled' ELSE 'pending' END AS status, CASE WHEN c_nationkey % 3 <> 0 AND c_nationkey % 5 <> 0 THEN TIMESTAMP '2024-03-01 00:30:00' END AS available_after, c_nationkey % 7 + CASE WHEN c_nationkey % 3 <> 0 AND c_nationkey % 5 <> 0 THEN 1 ELSE 0 END AS generation FROM customer GROUP BY 1, 2, 3, 4")
def polls(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr("CAST(c_nationkey AS BIGINT) AS component_id", "c_nationkey % 7 AS generation", "CASE WHEN c_nationkey % 3 = 0 THEN 'settled' WHEN c_nationkey % 5 = 0 THEN 'stalled' ELSE 'pending' END AS status").distinct()
    return D.polled(c, F.lit("2024-03-01").cast("timestamp"), 30)


@query("p20_backfills", """
    WITH s AS (SELECT c_custkey AS study_id, CASE WHEN c_nationkey % 4 = 0 THEN 'not_accessible' ELSE 'candidate' END AS st, c_custkey % 3 = 0 AS pmc, c_custkey % 2 = 0 AS facts, c_custkey % 5 = 0 AS supplements FROM customer),
    w AS (SELECT study_id, 'discover_identifiers' AS t FROM s WHERE st = 'candidate' UNION ALL SELECT study_id, 'extract_text' FROM s WHERE pmc AND st <> 'not_accessible' UNION ALL SELECT study_id, 'map' FROM s WHERE facts UNION ALL SELECT study_id, 'validate' FROM s WHERE facts UNION ALL SELECT study_id, 'discover_supplements' FROM s WHERE pmc UNION ALL SELECT study_id, 'retrieve_supplements' FROM s WHERE supplements)
    SELECT study_id, t AS task_type FROM w WHERE NOT (t = 'map' AND study_id % 4 = 0)""")
def backfills(spark: SparkSession, sf: str) -> DataFrame:
    studies = table(spark, sf, "customer").selectExpr("c_custkey AS study_id", "CASE WHEN c_nationkey % 4 = 0 THEN 'not_accessible' ELSE 'candidate' END AS status", "c_custkey % 3 = 0 AS has_pmcid", "c_custkey % 2 = 0 AS has_facts", "c_custkey % 5 = 0 AS has_supplements", "false AS has_supplement_files", "false AS has_values", "false AS refreshable")
    queued = D.backfill_tasks(studies).where("task_type = 'map' AND study_id % 4 = 0").select("idempotency_key")
    return D.enqueued(queued, studies).select("study_id", "task_type")

"""Queries over mining, table choice, crosswalks, inventories and queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.operators import checks, mapping as M, mining, predicates as P, seeds as S


@query("x4_staged_identifiers", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'bioproject_accession' WHEN 1 THEN 'dataset_doi' WHEN 2 THEN 'repository_url' END AS identifier_type, CASE o_orderkey % 4 WHEN 0 THEN concat('PRJNA', o_orderkey) WHEN 1 THEN concat('10.5281/zenodo.', o_orderkey) ELSE concat('https://osf.io/', o_orderkey) END AS value, o_orderkey % 4 + 1 AS pass FROM orders WHERE o_orderkey % 4 < 3")
def staged(spark: SparkSession, sf: str) -> DataFrame:
    t = F.expr("concat('see ', CASE WHEN o_orderkey % 4 = 0 THEN concat('PRJNA', CAST(o_orderkey AS STRING), ', ') ELSE '' END, CASE WHEN o_orderkey % 4 <= 1 THEN concat('10.5281/zenodo.', CAST(o_orderkey AS STRING), '. ') ELSE '' END, CASE WHEN o_orderkey % 4 <= 2 THEN concat('https://osf.io/', CAST(o_orderkey AS STRING), ';') ELSE '' END)")
    return mining.staged(table(spark, sf, "orders").select("o_orderkey", t.alias("t")), "o_orderkey", "t").withColumn("pass", F.col("pass").cast("long"))


@query("j4_only_related", "SELECT l_orderkey AS from_id, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS to_id, count(DISTINCT l_suppkey) > 1 AS ambiguous FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def only_related(spark: SparkSession, sf: str) -> DataFrame:
    return mining.only_related(table(spark, sf, "lineitem").selectExpr("l_orderkey AS from_id", "l_suppkey AS to_id", "l_returnflag AS kind"), "R")


@query("j9_siblings", "WITH l AS (SELECT DISTINCT o_custkey AS study_id, o_orderkey % 5000 AS entity_id FROM orders) SELECT a.study_id, count(DISTINCT b.study_id) AS n FROM l a JOIN l b USING (entity_id) WHERE a.study_id <> b.study_id GROUP BY 1")
def siblings(spark: SparkSession, sf: str) -> DataFrame:
    return mining.siblings(table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "o_orderkey % 5000 AS entity_id"))


@query("t16_table_choice", "SELECT DISTINCT p_type AS field, CASE WHEN p_type = 'STANDARD' THEN 'fixed' WHEN EXISTS (SELECT 1 FROM part q WHERE q.p_type = part.p_type AND q.p_size % 7 = 0) THEN 'sample' WHEN EXISTS (SELECT 1 FROM part q WHERE q.p_type = part.p_type AND q.p_size % 7 = 1) THEN 'run' ELSE 'projectMetadata' END AS target_table FROM part")
def table_choice(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    classes = p.selectExpr("p_type AS field", "CASE p_size % 7 WHEN 0 THEN 'sample' WHEN 1 THEN 'run' ELSE 'other' END AS class")
    return mining.chosen_table(p.selectExpr("p_type AS field").distinct(), classes, ["sample", "run"], {"STANDARD": "fixed"})


@query("a13_flag_resolution", "SELECT l_orderkey, l_returnflag, max(CASE WHEN l_quantity > 25 THEN '1' ELSE '0' END) AS value FROM lineitem GROUP BY 1, 2")
def flag_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return mining.resolved_flags(table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_returnflag", "CASE WHEN l_quantity > 25 THEN '1' ELSE '0' END AS value"), ["l_orderkey", "l_returnflag"])


@query("x26_merged_maps", "SELECT o_orderkey, CASE WHEN lower(o_orderstatus) = lower(o_orderpriority) THEN o_orderstatus ELSE concat(o_orderstatus, ' | ', o_orderpriority) END AS a, 'x' AS b, NULL::VARCHAR AS c FROM orders")
def merged_maps(spark: SparkSession, sf: str) -> DataFrame:
    m = mining.merged_maps(F.create_map(F.lit("a"), F.col("o_orderstatus"), F.lit("b"), F.lit("x")), F.create_map(F.lit("a"), F.col("o_orderpriority"), F.lit("b"), F.lit("X"), F.lit("c"), F.lit("no")), ["c"])
    return table(spark, sf, "orders").select("o_orderkey", m["a"].alias("a"), m["b"].alias("b"), F.try_element_at(m, F.lit("c")).alias("c"))


@query("r8_retry_sweep", "SELECT event_id, CASE WHEN event_type = 'error' AND date_diff('day', ts::DATE, DATE '2024-02-10') >= 20 THEN 'pending' WHEN event_type = 'error' THEN 'failed' ELSE 'running' END AS status, CASE WHEN event_type = 'error' AND date_diff('day', ts::DATE, DATE '2024-02-10') >= 20 THEN 0 ELSE 3 END AS attempt_count FROM events")
def retry_sweep(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "events").selectExpr("event_id", "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'running' END AS status", "3 AS attempt_count", "CAST(ts AS DATE) AS updated_at")
    return mining.reset_failed(t, F.lit("2024-02-10").cast("date"), 20).select("event_id", "status", "attempt_count")


@query("r6_crawl_cursor", "SELECT user_id, count(*) AS pages, last(event_id ORDER BY event_id) AS cursor FROM events GROUP BY 1")
def crawl_cursor(spark: SparkSession, sf: str) -> DataFrame:
    return mining.run_windows(table(spark, sf, "events").selectExpr("user_id", "event_id AS cursor", "event_id AS page"), "user_id")


@query("l2_resolution_queue", "SELECT o_orderkey AS study_id FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 99 END, o_orderkey LIMIT 20")
def resolution_queue(spark: SparkSession, sf: str) -> DataFrame:
    return S.resolution_queue(table(spark, sf, "orders").selectExpr("o_orderkey AS study_id", "o_orderstatus AS status"), {"P": 0, "O": 1}, 20).select("study_id")


@query("f5_plausible_publication", "SELECT o_orderkey, (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0) AND NOT (o_orderkey % 5 = 0 AND o_orderkey % 7 = 0) AND o_orderkey % 11 <> 0 AS ok FROM orders")
def plausible(spark: SparkSession, sf: str) -> DataFrame:
    e = F.expr
    return table(spark, sf, "orders").select("o_orderkey", P.plausible_publication(e("o_orderkey % 2 = 0"), e("CASE WHEN o_orderkey % 3 = 0 THEN 'T' END"), e("CASE WHEN o_orderkey % 5 = 0 THEN 'preprint' END"), e("CASE WHEN o_orderkey % 7 = 0 THEN 'low' ELSE 'high' END"), e("CASE WHEN o_orderkey % 11 = 0 THEN 'doi' ELSE '10.1234/x' END")).alias("ok"))


@query("f6_publication_title", "SELECT p_partkey, p_partkey % 2 = 0 AS ok FROM part")
def publication_title(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", P.publication_title(F.expr("CASE WHEN p_partkey % 4 = 0 THEN 'Microbial diversity of the deep sea' WHEN p_partkey % 2 = 0 THEN 'A study of five coastal sites' WHEN p_partkey % 4 = 1 THEN 'Raw reads' ELSE 'one two six ten four five' END")).alias("ok"))


@query("v7_evidence_failures", "SELECT event_id AS fact_id FROM events WHERE event_type = 'view' AND event_id % 2 = 1 AND event_id % 5 <> 0")
def evidence_failures(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").selectExpr("event_id AS fact_id", "CASE WHEN event_type = 'view' THEN 'explicit' ELSE 'other' END AS support", "CASE WHEN event_id % 2 = 0 THEN 'q' END AS quote")
    return checks.evidence_failures(e, e.where("fact_id % 5 = 0"), P.evidence_ok(F.col("support"), F.col("quote"), F.lit("x"))).select("fact_id")


@query("v10_asset_inventory", "SELECT p_partkey AS entity_id, concat('ftp/', p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '.fastq.gz' ELSE '.bam' END) AS url, CASE WHEN p_partkey % 3 = 0 THEN p_size::BIGINT END AS size_bytes, CASE WHEN p_partkey % 2 = 0 THEN 'fastq' ELSE 'bam' END AS format FROM part WHERE p_partkey % 5 <> 0")
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    url = "concat('ftp/', CAST(p_partkey AS STRING), CASE WHEN p_partkey % 2 = 0 THEN '.fastq.gz' ELSE '.bam' END)"
    p = table(spark, sf, "part")
    facts = p.selectExpr("p_partkey AS entity_id", f"stack(3, 'fastq_ftp', 'old', 0, 'fastq_ftp', {url}, 1, 'fastq_bytes', CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS STRING) ELSE 'n/a' END, 0) AS (field, value, created_at)").withColumn("fact_id", F.col("created_at"))
    return checks.asset_inventory(facts, p.where("p_partkey % 5 = 0").selectExpr(f"{url} AS url"), ["fastq_ftp", "fastq_bytes"])


@query("j17_crosswalk", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'T1' WHEN 1 THEN 'T2' WHEN 2 THEN 'T1' END AS target, CASE p_partkey % 4 WHEN 0 THEN 'name' WHEN 1 THEN 'alias' WHEN 2 THEN 'case' ELSE 'unresolved' END AS method FROM part")
def crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").selectExpr("p_partkey", "CASE p_partkey % 4 WHEN 0 THEN 'Depth' WHEN 1 THEN 'deepness' WHEN 2 THEN 'DEPTH' ELSE p_name END AS term")
    found = M.crosswalk(rows.select("term").distinct(), spark.createDataFrame([("Depth", "T1")], "name string, target string"), spark.createDataFrame([("deepness", "T2")], "alias string, target string"))
    return rows.join(found, "term").select("p_partkey", "target", "method")


@query("p9_normalised_suppression", "SELECT o_orderkey AS fact_id FROM orders WHERE o_orderkey % 4 = 0 OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 0)")
def suppression(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "o_orderkey AS fact_id", "'device' AS target_field")
    return M.without_replaced(f, f.where("fact_id % 4 = 0")).select("fact_id")


@query("p4_corpus_primers", "WITH n AS (SELECT o_custkey AS study_id, min(lower(o_orderpriority)) AS x FROM orders GROUP BY 1), k AS (SELECT lower(o_orderpriority) AS name, first(concat('SEQ', o_custkey) ORDER BY o_orderdate, concat('SEQ', o_custkey)) AS sequence FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1) SELECT DISTINCT o_custkey AS study_id, lower(o_orderpriority) AS name, sequence FROM orders JOIN k ON k.name = lower(o_orderpriority) WHERE o_custkey % 3 <> 0")
def corpus_primers(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    names = o.selectExpr("o_custkey AS study_id", "'name' AS kind", "o_orderpriority AS value", "o_orderdate AS created_at")
    seqs = o.where("o_custkey % 3 = 0").selectExpr("o_custkey AS study_id", "'sequence' AS kind", "concat('SEQ', CAST(o_custkey AS STRING)) AS value", "o_orderdate AS created_at").dropDuplicates(["study_id"])
    return M.primers_from_corpus(names.unionByName(seqs))


@query("j16_fused_primers", "SELECT p_partkey AS study_id, concat(repeat('ACGT', 4), 'A') AS primer, repeat('T', 10 + p_size % 5) AS adapter FROM part WHERE p_partkey % 2 = 0")
def fused(spark: SparkSession, sf: str) -> DataFrame:
    core = "concat(repeat('ACGT', 4), 'A')"
    p = table(spark, sf, "part").selectExpr("p_partkey AS study_id", f"stack(2, {core}, CASE WHEN p_partkey % 2 = 0 THEN concat(repeat('t', 10 + p_size % 5), {core}) ELSE 'NAME' END) AS (sequence)")
    return M.fused_primers(p, ["study_id"])


@query("p21_merged_candidates", "SELECT o_custkey AS study_id, min(o_orderkey) AS candidate_id, o_orderpriority AS doi, max(o_totalprice) AS score FROM orders GROUP BY o_custkey, o_orderpriority")
def merged_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "o_orderkey AS id", "o_orderpriority AS doi", "CASE WHEN o_orderkey % 2 = 0 THEN concat(CAST(o_custkey AS STRING), o_orderpriority) END AS pmid", "o_totalprice AS score")
    return S.merged_candidates(rows, ["doi", "pmid"], [], "score").drop("pmid")

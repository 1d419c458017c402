"""Queries over identity, graph and matching operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.operators import graph as G
from tidemark.operators import links as L


@query("j1_identifier_match", """
    WITH c AS (SELECT l_orderkey AS row_id, l_linenumber AS position, l_suppkey AS value FROM lineitem), k AS (SELECT s_suppkey AS value, s_nationkey AS study_id FROM supplier WHERE s_acctbal > 0)
    SELECT row_id, first(study_id ORDER BY position, study_id) AS study_id FROM c JOIN k USING (value) GROUP BY row_id""")
def identifier_match(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("row_id"), F.col("l_linenumber").alias("position"), F.lit("s").alias("type"), F.col("l_suppkey").alias("value"))
    return L.by_identifier(c, table(spark, sf, "supplier").where("s_acctbal > 0").select(F.lit("s").alias("type"), F.col("s_suppkey").alias("value"), F.col("s_nationkey").alias("study_id")))


@query("g1_study_components", """
    WITH RECURSIVE link AS (SELECT c_custkey AS a, c_custkey - 1 AS b FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey > 1 UNION SELECT c_custkey - 1, c_custkey FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey > 1),
    r(a, b) AS (SELECT c_custkey, c_custkey FROM customer UNION SELECT r.a, link.b FROM r JOIN link ON r.b = link.a)
    SELECT a AS study_id, min(b) AS component_id FROM r GROUP BY a""")
def components(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("study_id"))
    lineage = c.where("study_id % 7 <> 0 AND study_id > 1").select("study_id", (F.col("study_id") - 1).alias("parent_id"))
    shared = c.join(table(spark, sf, "orders").select(F.col("o_custkey").alias("study_id"), F.col("o_orderkey").alias("entity_id")), "study_id").select("study_id", "entity_id")
    return G.study_components(c, shared, lineage)


@query("g3_merge_studies", """
    WITH t AS (SELECT o_orderkey AS row_id, CASE WHEN o_custkey % 3 = 1 THEN o_custkey - 1 WHEN o_custkey % 3 = 2 THEN o_custkey - 2 ELSE o_custkey END AS study_id, o_orderpriority AS value FROM orders)
    SELECT study_id, value, min(row_id) AS row_id FROM t GROUP BY ALL""")
def merge(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("s")).union(table(spark, sf, "orders").select("o_custkey")).distinct()
    steps = c.where("s % 3 <> 0").select(F.col("s").alias("study_id"), (F.col("s") - 1).alias("into_id"))
    steps = steps.union(steps.where("into_id % 3 = 1").select("into_id", F.col("into_id") - 1)).distinct()
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("study_id"), F.col("o_orderpriority").alias("value"))
    return G.repoint(rows, G.merged_ids(steps), ["study_id", "value"], ["row_id"]).select("study_id", "value", "row_id")


@query("g5_roots", """
    WITH l AS (SELECT DISTINCT l_partkey AS entity_id, l_suppkey AS study_id FROM lineitem), y AS (SELECT s_suppkey AS study_id, CASE WHEN s_suppkey % 11 <> 0 THEN 1990 + s_suppkey % 30 END AS year FROM supplier),
    j AS (SELECT * FROM l LEFT JOIN y USING (study_id)), n AS (SELECT entity_id, count(*) AS n, min(study_id) AS only_one, min(year) AS y0 FROM j GROUP BY 1),
    w AS (SELECT entity_id, count(*) AS k, min(study_id) AS win FROM j JOIN n USING (entity_id) WHERE year = y0 GROUP BY 1)
    SELECT entity_id, CASE WHEN n = 1 THEN only_one WHEN k = 1 THEN win END AS root_study_id, CASE WHEN n = 1 OR k = 1 THEN 'determined' ELSE 'ambiguous' END AS root_status FROM n LEFT JOIN w USING (entity_id)""")
def roots(spark: SparkSession, sf: str) -> DataFrame:
    years = table(spark, sf, "supplier").selectExpr("s_suppkey AS study_id", "CASE WHEN s_suppkey % 11 <> 0 THEN 1990 + s_suppkey % 30 END AS year")
    return G.roots(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("entity_id"), F.col("l_suppkey").alias("study_id")), years)


@query("g6_entity_homes", """
    WITH c AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'sample' ELSE 'assay' END AS level, l_suppkey AS study_id, CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END AS accession, l_shipdate AS created_at FROM lineitem),
    g AS (SELECT level, accession, CASE WHEN level = 'sample' THEN '*' ELSE study_id::VARCHAR END AS scope, first(study_id ORDER BY created_at, study_id) AS home, count(DISTINCT study_id) AS n FROM c WHERE accession IS NOT NULL GROUP BY ALL)
    SELECT level, accession, home, CASE WHEN n > 1 THEN 'pending' ELSE 'determined' END AS root_status FROM g""")
def homes(spark: SparkSession, sf: str) -> DataFrame:
    claims = table(spark, sf, "lineitem").selectExpr("CASE WHEN l_linenumber % 2 = 0 THEN 'sample' ELSE 'assay' END AS level", "l_suppkey AS study_id", "CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END AS accession", "l_shipdate AS created_at")
    return G.entity_homes(claims, ("sample",))


@query("g7_citation_expansion", """
    WITH e AS (SELECT l_suppkey AS src, l_partkey % 100 + 1000 AS dst FROM lineitem UNION SELECT l_partkey % 100 + 1000, l_suppkey FROM lineitem),
    t AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS k FROM (SELECT DISTINCT src, dst FROM e)) WHERE k <= 3),
    d0 AS (SELECT 1 AS node), d1 AS (SELECT DISTINCT dst AS node FROM t WHERE src IN (SELECT node FROM d0) AND dst NOT IN (SELECT node FROM d0)),
    d2 AS (SELECT DISTINCT dst AS node FROM t WHERE src IN (SELECT node FROM d1) AND dst NOT IN (SELECT node FROM d0 UNION SELECT node FROM d1))
    SELECT node, 0 AS depth FROM d0 UNION ALL SELECT node, 1 FROM d1 UNION ALL SELECT node, 2 FROM d2""")
def expansion(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s"), (F.col("l_partkey") % 100 + 1000).alias("p"))
    start = table(spark, sf, "supplier").where("s_suppkey = 1").select(F.col("s_suppkey").alias("node"))
    return G.expand(start, li.select(F.col("s").alias("src"), F.col("p").alias("dst")).union(li.select("p", "s")), 2, 3)


@query("g9_settle", """
    WITH m AS (SELECT c_nationkey AS component_id, c_custkey AS study_id FROM customer), b AS (SELECT DISTINCT o_custkey AS study_id FROM orders WHERE o_orderstatus = 'P'),
    s AS (SELECT component_id, max(CASE WHEN b.study_id IS NOT NULL THEN 1 ELSE 0 END) AS busy FROM m LEFT JOIN b USING (study_id) GROUP BY 1)
    SELECT component_id, CASE WHEN busy = 0 THEN 'settled' WHEN component_id > 20 THEN 'stalled' ELSE 'pending' END AS status FROM s""")
def settle(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "customer").select(F.col("c_nationkey").alias("component_id"), F.col("c_custkey").alias("study_id"))
    before = m.groupBy("component_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_set(F.col("study_id").cast("string"))), ","), 256).alias("signature"))
    busy = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("study_id"))
    return G.settled(m, before, busy, F.col("component_id"), 20).select("component_id", "status")


@query("j13_sample_aliases", """
    WITH a AS (SELECT c_custkey AS alias_id, c_nationkey AS study_id, list_filter(regexp_split_to_array(lower(concat('S-', c_custkey % 40)), '[\\s_\\-./:]+'), lambda x: x <> '') AS t FROM customer),
    c AS (SELECT s_suppkey AS sample_id, s_nationkey AS study_id, list_filter(regexp_split_to_array(lower(concat('Site_', s_nationkey, '.s-', s_suppkey % 40)), '[\\s_\\-./:]+'), lambda x: x <> '') AS t FROM supplier),
    m AS (SELECT a.study_id, a.alias_id, c.sample_id FROM a LEFT JOIN c ON a.study_id = c.study_id AND len(c.t) >= len(a.t) AND c.t[len(c.t) - len(a.t) + 1 :] = a.t)
    SELECT study_id, alias_id, CASE count(DISTINCT sample_id) WHEN 0 THEN 'none' WHEN 1 THEN 'matched' ELSE 'ambiguous' END AS outcome, CASE WHEN count(DISTINCT sample_id) = 1 THEN min(sample_id) END AS match FROM m GROUP BY ALL""")
def sample_aliases(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").selectExpr("c_nationkey AS study_id", "c_custkey AS alias_id", "concat('S-', CAST(c_custkey % 40 AS STRING)) AS name")
    c = table(spark, sf, "supplier").selectExpr("s_nationkey AS study_id", "s_suppkey AS sample_id", "concat('Site_', CAST(s_nationkey AS STRING), '.s-', CAST(s_suppkey % 40 AS STRING)) AS name")
    return L.aliases(a, c)


@query("j14_consistency", """
    WITH o AS (SELECT o_custkey AS study_id, min(o_orderdate::DATE) AS lo, max(o_orderdate::DATE) AS hi, min(o_orderkey % 60) AS la, max(o_orderkey % 60) AS lb, min(o_orderkey % 170) AS ga, max(o_orderkey % 170) AS gb FROM orders GROUP BY 1),
    n AS (SELECT l_suppkey AS source_id, min(l_shipdate::DATE) AS nlo, max(l_shipdate::DATE) AS nhi, min(l_partkey % 10 + 20) AS nla, max(l_partkey % 10 + 20) AS nlb, min(l_partkey % 20 + 60) AS nga, max(l_partkey % 20 + 60) AS ngb FROM lineitem WHERE l_suppkey % 3 <> 0 GROUP BY 1),
    p AS (SELECT c_custkey AS pair_id, c_custkey AS study_id, c_custkey % 100 + 1 AS source_id FROM customer),
    x AS (SELECT pair_id, CASE WHEN lo IS NULL THEN 'not_assessed' WHEN nlo IS NULL THEN CASE WHEN hi - lo > 730 THEN 'inconsistent' ELSE 'not_assessed' END WHEN nlo <= hi + 365 AND nhi >= lo - 365 THEN 'consistent' ELSE 'inconsistent' END AS dates,
        CASE WHEN la IS NULL OR nla IS NULL THEN 'not_assessed' WHEN nla >= la - 2 AND nlb <= lb + 2 AND nga >= ga - 2 AND ngb <= gb + 2 THEN 'consistent' ELSE 'inconsistent' END AS places
        FROM p LEFT JOIN o USING (study_id) LEFT JOIN n USING (source_id))
    SELECT *, CASE WHEN dates = 'inconsistent' OR places = 'inconsistent' THEN 'inconsistent' WHEN dates = 'consistent' OR places = 'consistent' THEN 'consistent' ELSE 'not_assessed' END AS status FROM x""")
def consistency(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "customer").selectExpr("c_custkey AS pair_id", "c_custkey AS study_id", "c_custkey % 100 + 1 AS source_id")
    old = table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "CAST(o_orderdate AS DATE) AS date", "CAST(o_orderkey % 60 AS DOUBLE) AS lat", "CAST(o_orderkey % 170 AS DOUBLE) AS lon")
    new = table(spark, sf, "lineitem").where("l_suppkey % 3 <> 0").selectExpr("l_suppkey AS source_id", "CAST(l_shipdate AS DATE) AS date", "CAST(l_partkey % 10 + 20 AS DOUBLE) AS lat", "CAST(l_partkey % 20 + 60 AS DOUBLE) AS lon")
    return L.consistency(pairs, old, new)


@query("x14_replicates", """
    WITH n AS (SELECT c_nationkey, c_custkey, CASE c_custkey % 3 WHEN 0 THEN concat('Site', c_custkey % 5, '_rep', c_custkey) WHEN 1 THEN concat('LM', c_custkey % 4, ' ', c_custkey) ELSE concat('Bay', c_custkey % 6, '-', chr((65 + c_custkey % 4)::INT)) END AS name FROM customer),
    b AS (SELECT *, CASE c_custkey % 3 WHEN 0 THEN concat('Site', c_custkey % 5) WHEN 1 THEN concat('LM', c_custkey % 4) ELSE concat('Bay', c_custkey % 6) END AS base, CASE c_custkey % 3 WHEN 0 THEN 'explicit_rep_marker' WHEN 1 THEN 'trailing_number_suffix' ELSE 'trailing_letter_suffix' END AS signal, c_custkey % 4 AS letter FROM n),
    g AS (SELECT c_nationkey, base, signal, count(*) AS k, count(DISTINCT letter) AS d, max(letter) - min(letter) + 1 AS w FROM b GROUP BY ALL)
    SELECT b.c_nationkey, c_custkey AS sample_id, base, signal FROM b JOIN g USING (c_nationkey, base, signal) WHERE CASE WHEN signal = 'trailing_letter_suffix' THEN k >= 3 AND d = k AND w = k ELSE k >= 2 END""")
def replicates(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "customer").selectExpr("c_nationkey", "c_custkey AS sample_id", "CASE c_custkey % 3 WHEN 0 THEN concat('Site', CAST(c_custkey % 5 AS STRING), '_rep', CAST(c_custkey AS STRING)) WHEN 1 THEN concat('LM', CAST(c_custkey % 4 AS STRING), ' ', CAST(c_custkey AS STRING)) ELSE concat('Bay', CAST(c_custkey % 6 AS STRING), '-', chr(65 + c_custkey % 4)) END AS name")
    return L.replicates(n, ["c_nationkey"])


@query("x15_equal_conditions", "SELECT l_orderkey, min(l_linenumber) AS first, count(*) AS n FROM lineitem GROUP BY l_orderkey, lower(l_returnflag), lower(l_linestatus), CASE WHEN l_partkey % 2 = 0 THEN l_suppkey % 2 END HAVING count(*) > 1")
def equal_conditions(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber AS sample_id", "l_returnflag AS a", "l_linestatus AS b", "CASE WHEN l_partkey % 2 = 0 THEN CAST(l_suppkey % 2 AS STRING) END AS assay")
    return L.equal_conditions(s, ["l_orderkey"], ["a", "b"], "assay")

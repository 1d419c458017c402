"""Queries over sections with a mock model, sinks as tables, and SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.functions.register import register
from tidemark.operators import sections as S
from tidemark.operators import texts as X
from tidemark.plans import export

NOTES = "concat('Sampling was done in ', p_type, '. The weather was fine. Water was filtered on ', p_brand, '. Nothing else. DNA came from kit K', CAST(p_size AS STRING), '.')"
MOCK = S.ByWords({"sampling": r"(?i)\b(?:sampling|filtered)\b", "extraction": r"\bDNA\b", "unknown": r"weather"})


def categories(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("section_id"), F.expr(NOTES).alias("t"))
    return S.categorised(rows, X.sentences(F.col("t")), MOCK, ["sampling", "extraction"])


@query("m3_sentence_categories", "SELECT p_partkey::VARCHAR AS section_id, unnest(['P001', 'P002', 'P003', 'P004', 'P005']) AS p, unnest(['sampling', NULL, 'sampling', NULL, 'extraction']) AS category FROM part")
def sentence_categories(spark: SparkSession, sf: str) -> DataFrame:
    return categories(spark, sf).select("section_id", F.substring_index("segment_id", ".", -1).alias("p"), "category")


TERMS = S.ByWords({"place": r"in ([A-Z]+)\b", "filter": r"on (Brand#\d+)", "kit": r"kit (K\d+)", "other": r"fine"})


@query("m3_terms_and_leftovers", """
    SELECT p_partkey::VARCHAR AS section_id, 'place' AS term, p_type AS value FROM part WHERE regexp_matches(p_type, '^[A-Z]+$') UNION ALL SELECT p_partkey::VARCHAR, 'filter', p_brand FROM part UNION ALL SELECT p_partkey::VARCHAR, 'kit', concat('K', p_size) FROM part
    UNION ALL SELECT p_partkey::VARCHAR, 'left', 'The weather was fine.' FROM part UNION ALL SELECT p_partkey::VARCHAR, 'left', concat('Sampling was done in ', p_type, '.') FROM part WHERE NOT regexp_matches(p_type, '^[A-Z]+$')""")
def terms(spark: SparkSession, sf: str) -> DataFrame:
    facts, left = S.term_facts(S.run_texts(categories(spark, sf), 2), TERMS, {"sampling": ["place", "filter"], "extraction": ["kit"]})
    at = F.substring_index("run", "#", 1).alias("section_id")
    return facts.select(at, "term", "value").unionByName(left.select(at, F.lit("left").alias("term"), F.col("text").alias("value")))


@query("m4_normal_forms", """
    WITH v AS (SELECT o_custkey AS study_id, o_orderkey AS position, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'Urgent' WHEN '3-MEDIUM' THEN 'Normal' WHEN '5-LOW' THEN 'Slow' END AS term FROM orders), f AS (SELECT study_id, term, min(position) AS position FROM v WHERE term IS NOT NULL GROUP BY 1, 2)
    SELECT study_id, string_agg(term, ' | ' ORDER BY position) AS value FROM f GROUP BY 1""")
def normal_forms(spark: SparkSession, sf: str) -> DataFrame:
    values = table(spark, sf, "orders").selectExpr("o_custkey AS study_id", "o_orderkey AS position", "CASE o_orderpriority WHEN '3-MEDIUM' THEN ' NORMAL ' ELSE o_orderpriority END AS value")
    model = S.ByWords({"term": r"URGENT|HIGH|LOW|^4-NOT"})

    class Said(S.Backend):
        """Answers with a term of the vocabulary, and once with one that isn't."""

        def generate(self, prompt: str) -> str:
            word = model.generate(prompt)
            said = "urgent" if "URGENT" in word or "HIGH" in word else "Slow" if "LOW" in word else "Whatever"
            return f'[{{"fact_type": "term", "value": "{said}"}}]'

    return S.normalised(values, Said(), ["Urgent", "Normal", "Slow"])


@query("m5_study_facts", """
    SELECT c_custkey AS study_id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat(c_mktsegment, ' Fund') END AS value, CASE WHEN c_custkey % 3 = 0 THEN 'model' ELSE 'pattern' END AS method FROM customer WHERE c_custkey % 4 <> 0 AND (c_custkey % 3 = 0 OR c_custkey % 5 <> 0)""")
def study_facts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "study_id")
    text = "concat(CASE WHEN study_id % 5 <> 0 THEN concat('This work was supported by the ', c_mktsegment, ' Fund. ') ELSE 'We thank all. ' END, CASE WHEN study_id % 3 = 0 THEN concat('Grant of ', c_name, ' too') ELSE '' END)"
    rows = c.selectExpr("study_id", "1 AS position", "CASE WHEN study_id % 4 = 0 THEN 'Results' WHEN study_id % 2 = 0 THEN 'Acknowledgements' ELSE 'FUNDING information' END AS title", f"{text} AS text")
    return S.study_facts(rows.unionByName(c.selectExpr("study_id", "0 AS position", "'Discussion' AS title", "'funded by Nobody' AS text")), S.ByWords({"funding_source": r"Grant of (Customer#\d+)"}), "funding_source")


LAYOUT = {"projectMetadata": ["brand", "type"], "sampleMetadata": ["size", "type", "Brand"]}


@query("sk2_field_reference", "SELECT f AS faire_field, CASE f WHEN 'type' THEN 'projectMetadata|sampleMetadata' WHEN 'brand' THEN 'projectMetadata' ELSE 'sampleMetadata' END AS faire_classes, CASE f WHEN 'type' THEN 'M' ELSE '' END AS requirement_level_code, '' AS requirement_level_condition, CASE f WHEN 'type' THEN 'string' ELSE '' END AS range, CASE f WHEN 'type' THEN 'a:b|c:d' ELSE '' END AS exact_mappings FROM (SELECT unnest(['brand', 'type', 'size', 'Brand']) AS f)")
def field_reference(spark: SparkSession, sf: str) -> DataFrame:
    return export.field_reference(spark, LAYOUT, spark.createDataFrame([("type", "M", None, "string", ["a:b", "c:d"]), ("unused", "O", "x", "y", [])], "field string, requirement_level_code string, requirement_level_condition string, range string, exact_mappings array<string>"))


@query("sk2_corrections", "SELECT CASE WHEN c_custkey % 2 = 0 THEN concat('10.1/', c_custkey) ELSE c_custkey::VARCHAR END AS paper_reference, c_custkey::VARCHAR AS internal_study_id, 'elev' AS api_faire_term, c_nationkey::VARCHAR AS api_value, 'depth' AS corrected_faire_term, '' AS corrected_value, c_name AS supporting_quote, 'rule' AS detector FROM customer")
def corrections(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "study_id")
    rows = c.selectExpr("study_id", "study_id AS created_at", "'elev' AS api_faire_term", "c_nationkey AS api_value", "'depth' AS corrected_faire_term", "c_name AS supporting_quote", "'rule' AS detector")
    ids = c.where("study_id % 2 = 0").selectExpr("study_id", "explode(array('pmid', 'doi')) AS type", "concat('10.1/', CAST(study_id AS STRING)) AS value")
    return export.corrections(rows, ids)


def standards(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    p = table(spark, sf, "part")
    terms = p.selectExpr("p_type AS id", "p_type AS name", "CASE WHEN p_type = 'PROMO' THEN 'nowhere' END AS parent", "'checklist' AS standard").distinct()
    fields = p.selectExpr("concat('t', CAST(p_size % 3 AS STRING)) AS template_file", "p_brand AS protocol_section", "CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) ELSE p_name END AS field_name", "CAST(p_size AS STRING) AS value")
    names = terms.select("name", F.col("id").alias("target"))
    return export.registry(terms, fields, names, spark.createDataFrame([("cold widget", "PROMO")], "alias string, target string"))


@query("p18_crosswalk", """
    WITH f AS (SELECT concat('t', p_size % 3) AS template_file, p_brand AS protocol_section, CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) ELSE p_name END AS field_name, p_size::VARCHAR AS value, p_type, p_partkey % 3 AS k FROM part)
    SELECT template_file, protocol_section, field_name, value, CASE k WHEN 0 THEN 'name' WHEN 1 THEN 'case' ELSE CASE WHEN field_name = 'cold widget' THEN 'alias' ELSE 'template_specific' END END AS resolution, CASE k WHEN 0 THEN p_type WHEN 1 THEN p_type ELSE CASE WHEN field_name = 'cold widget' THEN 'PROMO' ELSE concat('template:', lower(field_name)) END END AS canonical_id, CASE k WHEN 0 THEN '1' WHEN 1 THEN '3' ELSE CASE WHEN field_name = 'cold widget' THEN '2' ELSE '' END END AS match_priority FROM f""")
def crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    return standards(spark, sf)["term_crosswalk"]


@query("sk4_registry_counts", """
    WITH f AS (SELECT concat('t', p_size % 3) AS t, p_brand AS s, CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) ELSE p_name END AS field_name, CASE WHEN p_partkey % 3 < 2 THEN p_type WHEN p_name = 'cold widget' THEN 'PROMO' ELSE concat('template:', p_name) END AS id FROM part)
    SELECT 'terms' AS name, count(DISTINCT p_type) AS n FROM part UNION ALL SELECT 'template_terms', count(DISTINCT id) FROM f WHERE id LIKE 'template:%' UNION ALL SELECT 'term_crosswalk', count(*) FROM part UNION ALL SELECT 'template_field_usage', count(DISTINCT (id, t, s)) FROM f UNION ALL SELECT 'validation_report', count(DISTINCT p_type) FROM part WHERE p_type = 'PROMO'""")
def registry_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name, rows in standards(spark, sf).items():
        n = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("sk6_seed_rows", "SELECT concat('ena:', l_orderkey) AS seed_id, concat('About ', l_orderkey) AS title, CASE WHEN l_orderkey % 2 = 0 THEN concat('10.1/', l_orderkey) ELSE '' END AS doi, '' AS pmid, '' AS pmcid, concat('PRJNA', l_orderkey) AS bioproject_accession, CASE WHEN l_orderkey % 3 = 0 THEN concat('ERP', l_orderkey) ELSE '' END AS ena_study_accession, concat('SRP', l_orderkey) AS sra_study_accession, l_orderkey::VARCHAR AS dataset_id, 'ena' AS repository, '' AS url, 'complete' AS notes FROM (SELECT DISTINCT l_orderkey FROM lineitem)")
def seed_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = "CAST(l_orderkey AS STRING)"
    rows = table(spark, sf, "lineitem").select("l_orderkey").distinct().selectExpr("'ena' AS seed_source", f"{k} AS canonical_dataset_id", f"concat('About ', {k}) AS study_title", f"CASE WHEN l_orderkey % 2 = 0 THEN concat('10.1/', {k}) END AS primary_doi", f"concat('PRJNA', {k}) AS bioproject_accession", f"concat(CASE WHEN l_orderkey % 3 = 0 THEN 'ERP' ELSE 'PRJNA' END, {k}) AS ena_study_accession", f"concat('SRP', {k}) AS secondary_study_accession", "'complete' AS seed_status")
    return export.seed_rows(rows)


@query("u7_sql_functions", "SELECT p_partkey, trim(p_name) AS a, lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS b, CASE WHEN p_size % 2 = 0 THEN p_type END AS c, CASE p_size % 3 WHEN 0 THEN 30 WHEN 1 THEN 240 ELSE 3600 END AS d, p_size::VARCHAR AS e FROM part")
def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    register(spark)
    return table(spark, sf, "part").selectExpr("p_partkey", "tm_squeezed(concat('  ', replace(p_name, ' ', ' \\t'), ' ')) AS a", "tm_fact_key(p_brand) AS b", "tm_semicolon_part(concat('x;', CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END), 2) AS c", "tm_backoff_seconds(CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 4 ELSE 20 END) AS d", "tm_percent_value(concat(CAST(p_size AS STRING), ' %')) AS e")

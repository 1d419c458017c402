"""Queries over every repository's payloads, supplement files, seed files and long exports, made from whole tables."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.plans import export
from tidemark.shared import scratch
from tidemark.sources import archives, payloads, seeds, supplements


def _nested(paths: dict[str, str]) -> str:
    """A JSON text that holds @field@ at each field's path."""
    root: dict = {}
    for field, path in paths.items():
        steps: list = [int(x[1:-1]) if x.startswith("[") else x.lstrip(".") for x in re.findall(r"\.[^.\[]+|\[\d+\]", path[1:])]
        at = root
        for step, after in zip(steps, [*steps[1:], None], strict=True):
            new: object = f"@{field}@" if after is None else [] if isinstance(after, int) else {}
            if isinstance(at, list):
                if not at:
                    at.append(new)
                at = at[0]
            else:
                at = at.setdefault(step, new)
    return json.dumps(root)


def _bodies(spark: SparkSession, sf: str, source: str) -> DataFrame:
    """A payload for each part: every field is its name and the part's key, a third of them empty."""
    body: Column = F.lit(_nested(payloads.FIELDS[source]))
    for i, field in enumerate(payloads.FIELDS[source]):
        value = F.when((F.col("p_size") + i) % 3 == 0, "").otherwise(F.concat(F.lit(f"{field} "), F.col("p_partkey").cast("string")))
        body = F.replace(body, F.lit(f"@{field}@"), value)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("payload_id"), body.alias("body"))


def _facts_sql(source: str) -> str:
    fields = list(payloads.FIELDS[source])
    return f"SELECT payload_id, field, value FROM (SELECT p_partkey AS payload_id, unnest([{', '.join(repr(f) for f in fields)}]) AS field, unnest([{', '.join(f'CASE WHEN (p_size + {i}) % 3 <> 0 THEN concat({f!r}, chr(32), p_partkey) END' for i, f in enumerate(fields))}]) AS value FROM part) WHERE value IS NOT NULL"


def _register(name: str, source: str) -> None:
    query(name, _facts_sql(source))(lambda spark, sf: payloads.facts(_bodies(spark, sf, source), source))


for _number, _sources in ((4, ("crossref",)), (5, ("europe_pmc",)), (6, ("openalex",)), (10, ("obis", "gbif")), (11, ("datacite", "pangaea", "bcodmo")), (12, ("zenodo", "dryad", "figshare", "osf"))):
    for _source in _sources:
        _register(f"sc{_number}_{_source}_facts", _source)


@query("sc12_listings", "SELECT source, p_partkey AS payload_id, concat(p_name, '.', k, '.gz') AS name, CASE WHEN k = 1 THEN p_size::BIGINT END AS size_bytes FROM part, (VALUES ('zenodo'), ('dryad'), ('figshare'), ('osf')) s(source), (VALUES (1), (2)) x(k) WHERE p_size % 4 <> 0")
def listings(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for source, (files, name, size) in payloads.LISTINGS.items():
        entry = _nested({"name": name, "size": size})
        body = F.lit(_nested({"files": files}).replace('"@files@"', f"[{entry}, {entry.replace('name@', 'name2@').replace('size@', 'size2@')}]"))
        for token, value in (("name2", "concat(p_name, '.2.gz')"), ("size2", "'unknown'"), ("name", "concat(p_name, '.1.gz')"), ("size", "CAST(p_size AS STRING)")):
            body = F.replace(body, F.lit(f"@{token}@"), F.expr(value))
        rows = table(spark, sf, "part").select(F.col("p_partkey").alias("payload_id"), F.when(F.col("p_size") % 4 == 0, F.lit("{}")).otherwise(body).alias("body"))
        got = payloads.listing(rows, source).select(F.lit(source).alias("source"), "payload_id", "name", "size_bytes")
        out = got if out is None else out.unionByName(got)
    return out


@query("sc9_parent_studies", """
    WITH r AS (SELECT unnest([concat('ERR', l_orderkey, l_linenumber), concat('ERX', l_partkey), concat('SAM', l_suppkey)]) AS a, concat('PRJ', l_orderkey) AS s FROM lineitem WHERE l_quantity > 10)
    SELECT concat(' ', lower(a)) AS accession, min(s) AS study_accession, count(DISTINCT s) > 1 AS ambiguous FROM r WHERE a LIKE 'ERX%' OR a LIKE 'SAM%' GROUP BY a""")
def parent_studies(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    runs = li.where("l_quantity > 10").selectExpr("concat('ERR', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS run_accession", "concat('ERX', CAST(l_partkey AS STRING)) AS experiment_accession", "concat('SAM', CAST(l_suppkey AS STRING)) AS sample_accession", "'' AS submission_accession", "concat('PRJ', CAST(l_orderkey AS STRING)) AS study_accession")
    asked = li.selectExpr("concat(' erx', CAST(l_partkey AS STRING)) AS accession").union(li.selectExpr("concat(' sam', CAST(l_suppkey AS STRING))"))
    return archives.parent_studies(asked, runs)


@query("sc10_occurrences", """
    WITH r AS (SELECT o_custkey AS payload_id, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS record, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders), f AS (SELECT * FROM r WHERE record < 8)
    SELECT payload_id, record::INTEGER AS record, 'target_gene' AS field, concat('gene ', o_orderkey % 7) AS value FROM f UNION ALL SELECT payload_id, record::INTEGER, 'DNA_sequence', concat('ACGT', o_orderkey) FROM f UNION ALL SELECT DISTINCT payload_id, NULL::INTEGER, 'occurrence_coverage_note', concat('Only the first 8 of ', n, ' were processed') FROM r WHERE n > 8""")
def occurrences(spark: SparkSession, sf: str) -> DataFrame:
    one = "concat('{\"id\": ', CAST(o_orderkey AS STRING), ', \"target_gene\": \"gene ', CAST(o_orderkey % 7 AS STRING), '\", \"depth\": 5, \"extensions\": {\"dna\": [{\"DNA_sequence\": \"ACGT', CAST(o_orderkey AS STRING), '\", \"target_gene\": \"\"}]}}')"
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("payload_id")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.expr(one).alias("r")))).alias("rs"))
    bodies = rows.select("payload_id", F.concat(F.lit('{"results": ['), F.array_join(F.transform("rs", lambda r: r["r"]), ", "), F.lit("]}")).alias("body"))
    got, note = archives.occurrences(bodies, ("dna_sequence", "target_gene"), most=8)
    return got.unionByName(note.select("payload_id", F.lit(None).cast("int").alias("record"), "field", "value"))


@query("sc11_citing_datasets", "SELECT o_custkey AS payload_id, concat('10.5/d', o_orderkey) AS doi, unnest(['IsSupplementTo', 'Cites']) AS relation, unnest([concat('10.1/a', o_custkey), 'x']) AS cited FROM orders")
def citing(spark: SparkSession, sf: str) -> DataFrame:
    one = "concat('{\"attributes\": {\"doi\": \"10.5/D', CAST(o_orderkey AS STRING), '\", \"relatedIdentifiers\": [{\"relationType\": \"IsSupplementTo\", \"relatedIdentifier\": \"10.1/A', CAST(o_custkey AS STRING), '\"}, {\"relationType\": \"Cites\", \"relatedIdentifier\": \"X\"}]}}')"
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("payload_id")).agg(F.concat(F.lit('{"data": ['), F.array_join(F.collect_list(F.expr(one)), ", "), F.lit("]}")).alias("body"))
    return archives.citing_datasets(rows)


@query("sc5_supplement_references", "SELECT p_partkey AS payload_id, concat('s', p_size, '.xlsx') AS href FROM part UNION ALL SELECT p_partkey, concat(p_partkey, '.zip') FROM part WHERE p_size % 2 = 0")
def references(spark: SparkSession, sf: str) -> DataFrame:
    body = "concat('<article><media xlink:href=\"no.png\"/><supplementary-material id=\"s1\"><media xlink:href=\"s', CAST(p_size AS STRING), '.xlsx\"/></supplementary-material><p>t</p>', CASE WHEN p_size % 2 = 0 THEN concat('<supplementary-material xlink:href=''', CAST(p_partkey AS STRING), '.zip''><label/></supplementary-material>') ELSE '' END, '</article>')"
    return archives.supplement_references(table(spark, sf, "part").selectExpr("p_partkey AS payload_id", f"{body} AS body"))


def _files(spark: SparkSession, sf: str, name: str, text: str) -> DataFrame:
    return table(spark, sf, "part").select(F.expr(name).alias("path"), F.encode(F.expr(text), "UTF-8").alias("content"))


@query("sc14_delimited", "SELECT concat(p_partkey, CASE WHEN p_size % 2 = 0 THEN '.csv' ELSE '.tsv' END) AS path, unnest(['samp_name', 'depth', 'odd one']) AS field, unnest(['A3', 'B3', 'C3']) AS locator, unnest([concat('S', p_partkey), p_size::VARCHAR, p_name]) AS value FROM part")
def delimited(spark: SparkSession, sf: str) -> DataFrame:
    sep = "CASE WHEN p_size % 2 = 0 THEN ',' ELSE '\\t' END"
    text = f"concat('Table S1\\n', concat_ws({sep}, 'Sample_ID', 'Depth (m)', 'Odd  one'), '\\n', concat_ws({sep}, concat('S', CAST(p_partkey AS STRING)), CAST(p_size AS STRING), p_name), '\\n', concat_ws({sep}, '', ' ', ''), '\\n')"
    return supplements.cells(_files(spark, sf, "concat(CAST(p_partkey AS STRING), CASE WHEN p_size % 2 = 0 THEN '.csv' ELSE '.tsv' END)", text)).select("path", "field", "locator", "value")


@query("sc16_json_and_xml", "SELECT concat(p_partkey, '.json') AS path, 'temp' AS field, '$.s[1].temp' AS locator, p_size::VARCHAR AS value FROM part WHERE p_size % 2 = 0 UNION ALL SELECT concat(p_partkey, '.xml'), 'temp', '/r/s/temp', p_size::VARCHAR FROM part WHERE p_size % 2 = 1 AND p_size % 5 <> 0 UNION ALL SELECT concat(p_partkey, '.xml'), 'unreadable', '', 'ParseError' FROM part WHERE p_size % 2 = 1 AND p_size % 5 = 0")
def json_and_xml(spark: SparkSession, sf: str) -> DataFrame:
    text = "CASE WHEN p_size % 2 = 0 THEN concat('{\"s\": [{\"temp\": null}, {\"temp\": ', CAST(p_size AS STRING), '}]}') ELSE concat('<r xmlns=\"u\"><s><temp> ', CAST(p_size AS STRING), ' </temp></s>', CASE WHEN p_size % 5 = 0 THEN '' ELSE '</r>' END) END"
    return supplements.cells(_files(spark, sf, "concat(CAST(p_partkey AS STRING), CASE WHEN p_size % 2 = 0 THEN '.json' ELSE '.xml' END)", text)).select("path", "field", "locator", "value")


@query("x27_leaves", "SELECT p_partkey, unnest(['name', 'size', 'x']) AS key, unnest(['$.name', '$.a[0].size', '$.a[1][0].x']) AS path, unnest([p_name, p_size::VARCHAR, 'True']) AS value FROM part")
def leaves(spark: SparkSession, sf: str) -> DataFrame:
    body = "concat('{\"name\": \"', p_name, '\", \"none\": null, \"a\": [{\"size\": ', CAST(p_size AS STRING), '}, [{\"x\": true}], \"\"]}')"
    rows = table(spark, sf, "part").select("p_partkey", F.explode(payloads.leaves(F.expr(body))).alias("l"))
    return rows.select("p_partkey", "l.*")


@query("sc1_seed_rows", "SELECT c_custkey::VARCHAR AS seed_id, nullif(trim(c_name), '') AS title, CASE WHEN c_custkey % 2 = 0 THEN concat('10.1/', c_custkey) END AS doi, c_mktsegment AS notes FROM customer")
def seed_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "seeds") + "/seeds.csv"
    c = table(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS seed_id", "concat(' ', c_name, ' ') AS title", "CASE WHEN c_custkey % 2 = 0 THEN concat('10.1/', CAST(c_custkey AS STRING)) ELSE ' ' END AS doi", "c_mktsegment AS notes")
    export.fixed(c, export.SEED_COLUMNS).write.csv(path, header=True)
    return seeds.seed_rows(spark, path).select("seed_id", "title", "doi", "notes")


@query("sc23_excluded_dois", "SELECT DISTINCT concat('10.1/x', c_nationkey) AS doi FROM customer")
def excluded(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "excluded")
    table(spark, sf, "customer").selectExpr("concat(' 10.1/X', CAST(c_nationkey AS STRING)) AS doi", "c_name AS reason", "'2024-01-01' AS date_added").write.csv(path, header=True)
    more = spark.createDataFrame([("10.1/X3", "again", "2024-02-02")], "doi string, reason string, date_added string")
    seeds.exclude(more, path)
    return seeds.excluded_dois(spark, path)


@query("sc22_gold_cases", "SELECT c_custkey::VARCHAR AS case_id, c_mktsegment AS source_text, ['segment', 'balance'][f] AS fact, CASE f WHEN 1 THEN c_mktsegment ELSE c_nationkey::VARCHAR END AS value FROM customer, (VALUES (1), (2)) x(f)")
def gold(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "gold")
    fact = lambda kind, value: F.struct(F.lit(kind).alias("fact_type_candidate"), value.alias("raw_value"), F.lit("q").alias("evidence_quote"))
    c = table(spark, sf, "customer")
    c.select(F.col("c_custkey").cast("string").alias("case_id"), F.col("c_mktsegment").alias("source_text"), F.array(fact("segment", F.col("c_mktsegment")), fact("balance", F.col("c_nationkey").cast("string"))).alias("expected_facts")).write.json(path)
    lines = spark.read.schema(seeds.GOLD).json(path)
    return lines.select("case_id", "source_text", F.explode("expected_facts").alias("f")).select("case_id", "source_text", F.col("f.fact_type_candidate").alias("fact"), F.col("f.raw_value").alias("value"))


@query("sk1_raw_facts", "SELECT o_orderkey::VARCHAR AS fact_id, o_custkey::VARCHAR AS study_id, o_orderstatus AS raw_value, 18 AS columns FROM orders")
def raw_facts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "raw-facts")
    export.raw_facts(table(spark, sf, "orders").selectExpr("o_orderkey AS fact_id", "o_custkey AS study_id", "o_orderstatus AS raw_value", "o_orderdate AS created_at"), path)
    got = spark.read.csv(path, header=True)
    return got.select("fact_id", "study_id", "raw_value", F.lit(len(got.columns)).alias("columns"))


@query("sk3_fixed_columns", "SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END AS status, '' AS missing FROM orders")
def fixed(spark: SparkSession, sf: str) -> DataFrame:
    return export.fixed(table(spark, sf, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status", "o_custkey"), ["o_orderkey", "status", "missing"])

"""Queries over value functions, predicates and validators; raw strings are made alike in both engines from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.functions import identifiers as I
from tidemark.functions import values as V
from tidemark.operators import checks, predicates as P

RAW_ID = "CASE o_orderkey % 9 WHEN 0 THEN concat('https://doi.org/10.1234/AB', CAST(o_orderkey AS STRING)) WHEN 1 THEN concat(' prjna', CAST(o_orderkey AS STRING)) WHEN 2 THEN concat('SAMEA', CAST(o_orderkey AS STRING)) WHEN 3 THEN concat('PMC', CAST(o_orderkey AS STRING)) WHEN 4 THEN CAST(o_orderkey AS STRING) WHEN 5 THEN concat('http://example.org/', CAST(o_orderkey AS STRING)) WHEN 6 THEN concat('err', CAST(o_orderkey AS STRING)) WHEN 7 THEN concat('PRJCA', CAST(o_orderkey AS STRING)) ELSE concat('cruise ', CAST(o_orderkey AS STRING)) END"


@query("x1_normalise_identifier", f"""
    WITH r AS (SELECT o_orderkey, trim({RAW_ID}) AS v, CASE o_orderkey % 9 WHEN 0 THEN 'doi' WHEN 1 THEN 'bioproject_accession' WHEN 2 THEN 'biosample_accession' WHEN 3 THEN 'pmcid' WHEN 4 THEN 'pmid' WHEN 6 THEN 'sra_study_accession' ELSE 'url' END AS kind FROM orders)
    SELECT o_orderkey, CASE kind WHEN 'doi' THEN replace(lower(v), 'https://doi.org/', '') WHEN 'bioproject_accession' THEN upper(v) WHEN 'biosample_accession' THEN CASE WHEN regexp_full_match(upper(v), 'SAM(N|E|D)[A-Z]?[0-9]+') THEN upper(v) END WHEN 'sra_study_accession' THEN NULL ELSE v END AS value FROM r""")
def normalise_identifier(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.expr("CASE o_orderkey % 9 WHEN 0 THEN 'doi' WHEN 1 THEN 'bioproject_accession' WHEN 2 THEN 'biosample_accession' WHEN 3 THEN 'pmcid' WHEN 4 THEN 'pmid' WHEN 6 THEN 'sra_study_accession' ELSE 'url' END")
    return table(spark, sf, "orders").select("o_orderkey", I.normalise(kind, F.expr(RAW_ID)).alias("value"))


@query("x2_guess_identifier_type", """
    SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'doi' WHEN 1 THEN 'bioproject_accession' WHEN 2 THEN 'biosample_accession' WHEN 3 THEN 'pmcid' WHEN 4 THEN 'pmid' WHEN 5 THEN 'url' WHEN 6 THEN 'sra_run_accession' WHEN 7 THEN 'cncb_project_accession' END AS kind FROM orders""")
def guess_type(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", I.guess(F.expr(RAW_ID)).alias("kind"))


CITED = "concat('Reads are in ', CASE WHEN o_orderkey % 3 = 0 THEN 'SRR00' ELSE 'ERR1' END, CAST(o_orderkey % 900 + 100 AS STRING), ' and PRJEB', CAST(o_orderkey % 50 AS STRING), '; see also err1', CAST(o_orderkey % 900 + 100 AS STRING), '.')"


@query("x3_accessions_in_text", f"""
    WITH t AS (SELECT o_orderkey, {CITED} AS t FROM orders),
    m AS (SELECT o_orderkey, upper(unnest(regexp_extract_all(t, '(?i)\\b(?:SRR|ERR|DRR)[0-9]+\\b'))) AS accession, 'sra_run_accession' AS identifier_type FROM t
          UNION ALL SELECT o_orderkey, upper(unnest(regexp_extract_all(t, '(?i)\\bPRJ(?:NA|EB|DB)[0-9]+\\b'))), 'bioproject_accession' FROM t)
    SELECT DISTINCT o_orderkey, accession, identifier_type, CASE WHEN accession LIKE 'SRR%' THEN 'NCBI' ELSE 'ENA' END AS archive FROM m""")
def accessions_in_text(spark: SparkSession, sf: str) -> DataFrame:
    return I.accessions(table(spark, sf, "orders").select("o_orderkey", F.expr(CITED).alias("t")), "o_orderkey", "t")


COORD = "concat(CAST(c_custkey % 95 AS STRING), '.25 ', CASE WHEN c_custkey % 2 = 0 THEN 'N' ELSE 'S' END, ' ', CAST(c_custkey % 190 AS STRING), '.5 ', CASE WHEN c_custkey % 3 = 0 THEN 'E' ELSE 'w' END)"


@query("t2_latitude_longitude", """
    SELECT c_custkey, printf('%.6f', (c_custkey % 95 + 0.25) * CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END) AS lat, printf('%.6f', (c_custkey % 190 + 0.5) * CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE -1 END) AS lon FROM customer""")
def lat_lon(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", V.latitude(F.expr(COORD)).alias("lat"), V.longitude(F.expr(COORD)).alias("lon"))


@query("t3_single_coordinate", "SELECT c_custkey, printf('%.6f', -(c_custkey % 90)::DOUBLE) AS lat, NULL::VARCHAR AS bad FROM customer WHERE c_custkey % 90 <> 0 UNION ALL SELECT c_custkey, '-0.000000', NULL FROM customer WHERE c_custkey % 90 = 0")
def single(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", V.single_coordinate(F.expr("concat(CAST(c_custkey % 90 AS STRING), ' S')"), "S").alias("lat"), V.single_coordinate(F.expr("concat('at ', c_name)"), "S").alias("bad"))


DEPTH = "concat(CAST(p_size AS STRING), CASE p_partkey % 4 WHEN 0 THEN ' m' WHEN 1 THEN ' km' WHEN 2 THEN '' ELSE ' cm' END)"


@query("t4_depth_metres", """
    SELECT p_partkey, printf('%g', p_size * CASE p_partkey % 4 WHEN 1 THEN 1000.0 WHEN 3 THEN 0.01 ELSE 1.0 END) AS metres FROM part""")
def depth(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", V.metres(F.expr(DEPTH)).alias("metres"))


@query("t5_depth_range", "SELECT p_partkey, printf('%g', least(p_size, p_partkey % 40)::DOUBLE) AS lo, printf('%g', greatest(p_size, p_partkey % 40)::DOUBLE) AS hi FROM part")
def depth_range(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("concat(CAST(p_size AS STRING), CASE WHEN p_partkey % 2 = 0 THEN '-' ELSE ' to ' END, CAST(p_partkey % 40 AS STRING), ' m')")
    return table(spark, sf, "part").select("p_partkey", V.min_metres(raw).alias("lo"), V.max_metres(raw).alias("hi"))


@query("t6_event_date", """
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y') END AS event_date FROM orders""")
def event_date(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    raw = F.expr("o_orderkey % 4")
    value = F.when(raw == 0, F.date_format(d, "d MMMM yyyy")).when(raw == 1, F.date_format(d, "MMMM yyyy")).when(raw == 2, F.date_format(d, "yyyy")).otherwise(F.lit("in spring"))
    return table(spark, sf, "orders").select("o_orderkey", V.event_date(value).alias("event_date"))


@query("t7_not_pointer", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS value FROM orders")
def not_pointer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", V.not_pointer(F.expr("CASE WHEN o_orderkey % 3 = 0 THEN ' See  ABOVE. ' ELSE concat(o_orderpriority, ' ') END")).alias("value"))


@query("t8_licence_url", """
    SELECT p_partkey, concat('https://creativecommons.org/licenses/by/', p_size) AS url, 'open access' AS access FROM part""")
def licence(spark: SparkSession, sf: str) -> DataFrame:
    url = "concat('https://creativecommons.org/licenses/by/', CAST(p_size AS STRING))"
    raw = F.expr(f"CASE p_partkey % 3 WHEN 0 THEN {url} WHEN 1 THEN concat('{{\"URL\": \"', {url}, '\"}}') ELSE concat('[{{\"x\": 1}}, {{\"url\": \"', {url}, '\"}}]') END")
    return table(spark, sf, "part").select("p_partkey", V.licence_url(raw).alias("url"), V.open_access(raw).alias("access"))


FILES = "CASE WHEN l_linenumber % 2 = 0 THEN concat('ftp/a/', CAST(l_orderkey AS STRING), '_1.fastq.gz;ftp/a/', CAST(l_orderkey AS STRING), '_2.fastq.gz') ELSE concat(';ftp/b/', CAST(l_orderkey AS STRING), '.fastq.gz') END"


@query("t9_semicolon_parts", "SELECT l_orderkey, l_linenumber, concat(l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN '_1.fastq.gz' ELSE '.fastq.gz' END) AS forward, CASE WHEN l_linenumber % 2 = 0 THEN concat(l_orderkey, '_2.fastq.gz') END AS reverse FROM lineitem")
def semicolon(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", V.file_name(F.expr(FILES), 1).alias("forward"), V.file_name(F.expr(FILES), 2).alias("reverse"))


@query("t10_percent_volume", "SELECT p_partkey, p_size::VARCHAR AS percent, CASE WHEN p_partkey % 2 = 0 THEN concat(p_size, ' mL') END AS volume, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS tool FROM part")
def percent_volume(spark: SparkSession, sf: str) -> DataFrame:
    e = F.expr
    return table(spark, sf, "part").select("p_partkey", V.percent(e("concat(' ', CAST(p_size AS STRING), ' % ')")).alias("percent"), V.volume(e("CASE WHEN p_partkey % 2 = 0 THEN concat(CAST(p_size AS STRING), ' mL') ELSE p_name END")).alias("volume"), V.error_tool(e("CASE WHEN p_partkey % 5 = 0 THEN 'FastQC v1' ELSE p_type END")).alias("tool"))


@query("t11_control_flags", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '0' WHEN 3 THEN '1' END AS negative, CASE o_orderkey % 5 WHEN 3 THEN 'negative control' END AS category FROM orders")
def control_flags(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'Controls were not used' WHEN 3 THEN 'No-template control and field blanks' ELSE 'ultrapure' END")
    return table(spark, sf, "orders").select("o_orderkey", V.control_flag(raw, V.NEGATIVE_CONTROLS).alias("negative"), V.control_category(raw).alias("category"))


@query("t14_assay_name", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '16S-V4' WHEN 1 THEN NULL ELSE concat('x', p_size) END AS assay, CASE WHEN p_partkey % 2 = 0 THEN '18S-V9' ELSE 'COI' END AS composed FROM part")
def assay_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("CASE p_partkey % 3 WHEN 0 THEN '16S rRNA – V4 | 16s-v4 | F/R' WHEN 1 THEN 'amoA | a/b' ELSE concat('x', CAST(p_size AS STRING), '|X', CAST(p_size AS STRING)) END")
    return table(spark, sf, "part").select("p_partkey", V.assay_name(raw).alias("assay"), V.composed_assay(F.expr("CASE WHEN p_partkey % 2 = 0 THEN '18S rRNA gene' ELSE 'COI marker' END"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN 'V9' END")).alias("composed"))


@query("f1_marine", "SELECT doc_id, contains(lower(text), 'the') AND NOT contains(lower(text), 'license') AS marine FROM documents")
def marine(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", P.marine([F.col("text")], ("The",), ("License",)).alias("marine"))


@query("f2_experiment_status", "SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'experiment_type_accepted' ELSE 'experiment_type_unresolved' END AS status FROM orders")
def experiment(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", P.experiment_status(F.col("o_orderpriority"), ("urgent",)).alias("status"))


@query("f3_accessibility", """
    SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN CASE WHEN l_orderkey > 0 THEN 'fastq_confirmed' ELSE 'sequence_locator_present_unverified' END WHEN 1 THEN 'sequence_locator_present_unverified' WHEN 2 THEN 'submitted_reads_confirmed' WHEN 3 THEN 'sra_archive_confirmed' ELSE 'no_downloadable_reads' END AS status FROM lineitem""")
def accessibility(spark: SparkSession, sf: str) -> DataFrame:
    e = F.expr
    k = "l_linenumber % 5"
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", P.accessibility(e(f"CASE WHEN {k} IN (0, 1) THEN 'f' END"), e(f"CASE {k} WHEN 0 THEN concat('0;', CAST(l_orderkey AS STRING)) ELSE '0' END"), e(f"CASE WHEN {k} = 2 THEN 's' END"), e("CAST(NULL AS STRING)"), e(f"CASE WHEN {k} = 2 THEN 'BAM' ELSE '' END"), e(f"CASE WHEN {k} = 3 THEN 'a' END"), e("'7'")).alias("status"))


@query("f4_file_listing", """
    WITH f AS (SELECT l_orderkey, CASE WHEN l_shipmode = 0 THEN 2 WHEN l_shipmode = 1 AND l_quantity >= 25 THEN 1 ELSE 0 END AS level FROM (SELECT *, l_partkey % 4 AS l_shipmode FROM lineitem))
    SELECT l_orderkey, CASE max(level) WHEN 2 THEN 'confirmed' WHEN 1 THEN 'likely' ELSE 'absent' END AS status FROM f GROUP BY 1""")
def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "lineitem").select("l_orderkey", F.expr("CASE l_partkey % 4 WHEN 0 THEN 'x.FASTQ.gz' WHEN 1 THEN 'data.zip' WHEN 2 THEN 'readme.txt' ELSE 'fig.png' END").alias("name"), (F.col("l_quantity") * 40000).cast("long").alias("size"))
    return P.classify_listings(files, "l_orderkey", "name", "size")


@query("f7_absent_value", "SELECT o_orderkey, o_orderkey % 4 <> 3 AS absent FROM orders")
def absent(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", P.absent(F.expr("CASE o_orderkey % 4 WHEN 0 THEN ' N/A. ' WHEN 1 THEN 'Not explicitly stated in the text' WHEN 2 THEN NULL ELSE o_orderpriority END")).alias("absent"))


@query("f8_evidence_quote", """
    SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b
    ON contains(trim(regexp_replace(d.text, '\\s+', ' ', 'g')), trim(regexp_replace(b.text, '\\s+', ' ', 'g'))) AND trim(b.text) <> ''""")
def evidence_quote(spark: SparkSession, sf: str) -> DataFrame:
    # a text that holds a quote holds its second to sixth word, so the two meet by an equal key
    words = lambda c: F.split(V.squeezed(c), " ")
    five = lambda w, i: F.array_join(F.slice(w, i, 5), " ")
    quotes = table(spark, sf, "benchmark").select("item_id", V.squeezed(F.col("text")).alias("q")).where("q <> ''").withColumn("w", F.split("q", " ")).withColumn("k", F.when(F.size("w") >= 7, five(F.col("w"), 2)))
    docs = table(spark, sf, "documents").select("doc_id", V.squeezed(F.col("text")).alias("t"))
    keys = docs.select("doc_id", F.split("t", " ").alias("w")).where("size(w) >= 5").select("doc_id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - 4), lambda i: five(F.col("w"), i)))).alias("k"))
    pairs = keys.join(quotes.where("k IS NOT NULL").select("item_id", "k"), "k").select("doc_id", "item_id").distinct()
    found = pairs.join(docs, "doc_id").join(quotes.select("item_id", "q"), "item_id").where(P.quoted(F.col("q"), F.col("t"))).select("doc_id", "item_id")
    # quotes of under seven words have no such key: that small query set is held against all texts
    short = docs.join(quotes.where("k IS NULL").select("item_id", "q"), F.contains("t", F.col("q"))).select("doc_id", "item_id")
    return found.unionByName(short)


@query("f9_evidence_check", "SELECT event_id, CASE event_type WHEN 'view' THEN event_id % 2 = 0 WHEN 'click' THEN event_id % 3 = 0 ELSE true END AS ok FROM events")
def evidence_check(spark: SparkSession, sf: str) -> DataFrame:
    support = F.expr("CASE event_type WHEN 'view' THEN 'explicit' WHEN 'click' THEN 'structured_source' ELSE 'inferred' END")
    return table(spark, sf, "events").select("event_id", P.evidence_ok(support, F.expr("CASE WHEN event_id % 2 = 0 THEN 'q' ELSE ' ' END"), F.expr("CASE WHEN event_id % 3 = 0 THEN 'l' END")).alias("ok"))


@query("f10_vocabulary", """
    WITH v AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'closed' WHEN 1 THEN 'open' ELSE 'unknown' END AS enum_name, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE concat('x:', p_size) END AS value FROM part)
    SELECT p_partkey, CASE enum_name WHEN 'closed' THEN value IN ('Brand#11', 'Brand#12', 'Brand#13') WHEN 'open' THEN value = 'Brand#21' OR contains(value, ':') ELSE true END AS valid FROM v""")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    terms = spark.createDataFrame([("closed", "Brand#11"), ("closed", "Brand#12"), ("closed", "Brand#13"), ("open", "Brand#21")], "enum_name string, permissible_value string")
    vals = table(spark, sf, "part").selectExpr("p_partkey", "CASE p_partkey % 3 WHEN 0 THEN 'closed' WHEN 1 THEN 'open' ELSE 'unknown' END AS enum_name", "CASE WHEN p_size % 2 = 0 THEN p_brand ELSE concat('x:', CAST(p_size AS STRING)) END AS value")
    return P.in_vocabulary(vals, terms, "enum_name", "value").select("p_partkey", "valid")


@query("f16_flag_gating", "SELECT o_orderkey, o_orderstatus = 'F' OR o_orderkey % 2 = 0 AS visible FROM orders")
def flag_gating(spark: SparkSession, sf: str) -> DataFrame:
    required = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<string>")).otherwise(F.array(F.lit("a"), F.lit("b")))
    return table(spark, sf, "orders").select("o_orderkey", P.visible(required, F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("b"))).otherwise(F.array(F.lit("c")))).alias("visible"))


@query("v1_coordinates", "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'not_assessed' WHEN c_custkey % 95 + 0.25 > 90 OR c_custkey % 190 + 0.5 > 180 THEN 'unsupported' ELSE 'confirmed' END AS status FROM customer")
def v1(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr(f"CASE WHEN c_custkey % 7 = 0 THEN c_name ELSE {COORD} END")
    return table(spark, sf, "customer").select("c_custkey", checks.coordinates(raw)["status"].alias("status"))


@query("v2_depth", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'not_assessed' WHEN p_size * 1000 > 11000 THEN 'unsupported' ELSE 'confirmed' END AS status FROM part")
def v2(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", checks.depth(F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'surface' ELSE concat(CAST(p_size AS STRING), ' km') END"))["status"].alias("status"))


@query("v3_collection_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'not_assessed' WHEN year(o_orderdate) > 1995 THEN 'unsupported' ELSE 'confirmed' END AS status FROM orders")
def v3(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 6 == 0, "spring").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", checks.collected_before(raw, F.lit(1995))["status"].alias("status"))


@query("v4_primer", "SELECT p_partkey, CASE WHEN p_size >= 6 AND p_partkey % 2 = 0 THEN 'confirmed' ELSE 'not_assessed' END AS status FROM part")
def v4(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", checks.primer(F.expr("concat(' ', repeat(CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE 'z' END, p_size))"))["status"].alias("status"))


@query("v5_accession_format", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (2, 6) THEN 'confirmed' ELSE 'unsupported' END AS status FROM orders")
def v5(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.expr("CASE WHEN o_orderkey % 9 = 6 THEN 'sra_run_accession' ELSE 'biosample_accession' END")
    return table(spark, sf, "orders").select("o_orderkey", checks.accession(kind, F.expr(RAW_ID))["status"].alias("status"))


@query("v6_dispatch", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'confirmed' WHEN 2 THEN CASE WHEN p_size > 6 THEN 'unsupported' ELSE 'confirmed' END END AS status FROM part")
def v6(spark: SparkSession, sf: str) -> DataFrame:
    e = F.expr
    return table(spark, sf, "part").select("p_partkey", checks.by_field(e("CASE p_partkey % 4 WHEN 0 THEN 'lat_lon' WHEN 1 THEN 'depth' WHEN 2 THEN 'collection_date' ELSE 'title' END"), e("CASE p_partkey % 4 WHEN 0 THEN '1.5, 2.5' WHEN 1 THEN '5 m' WHEN 2 THEN concat('200', CAST(p_size % 10 AS STRING)) ELSE p_name END"), e("CASE WHEN p_size > 6 THEN 1999 ELSE 2010 END"))["status"].alias("status"))


@query("x17_attribute_key", "SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS key, array_to_string(list_filter(string_split(lower(p_type), ' '), lambda x: x <> ''), '+') AS tokens FROM part")
def attribute_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", V.fact_key(F.col("p_name")).alias("key"), F.array_join(V.tokens(F.col("p_type")), "+").alias("tokens"))


@query("x19_title_key", "SELECT p_partkey, trim(regexp_replace(lower(concat('The ', p_name, ', (', p_brand, ')!')), '[^a-z0-9_]+', ' ', 'g')) AS key FROM part")
def title_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", V.title_key(F.expr("concat('The ', p_name, ', (', p_brand, ')!')")).alias("key"))


@query("x20_payload_hash", "SELECT o_orderkey, sha256(concat(o_orderkey, '|', o_orderpriority)) AS digest FROM orders")
def payload_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority"), 256).alias("digest"))


@query("x22_backoff", "SELECT event_id, least(30 * pow(2, greatest(event_id % 12, 1) - 1), 3600)::BIGINT AS seconds FROM events")
def backoff(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", V.backoff_seconds(F.col("event_id") % 12).alias("seconds"))


@query("x24_cell_reference", "SELECT p_partkey, CASE WHEN p_partkey % 702 < 26 THEN chr((65 + p_partkey % 702)::INT) ELSE concat(chr((64 + (p_partkey % 702) // 26)::INT), chr((65 + (p_partkey % 702) % 26)::INT)) END AS letters FROM part")
def cells(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", V.column_letters(F.col("p_partkey") % 702 + 1).alias("letters"))

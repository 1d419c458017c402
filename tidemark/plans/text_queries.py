"""Queries over text operators; documents and pages stand for papers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.operators import texts as X

LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents"


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("pos", F.col("pos") + 1)


@query("x13_paragraphs", f"WITH l AS ({LINES}) SELECT doc_id, trim(line) AS paragraph, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos FROM l WHERE trim(line) <> '' AND NOT regexp_matches(trim(line), '(?i)^(figure|fig\\.|table)\\s*[0-9]+')")
def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return X.posexploded(table(spark, sf, "documents"), "doc_id", X.paragraphs(F.col("text")), "paragraph")


@query("x6_sentences", "WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10))) AS s FROM documents) SELECT doc_id, count(*) AS n, sum(length(trim(s)))::BIGINT AS chars FROM s WHERE trim(s) <> '' GROUP BY 1")
def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return X.posexploded(table(spark, sf, "documents"), "doc_id", X.sentences(F.col("text")), "s").groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("s")).alias("chars"))


TERMS = ["MIT License", "CC BY-NC", "Apache License", "License"]


@query("x8_controlled_terms", """
    WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?i)\\b(?:Apache\\s+License|MIT\\s+License|CC\\s+BY[-\\s]+NC|License)\\b') AS h FROM documents),
    e AS (SELECT doc_id, unnest(h) AS t, generate_subscripts(h, 1) AS i FROM m), f AS (SELECT doc_id, lower(t) AS k, min(i) AS i, first(t ORDER BY i) AS t FROM e GROUP BY 1, 2)
    SELECT d.doc_id, coalesce(string_agg(f.t, ' | ' ORDER BY f.i), '') AS terms FROM documents d LEFT JOIN f USING (doc_id) GROUP BY 1""")
def terms(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.terms_found(F.col("text"), TERMS).alias("terms"))


@query("x9_flags", """
    WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10))) AS s FROM documents),
    f AS (SELECT doc_id, max(CASE WHEN regexp_matches(s, '(?i)license') AND NOT regexp_matches(s, '(?i)under') THEN 1 END) AS y, max(CASE WHEN regexp_matches(s, '(?i)license') AND regexp_matches(s, '(?i)under') THEN 1 END) AS n FROM s GROUP BY 1)
    SELECT doc_id, CASE WHEN y = 1 THEN '1' WHEN n = 1 THEN '0' END AS flag FROM f""")
def flags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", X.flag(X.sentences(F.col("text")), "(?i)license", "(?i)under").alias("flag"))


@query("x11_first_value", """
    WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) AS a FROM documents), e AS (SELECT doc_id, unnest(a) AS s, generate_subscripts(a, 1) AS i FROM s)
    SELECT doc_id, first(regexp_extract(s, '(?i)version\\s*([0-9.]*[0-9])', 1) ORDER BY i) AS version FROM e WHERE regexp_matches(s, '(?i)licensed') AND regexp_matches(s, '(?i)version\\s*([0-9.]*[0-9])') GROUP BY 1""")
def first_value(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.first_sentence_value(X.sentences(F.col("text")), "(?i)licensed", r"(?i)version\s*([0-9.]*[0-9])").alias("version")).where("version IS NOT NULL")


@query("w2_context", "SELECT conv_id, turn, concat_ws(' ', lag(role) OVER w, role, lead(role) OVER w) AS context FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def context(spark: SparkSession, sf: str) -> DataFrame:
    return X.context(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", "role").select("conv_id", "turn", "context")


TAG = "CASE WHEN regexp_matches(line, '(?i)license') THEN 'licence' WHEN line LIKE '%|%' THEN 'table' END"


@query("w3_category_runs", f"""
    WITH t AS (SELECT doc_id, pos, {TAG} AS tag FROM ({LINES})), k AS (SELECT *, lag(tag) OVER w AS p, lag(pos) OVER w AS q FROM t WHERE tag IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    r AS (SELECT *, sum(CASE WHEN p IS NULL OR p <> tag OR pos - q > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM k)
    SELECT doc_id, min(pos) AS first, max(pos) AS last, first(tag) AS tag, count(*) AS n FROM r GROUP BY doc_id, run""")
def category_runs(spark: SparkSession, sf: str) -> DataFrame:
    tag = F.when(F.col("line").rlike("(?i)license"), "licence").when(F.contains("line", F.lit("|")), "table")
    return X.runs(lines(spark, sf).withColumn("tag", tag), "doc_id", "pos", "tag")


@query("w5_before_references", f"""
    WITH l AS ({LINES}), t AS (SELECT doc_id, pos, CASE WHEN pos = 4 THEN ' References. ' ELSE line END AS line FROM l)
    SELECT doc_id, pos FROM t WHERE pos < 4""")
def before_references(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf).withColumn("line", F.when(F.col("pos") == 4, " References. ").otherwise(F.col("line")))
    return X.before_references(rows, "doc_id", "pos", "line").select("doc_id", "pos")


@query("w4_methods_prefix", f"WITH l AS ({LINES}) SELECT doc_id, pos FROM l WHERE pos >= 2 AND pos < 5")
def methods_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return X.until_other_heading(lines(spark, sf), "doc_id", "pos", F.col("pos") == 2, F.col("pos").isin(2, 5)).select("doc_id", "pos")


#: Paragraphs of the documents as lists in SQL.
PARAGRAPHS = r"p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n[ \t]*\n|\n'), lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(figure|fig\.|table)\s*\d+')) AS ps FROM documents)"


@query("w6_chunks", f"""
    WITH RECURSIVE {PARAGRAPHS}, r AS (
        SELECT doc_id, 0::BIGINT AS i, '' AS now, NULL::VARCHAR AS closed FROM p
        UNION ALL SELECT r.doc_id, i + 1, CASE WHEN now = '' THEN ps[i + 1] WHEN length(now) + 2 + length(ps[i + 1]) <= 2000 THEN now || chr(10) || chr(10) || ps[i + 1] ELSE ps[i + 1] END, CASE WHEN now <> '' AND length(now) + 2 + length(ps[i + 1]) > 2000 THEN now END FROM r JOIN p USING (doc_id) WHERE i < len(ps)),
    c AS (SELECT doc_id, i, closed AS chunk FROM r WHERE closed IS NOT NULL UNION ALL SELECT doc_id, i + 1, now FROM r JOIN p USING (doc_id) WHERE i = len(ps) AND now <> '')
    SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS pos, length(chunk)::INTEGER AS n_chars, sha256(chunk) AS digest FROM c""")
def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return X.posexploded(table(spark, sf, "documents"), "doc_id", X.chunked(X.paragraphs(F.col("text")), 2000), "chunk").select("doc_id", "pos", F.length("chunk").alias("n_chars"), F.sha2("chunk", 256).alias("digest"))


@query("sc21_section_budget", f"""
    WITH RECURSIVE {PARAGRAPHS}, r AS (
        SELECT doc_id, 0::BIGINT AS i, 5000::BIGINT AS room, NULL::VARCHAR AS part FROM p
        UNION ALL SELECT r.doc_id, i + 1, CASE WHEN length(ps[i + 1]) <= room THEN room - length(ps[i + 1]) WHEN room >= 100 THEN 0 ELSE room END, CASE WHEN length(ps[i + 1]) <= room THEN ps[i + 1] WHEN room >= 100 THEN substr(ps[i + 1], 1, room) END FROM r JOIN p USING (doc_id) WHERE i < len(ps))
    SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS pos, length(part)::INTEGER AS n_chars, sha256(part) AS digest FROM r WHERE part IS NOT NULL""")
def budget(spark: SparkSession, sf: str) -> DataFrame:
    return X.posexploded(table(spark, sf, "documents"), "doc_id", X.budgeted(X.paragraphs(F.col("text")), 5000, 100), "part").select("doc_id", "pos", F.length("part").alias("n_chars"), F.sha2("part", 256).alias("digest"))


@query("sc18a_page_furniture", f"""
    WITH l AS (SELECT doc_id, pos // 5 AS page, trim(line) AS line FROM ({LINES})), p AS (SELECT doc_id, count(DISTINCT page) AS pages FROM l GROUP BY 1),
    n AS (SELECT doc_id, line, count(DISTINCT page) AS n FROM l WHERE line <> '' AND length(line) <= 120 GROUP BY 1, 2)
    SELECT doc_id, line, n FROM n JOIN p USING (doc_id) WHERE n >= greatest(3, pages // 3)""")
def furniture(spark: SparkSession, sf: str) -> DataFrame:
    return X.furniture(lines(spark, sf).withColumn("page", F.floor(F.col("pos") / 5)), "doc_id", "page", "line")


@query("sc18c_text_quality", """
    SELECT doc_id, round(len(regexp_extract_all(text, '[A-Za-z]{2,}')) / greatest(length(text), 1) + 0.1 * len(regexp_extract_all(text, ' ')) / greatest(length(text), 1) - 0.02 * len(regexp_extract_all(text, ' {4,}')) - 0.01 * len(regexp_extract_all(text, '[a-z][A-Z]')), 6) AS score FROM documents""")
def quality(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.round(X.text_quality(F.col("text")), 6).alias("score"))


@query("x5_page_text", "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages")
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.plain(F.col("html")).alias("text"))


@query("sc21_page_sections", r"""
    WITH b AS (SELECT page_id, string_split_regex(html, '(?i)<h[1-3][^>]*>')[2:] AS bs FROM pages), e AS (SELECT page_id, unnest(bs) AS b, generate_subscripts(bs, 1) - 1 AS pos FROM b)
    SELECT page_id, pos::INTEGER AS pos, trim(regexp_replace(regexp_replace(regexp_extract(b, '(?is)^(.*?)</h[1-3]>', 1), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title, trim(regexp_replace(regexp_replace(regexp_extract(b, '(?is)</h[1-3]>(.*)$', 1), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM e""")
def page_sections(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.posexplode(X.leaf_sections(F.col("html"))).alias("pos", "s")).select("page_id", "pos", "s.title", "s.text")


@query("f18_section_titles", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN true ELSE false END AS relevant FROM part")
def titles(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators.predicates import relevant_title

    return table(spark, sf, "part").select("p_partkey", relevant_title(F.expr("CASE p_partkey % 3 WHEN 0 THEN 'Materials and Methods' WHEN 1 THEN 'Results: sampling' ELSE 'Introduction' END")).alias("relevant"))

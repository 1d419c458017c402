"""Queries over value strategies, techniques and neighbourhoods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.operators import predicates as P
from tidemark.operators import strategies as S
from tidemark.operators import techniques as Q
from tidemark.operators import texts as X
from tidemark.sources import archives as A

#: Sentences of the documents in SQL, as (doc_id, pos, s).
SENTENCES = "s0 AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) AS a FROM documents), s1 AS (SELECT doc_id, trim(unnest(a)) AS s, generate_subscripts(a, 1) AS i FROM s0), s AS (SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos FROM s1 WHERE s <> '')"


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return X.posexploded(table(spark, sf, "documents"), "doc_id", X.sentences(F.col("text")), "sentence")


def part_sentences(spark: SparkSession, sf: str, text: str) -> DataFrame:
    return X.posexploded(table(spark, sf, "part").select("p_partkey", F.expr(text).alias("t")), "p_partkey", X.sentences(F.col("t")), "sentence")


@query("x10a_evidence_sentences", f"""
    WITH {SENTENCES}, h AS (SELECT doc_id, lower(s) AS k, first(s ORDER BY pos) AS s, min(pos) AS pos FROM s WHERE regexp_matches(s, '(?i)(^|[^A-Za-z0-9])(license|terms\\s+of|contact)($|[^A-Za-z0-9])') GROUP BY 1, 2)
    SELECT doc_id, string_agg(s, ' | ' ORDER BY pos) AS value FROM h GROUP BY 1""")
def evidence_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return S.joined(S.collected(sentences(spark, sf), "doc_id", S.whole_sentence(F.col("sentence"), ["license", "terms of", "contact"])), "doc_id")


@query("x10b_phrases", """
    SELECT p_partkey, concat('MiSeq Reagent Kit v', p_size % 4, ' | Acme ', p_container, ' Library Kit (', p_brand, ')', CASE WHEN p_size % 4 <> p_size % 3 THEN concat(' | miseq reagent kit v', p_size % 3) ELSE '' END) AS value
    FROM (SELECT p_partkey, p_size, p_brand, concat('X', p_size) AS p_container FROM part)""")
def kit_phrases(spark: SparkSession, sf: str) -> DataFrame:
    t = "concat('We used MiSeq Reagent Kit v', CAST(p_size % 4 AS STRING), '. After that the Acme X', CAST(p_size AS STRING), ' Library Kit (', p_brand, ') followed. Then miseq reagent kit v', CAST(p_size % 3 AS STRING), ' again.')"
    rows = table(spark, sf, "part").select("p_partkey", X.sentences(F.expr(t)).alias("s"))
    return rows.select("p_partkey", F.array_join(S.phrases(F.col("s"), S.KITS), " | ").alias("value"))


@query("x10c_target_genes", "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '16S rRNA SSU | 18S rRNA SSU' WHEN 1 THEN '16S rRNA | COI' WHEN 2 THEN 'COI | 18S rRNA SSU' ELSE 'ITS | 16S' END AS value FROM part WHERE p_size % 5 <> 3")
def target_genes(spark: SparkSession, sf: str) -> DataFrame:
    t = "CASE p_size % 5 WHEN 0 THEN concat('Of ', p_name, ' we sequenced 16S and 18S SSU rRNA. Then 16S.') WHEN 1 THEN 'The 16S gene. Then the 16S rRNA gene and COI.' WHEN 2 THEN 'COI and 18S rRNA SSU, also 18S.' WHEN 3 THEN p_name ELSE 'ITS and its 16s, not 116S.' END"
    return S.genes(part_sentences(spark, sf, t), "p_partkey")


#: One text in which every strategy over sentences finds something, by the part's numbers.
METHODS = (
    "concat('Reads used the P', CAST(p_size AS STRING), 'F forward primer 5'' ', repeat('ACGT', 2 + p_size % 3), ' 3'' and the P', CAST(p_size AS STRING), 'R reverse primer 5'' ', repeat('ggwr', 2 + p_size % 2), ' 3''. "
    "PCR mix was ', CASE WHEN p_size % 2 = 0 THEN 'SYBR ' ELSE 'plain ' END, p_type, ' and was amplified using a cycler. SeqPrep 1.', CAST(p_size AS STRING), ' removed adapters. "
    "Low quality reads shorter than ', CAST(p_size AS STRING), ' bases were discarded by Trimmomatic v0.', CAST(p_size AS STRING), '. ', CASE p_size % 3 WHEN 0 THEN 'Then qPCR.' WHEN 1 THEN 'Metabarcoding with HTS and qPCR.' ELSE '' END)"
)


@query("x10_strategies", """
    SELECT p_partkey, 'forward_primer_name' AS field, concat('P', p_size, 'F') AS value FROM part UNION ALL SELECT p_partkey, 'forward_primer_sequence', repeat('ACGT', 2 + p_size % 3) FROM part UNION ALL SELECT p_partkey, 'reverse_primer_sequence', repeat('GGWR', 2 + p_size % 2) FROM part
    UNION ALL SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'commercial_mixture' ELSE 'custom_mixture' END, concat('PCR mix was ', CASE WHEN p_size % 2 = 0 THEN 'SYBR ' ELSE 'plain ' END, p_type) FROM part
    UNION ALL SELECT p_partkey, 'adapter_trim_tool', concat('SeqPrep 1.', p_size) FROM part UNION ALL SELECT p_partkey, 'length_quality_trim_tool', concat('Trimmomatic v0.', p_size) FROM part UNION ALL SELECT p_partkey, 'minimum_read_length', concat(p_size, ' bp') FROM part
    UNION ALL SELECT p_partkey, 'assay_type', CASE p_size % 3 WHEN 0 THEN 'targeted' ELSE 'targeted | metabarcoding' END FROM part WHERE p_size % 3 < 2""")
def strategies(spark: SparkSession, sf: str) -> DataFrame:
    return S.by_strategy(part_sentences(spark, sf, METHODS), "p_partkey", {k: k for k in S.STRATEGIES})


#: Ways to write techniques, and what they are; the last is no technique there, for its context is missing.
WRITTEN = (("Bray Curtis distances", "Bray-Curtis"), ("k-means", "k-means"), ("partial Mantel tests", "partial Mantel test"), ("generalised linear mixed models of abundance", "generalized linear mixed model"), ("naïve Bayes", "naive Bayes"), ("z score values", "z-score standardization"), ("partial least squares regression", "partial least squares regression"), ("ANCOM-BC", "ANCOM-BC"), ("Chao 1", "Chao1"), ("moran's I", "Moran's I"), ("RDA of the ordination", "RDA"), ("pls-da", "PLS-DA"), ("PAM", None))
_KNOWN = " ".join(f"WHEN {i} THEN '{n.replace(chr(39), chr(39) * 2)}'" for i, (_, n) in enumerate(WRITTEN) if n)
_TEXTS = " ".join(f"WHEN {i} THEN '{w.replace(chr(39), chr(39) * 2)}'" for i, (w, _) in enumerate(WRITTEN))


@query("x12_techniques", f"""
    WITH t AS (SELECT p_partkey, CASE p_partkey % 13 {_KNOWN} END AS technique, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END AS pos FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND (p_partkey % 3 <> 0 OR p_partkey % 2 = 0))
    SELECT p_partkey, technique, pos::INTEGER AS pos FROM t WHERE technique IS NOT NULL UNION ALL SELECT p_partkey, 'UMAP', 0 FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0""")
def techniques(spark: SparkSession, sf: str) -> DataFrame:
    # every seventh text speaks of chemistry alone; of odd ones, every third has its technique too far from any reads
    t = f"concat('UMAP ', CASE WHEN p_partkey % 7 = 0 THEN 'of temperature data ' ELSE 'of sequencing data ' END, 'came first. ', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'Nothing else was done. ' END, 'Then we ran ', CASE p_partkey % 13 {_TEXTS} END, '. ', CASE WHEN p_partkey % 7 = 0 OR p_partkey % 3 = 0 THEN p_name ELSE 'These were reads.' END, '.')"
    rows = part_sentences(spark, sf, t).withColumn("title", F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'Results and methods' ELSE 'Materials and methods' END"))
    return Q.techniques(rows, "p_partkey", F.col("title"))


@query("f19_neighbourhood", f"""
    WITH {SENTENCES}, w AS (SELECT doc_id, pos, concat_ws(' ', lag(s) OVER o, s, lead(s) OVER o) AS w FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY pos))
    SELECT doc_id, pos::INTEGER AS pos FROM w WHERE regexp_matches(w, '(?i)license') AND (NOT regexp_matches(w, '(?i)version') OR regexp_matches(w, '(?i)apache'))""")
def neighbourhood(spark: SparkSession, sf: str) -> DataFrame:
    return S.in_context(sentences(spark, sf), "doc_id", "(?i)license", "(?i)version", "(?i)apache").select("doc_id", "pos")


@query("f11_assembled_or_generic", "SELECT p_partkey, p_size % 4 = 0 OR p_size % 4 = 1 OR p_type LIKE '%PROMO%' AS assembled, p_size % 3 = 0 AS generic FROM part")
def assembled(spark: SparkSession, sf: str) -> DataFrame:
    e = F.expr
    title = e("CASE WHEN p_type LIKE '%PROMO%' THEN concat('A Metagenome-Assembled Genome of ', p_name) ELSE p_name END")
    generic = e("CASE p_size % 6 WHEN 0 THEN concat('MIMARKS Survey related sample from ', p_name) WHEN 3 THEN concat('BioSample ', CAST(p_size AS STRING)) ELSE p_name END")
    return table(spark, sf, "part").select("p_partkey", A.assembled(e("CASE WHEN p_size % 4 = 0 THEN 'MIMAG.6.0' ELSE 'MIMS.me' END"), e("CASE WHEN p_size % 4 = 1 THEN 'MIMAG' END"), title).alias("assembled"), A.generic_title(generic).alias("generic"))


@query("f12_supported_by_quote", "SELECT p_partkey, (p_size % 3 = 0 AND p_size % 2 = 0) OR (p_size % 3 = 1 AND p_size % 5 <> 0) OR p_size % 3 = 2 AS ok FROM part")
def supported(spark: SparkSession, sf: str) -> DataFrame:
    kind = "CASE p_size % 3 WHEN 0 THEN 'forward_primer_sequence' WHEN 1 THEN 'pcr_reaction_volume' ELSE 'device' END"
    value = "CASE p_size % 3 WHEN 0 THEN CASE WHEN p_size % 2 = 0 THEN ' acgtryn ' ELSE '515F' END WHEN 1 THEN concat(CAST(p_size AS STRING), ' µL') ELSE p_name END"
    quote = "CASE WHEN p_size % 5 = 0 THEN 'nothing' ELSE concat('in a volume  of ', CAST(p_size AS STRING), ' uL each') END"
    return table(spark, sf, "part").select("p_partkey", P.supported(F.expr(kind), F.expr(value), F.expr(quote)).alias("ok"))

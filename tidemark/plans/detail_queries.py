"""Queries over every identifier type, date format and title rule, and over paragraphs and filter facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import query, table
from tidemark.functions import filters as L
from tidemark.functions import identifiers as I
from tidemark.functions import values as V
from tidemark.operators import paragraphs as G
from tidemark.operators import predicates as P

#: By type: how a raw value begins, what its normal form begins with, and what a bare value is guessed to be.
KINDS = (
    ("doi", "doi:10.1234/Ab", "10.1234/ab", "doi"), ("dataset_doi", "http://dx.doi.org/10.5281/ZENODO.", "10.5281/zenodo.", "doi"), ("pmid", "PMID: ", "", None), ("pmcid", "pmc", "PMC", "pmcid"), ("bioproject_accession", "prjdb", "PRJDB", "bioproject_accession"),
    ("biosample_accession", "samn", "SAMN", "biosample_accession"), ("sra_submission_accession", "era", "ERA", "sra_submission_accession"), ("sra_study_accession", "drp", "DRP", "sra_study_accession"), ("sra_sample_accession", "ers", "ERS", "sra_sample_accession"),
    ("sra_experiment_accession", "srx", "SRX", "sra_experiment_accession"), ("sra_run_accession", "drr", "DRR", "sra_run_accession"), ("sra_analysis_accession", "erz", "ERZ", "sra_analysis_accession"), ("ena_study_accession", "erp", "ERP", "ena_study_accession"),
    ("cncb_project_accession", "prjca", "PRJCA", "cncb_project_accession"), ("cncb_biosample_accession", "samc", "SAMC", "cncb_biosample_accession"), ("cncb_study_accession", "cra", "CRA", "cncb_study_accession"), ("cncb_experiment_accession", "crx", "CRX", "cncb_experiment_accession"),
    ("cncb_run_accession", "crr", "CRR", "cncb_run_accession"), ("url", "https://Example.org/", "https://Example.org/", "url"), ("other", "Cruise-", "Cruise-", None), ("gbif_dataset_key", "ABCDEF01-2345-6789-abcd-0123456789", "abcdef01-2345-6789-abcd-0123456789", None),
)
_N = len(KINDS)
_TAIL = "CASE o_orderkey % {n} WHEN {last} THEN lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') ELSE CAST(o_orderkey AS VARCHAR) END".format(n=_N, last=_N - 1)


def _case(i: int) -> str:
    return f"CASE o_orderkey % {_N} " + " ".join(f"WHEN {k} THEN '{x[i]}'" if x[i] is not None else f"WHEN {k} THEN NULL" for k, x in enumerate(KINDS)) + " END"


@query("x1_all_types", f"SELECT o_orderkey, {_case(0)} AS kind, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % {_N} NOT IN ({_N - 3}, {_N - 2}) THEN NULL WHEN o_orderkey % 5 = 0 THEN concat({_case(2)}, {_TAIL}, ' !') ELSE concat({_case(2)}, {_TAIL}) END AS value FROM orders")
def all_types(spark: SparkSession, sf: str) -> DataFrame:
    tail = _TAIL.replace("VARCHAR", "STRING")
    raw = F.expr(f"concat('  ', {_case(1)}, {tail}, CASE WHEN o_orderkey % 5 = 0 THEN ' !' ELSE ' ' END)")  # a fifth of the values are none
    return table(spark, sf, "orders").select("o_orderkey", F.expr(_case(0)).alias("kind"), I.normalise(F.expr(_case(0)), raw).alias("value"))


@query("x2_all_types", f"SELECT o_orderkey, {_case(3)} AS kind FROM orders")
def all_guesses(spark: SparkSession, sf: str) -> DataFrame:
    tail = _TAIL.replace("VARCHAR", "STRING")
    return table(spark, sf, "orders").select("o_orderkey", I.guess(F.expr(f"concat({_case(1)}, {tail})")).alias("kind"))


#: Ways to write an order's date in both engines' formats, and how much of it is reported.
WRITTEN = (("yyyy-MM-dd", "%Y-%m-%d", 10), ("yyyy/MM/dd", "%Y/%m/%d", 10), ("d MMMM yyyy", "%-d %B %Y", 10), ("MMMM d, yyyy", "%B %-d, %Y", 10), ("d MMM yyyy", "%-d %b %Y", 10), ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S", 10), ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ", 10), ("MMMM yyyy", "%B %Y", 7), ("MMM yyyy", "%b %Y", 7), ("yyyy-MM", "%Y-%m", 7), ("yyyy", "%Y", 4))


@query("t6_all_formats", f"SELECT o_orderkey, CASE WHEN o_orderkey % {len(WRITTEN) + 1} = {len(WRITTEN)} THEN NULL ELSE substr(strftime(o_orderdate, '%Y-%m-%d'), 1, CASE o_orderkey % {len(WRITTEN) + 1} " + " ".join(f"WHEN {i} THEN {n}" for i, (_, _, n) in enumerate(WRITTEN)) + " END) END AS value FROM orders")
def all_formats(spark: SparkSession, sf: str) -> DataFrame:
    which = F.col("o_orderkey") % (len(WRITTEN) + 1)
    text = F.coalesce(*(F.when(which == i, F.date_format("o_orderdate", f)) for i, (f, _, _) in enumerate(WRITTEN)), F.lit("in spring"))
    return table(spark, sf, "orders").select("o_orderkey", V.event_date(F.concat(F.lit(" "), text, F.lit(" "))).alias("value"))


_TITLES = [t.replace(r"\b", "").replace("(area|site)", "site") for t in P.METHOD_TITLES]


@query("f18_all_titles", f"SELECT p_partkey, p_partkey % {len(_TITLES) + 2} < {len(_TITLES)} AND p_size % 4 <> 0 OR (p_partkey % {len(_TITLES) + 2} = {len(_TITLES)} AND p_size % 2 = 0) AS relevant FROM part")
def all_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Each word for methods in some title, some of them on results too; and titles that only one above speaks for."""
    words = " ".join(f"WHEN {i} THEN 'About {t.capitalize()} of all'" for i, t in enumerate(_TITLES))
    title = F.expr(f"concat(CASE p_partkey % {len(_TITLES) + 2} {words} ELSE 'Overview' END, CASE WHEN p_partkey % {len(_TITLES) + 2} < {len(_TITLES)} AND p_size % 4 = 0 THEN ' and Results' ELSE '' END)")
    above = F.expr(f"CASE WHEN p_partkey % {len(_TITLES) + 2} = {len(_TITLES)} AND p_size % 2 = 0 THEN array('Paper', 'Experimental Procedures') ELSE array('Paper') END")
    return table(spark, sf, "part").select("p_partkey", P.relevant_title(title, above).alias("relevant"))


@query("x13_readable_paragraphs", """
    SELECT p_partkey, 0 AS pos, concat('We sampled ', p_name, '. On the 3rd we left.') AS paragraph FROM part UNION ALL SELECT p_partkey, 1, concat('DNA was extracted from ', p_type, '.') FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 1, concat('mapping efficiency ', p_size, ' only') FROM part WHERE p_size % 2 = 1
    UNION ALL SELECT p_partkey, 2, 'After all.' FROM part WHERE p_size % 3 = 2""")
def readable(spark: SparkSession, sf: str) -> DataFrame:
    t = (
        "concat('We sampled ', p_name, '. Caribbean spawn ', CASE WHEN p_size % 2 = 0 THEN 'IV' ELSE '12' END, ' On the 3rd we left.\\n \\n', CASE p_size % 2 WHEN 0 THEN 'Table S 2. Reads' ELSE '  figure 3: All' END, '\\n\\n', "
        "'mapping efficiency ', CAST(p_size AS STRING), CASE WHEN p_size % 2 = 0 THEN concat(' 5 6 DNA was extracted from ', p_type, '.') ELSE ' only' END, CASE p_size % 3 WHEN 0 THEN '\\n\\n References \\n\\nSmith' WHEN 1 THEN '\\n\\n12. Smith, J.' ELSE '' END, CASE WHEN p_size % 3 = 2 THEN '\\n\\n\\nAfter all.\\n\\n' ELSE '\\n\\nAfter all.' END)"
    )
    return table(spark, sf, "part").select("p_partkey", F.posexplode(G.readable(F.expr(t))).alias("pos", "paragraph"))


@query("x13_categories", r"""
    WITH p AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS t FROM documents WHERE NOT regexp_matches(text, '(?m)^\s*\d{1,3}\.\s+[A-Z]')),
    c AS (SELECT doc_id, regexp_matches(t, '(?i)(^|[^A-Za-z0-9])(license|public\s+license)($|[^A-Za-z0-9])') AS a, regexp_matches(t, '(?i)(^|[^A-Za-z0-9])(contact|phone)($|[^A-Za-z0-9])') AS b FROM p)
    SELECT doc_id, count(*) FILTER (a) AS licence, count(*) FILTER (b) AS people FROM c GROUP BY 1 HAVING count(*) FILTER (a OR b) > 0""")
def gated(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where(~F.col("text").rlike(r"(?m)^\s*\d{1,3}\.\s+[A-Z]"))
    each = d.select("doc_id", F.explode(F.filter(F.transform(F.split("text", r"\n\s*\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")).alias("p")).select("doc_id", G.categories(F.col("p"), {"licence": ["license", "public license"], "people": ["contact", "phone"]}).alias("c"))
    n = lambda k: F.count_if(F.array_contains("c", k)).alias(k)
    return each.where("size(c) > 0").groupBy("doc_id").agg(n("licence"), n("people"))


@query("x16_filter_facts", """
    SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN concat('0.', p_size, ' µm') END AS size_frac, CASE WHEN p_size % 3 = 0 THEN concat(p_size, '.5') END AS filter_diameter, CASE p_size % 5 WHEN 0 THEN 'glass fiber' WHEN 1 THEN 'cellulose ester' END AS filter_material, CASE p_size % 7 WHEN 0 THEN 'Sterivex' WHEN 1 THEN 'Supor' END AS filter_name,
    CASE WHEN p_size % 7 = 0 OR p_size % 11 = 0 THEN '1' WHEN p_size % 2 = 0 OR p_size % 3 = 0 OR p_size % 5 < 2 OR p_size % 7 = 1 OR p_size % 13 = 0 THEN '0' END AS filter_passive_active_0_1 FROM part""")
def filter_facts(spark: SparkSession, sf: str) -> DataFrame:
    far = "repeat('x ', 40)"
    t = (
        f"concat('Water went through ', CASE WHEN p_size % 2 = 0 THEN concat('a 0.', CAST(p_size AS STRING), ' µm filter') ELSE concat('5 microns ', {far}, ' filter') END, {far}, CASE WHEN p_size % 3 = 0 THEN concat('discs: disc of ', CAST(p_size AS STRING), '.5 mm') ELSE 'nets' END, ' ', "
        f"{far}, CASE p_size % 5 WHEN 0 THEN 'Glass fiber' WHEN 1 THEN 'cellulose ester' ELSE 'cellulosee' END, ' ', CASE p_size % 7 WHEN 0 THEN 'sterivex' WHEN 1 THEN 'Supor' ELSE 'none' END, CASE WHEN p_size % 11 = 0 THEN ' under vacuum' ELSE '' END, CASE WHEN p_size % 13 = 0 THEN ' by gravity' ELSE '' END)"
    )
    return table(spark, sf, "part").select("p_partkey", L.filter_facts(F.expr(t)).alias("f")).select("p_partkey", "f.*")

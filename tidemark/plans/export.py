"""Exports: fixed-column CSV tables, one file per class, stale ones removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.mapping import crosswalk, wide
from tidemark.operators.passes import registry_problems

# The columns of each file, in order.
RAW_FACT_COLUMNS = ["fact_id", "study_id", "entity_id", "source_id", "source_locator", "raw_field_name", "raw_value", "normalized_text_value", "evidence_quote", "fact_type_candidate", "entity_level", "support_type", "extraction_method", "extractor_version", "model_name", "prompt_version", "review_status", "created_at"]
FIELD_REFERENCE_COLUMNS = ["faire_field", "faire_classes", "requirement_level_code", "requirement_level_condition", "range", "exact_mappings"]
CORRECTION_COLUMNS = ["paper_reference", "internal_study_id", "api_faire_term", "api_value", "corrected_faire_term", "corrected_value", "supporting_quote", "detector"]
CROSSWALK_COLUMNS = ["template_file", "protocol_section", "field_name", "resolution", "canonical_id", "match_priority", "value"]
USAGE_COLUMNS = ["canonical_id", "standard", "template_file", "protocol_section"]
SEED_COLUMNS = ["seed_id", "title", "doi", "pmid", "pmcid", "bioproject_accession", "ena_study_accession", "sra_study_accession", "dataset_id", "repository", "url", "notes"]
ENA_STUDY = r"^(ERP\d+|PRJEB\d+)$"


def fixed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns as text, missing ones and nulls empty."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))


def raw_facts(facts: DataFrame, path: str) -> None:
    """The long table in the order of study and time, in as many parts as Spark makes: a range sort, not one task."""
    rows = facts.orderBy("study_id", "created_at", "fact_id")
    fixed(rows, RAW_FACT_COLUMNS).write.mode("overwrite").csv(path, header=True)


def classes(values: DataFrame, layout: dict[str, list[str]], path: str, key: list[str]) -> None:
    """A wide table per class (table: its fields), and no others under path. values: key, target_table, field, value."""
    spark = values.sparkSession
    for name, fields in layout.items():
        rows = wide(values.where(F.col("target_table") == name), key, fields)
        fixed(rows, [*key, *fields]).write.mode("overwrite").csv(f"{path}/{name}", header=True)
    for name in listed(spark, path):
        if name not in layout:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def field_reference(spark: SparkSession, layout: dict[str, list[str]], terms: DataFrame) -> DataFrame:
    """One row for each field of the layout: its classes in the layout's order, and what the registry says of it. terms:
    field, requirement_level_code, requirement_level_condition, range, exact_mappings (array)."""
    at = [(f, i, c) for i, (c, fields) in enumerate(layout.items()) for f in fields]
    rows = spark.createDataFrame(at, "faire_field string, i int, c string").groupBy("faire_field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda x: x["c"]), "|").alias("faire_classes"))
    known = terms.select(F.col("field").alias("faire_field"), "requirement_level_code", "requirement_level_condition", "range", F.array_join("exact_mappings", "|").alias("exact_mappings")).dropDuplicates(["faire_field"])
    return fixed(rows.join(known, "faire_field", "left").orderBy("faire_field"), FIELD_REFERENCE_COLUMNS)


def corrections(rows: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Corrections by age with a reference to the paper: the study's first DOI, else its id. rows: study_id, created_at and the
    file's other columns; identifiers: study_id, type, value."""
    doi = identifiers.where("type = 'doi'").groupBy("study_id").agg(F.min("value").alias("_doi"))
    told = rows.join(doi, "study_id", "left").withColumn("paper_reference", F.coalesce("_doi", F.col("study_id").cast("string"))).withColumn("internal_study_id", F.col("study_id"))
    return fixed(told.orderBy("created_at", "study_id", "api_faire_term"), CORRECTION_COLUMNS)


def checklist(values: DataFrame, layout: dict[str, list[str]], path: str, key: list[str], terms: DataFrame, corrected: DataFrame, identifiers: DataFrame) -> None:
    """classes(), the field reference and the corrections."""
    extra = {"field_reference": field_reference(values.sparkSession, layout, terms), "api_paper_corrections": corrections(corrected, identifiers)}
    classes(values, layout, path, key)
    for name, rows in extra.items():
        rows.write.mode("overwrite").csv(f"{path}/{name}", header=True)


def registry(terms: DataFrame, template_fields: DataFrame, names: DataFrame, aliases: DataFrame) -> dict[str, DataFrame]:
    """The standards registry's five tables: terms, terms that only templates use, the crosswalk of template fields, their usage,
    and the validation report.

    terms: id, name, parent (null: none), standard; template_fields: template_file, protocol_section, field_name, value; names
    and aliases as in mapping.crosswalk(). A field that nothing resolves is a term of its own, once for each name.
    """
    found = crosswalk(template_fields.select(F.col("field_name").alias("term")).distinct(), names, aliases)
    priority = F.when(F.col("method") == "name", 1).when(F.col("method") == "alias", 2).when(F.col("method") == "case", 3)
    rows = template_fields.join(found.withColumnRenamed("term", "field_name"), "field_name").withColumns({"resolution": F.when(F.col("method") == "unresolved", "template_specific").otherwise(F.col("method")), "canonical_id": F.coalesce("target", F.concat(F.lit("template:"), F.lower("field_name"))), "match_priority": priority})
    own = rows.where("resolution = 'template_specific'").groupBy("canonical_id").agg(F.min("field_name").alias("name"), F.min("template_file").alias("source_file"), F.count("*").alias("usages"))
    standard = terms.select(F.col("id").alias("canonical_id"), "standard").dropDuplicates(["canonical_id"])
    usage = rows.join(standard, "canonical_id", "left").select("canonical_id", F.coalesce("standard", F.lit("template")).alias("standard"), "template_file", "protocol_section").distinct()
    problems = registry_problems(terms.select("id", "name"), terms.where("parent IS NOT NULL").select("id", "parent"))
    return {"terms": terms, "template_terms": own, "term_crosswalk": fixed(rows, CROSSWALK_COLUMNS), "template_field_usage": fixed(usage, USAGE_COLUMNS), "validation_report": problems}


def write_registry(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """The registry's tables as JSON (terms and the report) and CSV (crosswalk and usage), and how many rows each has."""
    for name, rows in tables.items():
        out = rows.write.mode("overwrite")
        out.csv(f"{path}/{name}", header=True) if name in ("term_crosswalk", "template_field_usage") else out.json(f"{path}/{name}")
    return {name: rows.count() for name, rows in tables.items()}


def benchmark_report(summary: DataFrame, cases: DataFrame, path: str, by: str) -> None:
    """summary: a row for each candidate, as one CSV; detail: each candidate with its figures and cases, as JSON lines."""
    summary.orderBy(by).coalesce(1).write.mode("overwrite").csv(f"{path}/summary", header=True)  # a row a candidate
    each = cases.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*[c for c in cases.columns if c != by]))).alias("cases"))
    summary.join(each, by, "left").write.mode("overwrite").json(f"{path}/detail")


def seed_rows(seeds: DataFrame) -> DataFrame:
    """The seed report as a seed file: canonical_dataset_id, primary_doi, study_title, accessions. A study accession of the wrong
    kind is left out of its column, since its own column has it."""
    ena = F.when(F.col("ena_study_accession").rlike(ENA_STUDY), F.col("ena_study_accession"))
    rows = seeds.withColumn("_ena", ena).withColumns({"seed_id": F.concat_ws(":", "seed_source", "canonical_dataset_id"), "title": F.col("study_title"), "doi": F.col("primary_doi"), "ena_study_accession": F.col("_ena"), "sra_study_accession": F.col("secondary_study_accession"), "dataset_id": F.col("canonical_dataset_id"), "repository": F.col("seed_source"), "notes": F.col("seed_status")})
    return fixed(rows.orderBy("canonical_dataset_id"), SEED_COLUMNS)


def listed(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]


class NotApplicable(NotImplementedError):
    """A target for which nothing can be exported."""


def bebop(*_: object) -> None:
    raise NotApplicable("protocol templates describe methods, not studies: there is nothing to export")

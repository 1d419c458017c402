"""Scans of seed rows, gold cases, exclusions and vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = "seed_id string, title string, doi string, pmid string, pmcid string, bioproject_accession string, ena_study_accession string, sra_study_accession string, dataset_id string, repository string, url string, notes string"


def blank_to_null(df: DataFrame) -> DataFrame:
    return df.select(*(F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


def seed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Seed rows of a CSV file with a header or of JSON lines, blanks as nulls; another ending is an error."""
    if path.lower().endswith(".csv"):
        return blank_to_null(spark.read.csv(path, header=True, schema=SEED, enforceSchema=False))
    if path.lower().endswith((".jsonl", ".ndjson")):
        return blank_to_null(spark.read.schema(SEED).json(path))
    raise ValueError(f"seeds are .csv or .jsonl files: {path}")


def excluded_dois(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="doi string, reason string, date_added string").select(F.lower(F.trim("doi")).alias("doi")).where("doi <> ''").distinct()


def exclude(dois: DataFrame, path: str) -> None:
    """Append DOIs (doi, reason, date_added) to the list, those that it lacks, each once."""
    spark = dois.sparkSession
    new = dois.withColumn("_k", F.lower(F.trim("doi"))).dropDuplicates(["_k"]).join(excluded_dois(spark, path).withColumnRenamed("doi", "_k"), "_k", "left_anti")
    new.select("doi", "reason", "date_added").write.mode("append").csv(path, header=True)


GOLD = "case_id string, curated_by string, notes string, section_title string, source_text string, expected_facts array<struct<fact_type_candidate:string, raw_value:string, evidence_quote:string>>"


def gold_cases(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(GOLD).json(folder, multiLine=True)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(enum_name, permissible_value) of a YAML list of enums; a vocabulary doesn't grow with the data."""
    import yaml

    with open(path) as f:
        enums = (yaml.safe_load(f) or {}).get("enums", {})
    rows = [(e, str(v)) for e, spec in enums.items() for v in (spec.get("permissible_values") or {})]
    return spark.createDataFrame(rows, "enum_name string, permissible_value string")

"""Validation: outcomes as structs of status, severity and message; cross-source agreement; missingness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identifiers
from tidemark.functions.values import NUCLEOTIDES, calendar_date, comparable, depth_metres, lat_lon
from tidemark.keys import first_accepted

DEEPEST = 11000


def outcome(status: str, severity: str) -> Column:
    return F.struct(F.lit(status).alias("status"), F.lit(severity).alias("severity"))


def not_assessed() -> Column:
    return outcome("not_assessed", "info")


def confirmed() -> Column:
    return outcome("confirmed", "info")


def wrong() -> Column:
    return outcome("unsupported", "error")


def late() -> Column:
    return outcome("unsupported", "warning")


def coordinates(value: Column) -> Column:
    p = lat_lon(value)
    return F.when(p.isNull(), not_assessed()).when((F.abs(p["lat"]) <= 90) & (F.abs(p["lon"]) <= 180), confirmed()).otherwise(wrong())


def depth(value: Column) -> Column:
    d = depth_metres(value)
    return F.when(d.isNull(), not_assessed()).when(d.between(0, DEEPEST), confirmed()).otherwise(wrong())


def collected_before(value: Column, year: Column) -> Column:
    d = calendar_date(value)
    return F.when(d.isNull(), not_assessed()).when(F.year(d) > year, late()).otherwise(confirmed())


def primer(value: Column) -> Column:
    v = F.regexp_replace(value, r"\s", "")
    return F.when((F.length(v) >= 6) & v.rlike(NUCLEOTIDES), confirmed()).otherwise(not_assessed())


def accession(kind: Column, value: Column) -> Column:
    return F.when(identifiers.normalise(kind, value).isNull(), wrong()).otherwise(confirmed())


def by_field(name: Column, value: Column, year: Column) -> Column:
    """The check that a field's name calls for, in this order; null for none."""
    return F.when(name.isin("lat_lon", "coordinates"), coordinates(value)).when(name == "depth", depth(value)).when(name == "collection_date", collected_before(value, year)).when(name.contains("primer"), primer(value))


def agreement(facts: DataFrame, by: list[str], source: str = "source_name", value: str = "raw_value", order: tuple[str, ...] = ("created_at", "fact_id")) -> DataFrame:
    """Per key, whether the first values of its sources agree: not_assessed below two sources, confirmed, or conflicting."""
    given = facts.where((F.coalesce(F.col(value), F.lit("")) != "") & F.col(source).isNotNull())
    first = first_accepted(given, *by, source, order=order, status=None)
    n = first.groupBy(*by).agg(F.count("*").alias("n_sources"), F.count_distinct(comparable(F.col(value))).alias("n_values"))
    return n.withColumn("status", F.when(F.col("n_sources") < 2, "not_assessed").when(F.col("n_values") == 1, "confirmed").otherwise("conflicting"))


def evidence_failures(facts: DataFrame, known: DataFrame, ok: Column) -> DataFrame:
    """Facts whose evidence fails and whose failure isn't recorded yet."""
    return facts.where(~ok).join(known.select("fact_id"), "fact_id", "left_anti")


def missingness(studies: DataFrame, fields: DataFrame, values: DataFrame, supplements: DataFrame, inspected: DataFrame) -> DataFrame:
    """Every study and field (a fixed, short list) with its status: present, unresolved_supplement, not_found or not_inspected."""
    grid = studies.select("study_id", F.explode(fields.agg(F.collect_set("field")).scalar()).alias("field"))
    have = values.select("study_id", "field").distinct().withColumn("_have", F.lit(True))
    unresolved = supplements.select("study_id").distinct().withColumn("_open", F.lit(True))
    seen = inspected.select("study_id").distinct().withColumn("_seen", F.lit(True))
    out = grid.join(have, ["study_id", "field"], "left").join(unresolved, "study_id", "left").join(seen, "study_id", "left")
    status = F.when(F.col("_have"), "present").when(F.col("_open"), "unresolved_supplement").when(F.col("_seen"), "not_found").otherwise("not_inspected")
    return out.select("study_id", "field", status.alias("status"))


def completeness(entities: DataFrame, mandatory: DataFrame, values: DataFrame, by: str) -> DataFrame:
    """Mandatory fields (a short list) that an entity lacks."""
    grid = entities.select(by).distinct().select(by, F.explode(mandatory.agg(F.collect_set("field")).scalar()).alias("field"))
    return grid.join(values.select(by, "field"), [by, "field"], "left_anti")


def asset_inventory(facts: DataFrame, recorded: DataFrame, fields: list[str]) -> DataFrame:
    """One row per run and file address that isn't recorded: last value wins within an entity; a size only of digits."""
    last = facts.groupBy("entity_id", "field").agg(F.max_by("value", F.struct("created_at", "fact_id")).alias("value"))
    wide = last.groupBy("entity_id").pivot("field", fields).agg(F.first("value"))
    rows = wide.where(F.coalesce(F.col("fastq_ftp"), F.lit("")) != "").select("entity_id", F.col("fastq_ftp").alias("url"), F.when(F.col("fastq_bytes").rlike(r"^\d+$"), F.col("fastq_bytes").cast("long")).alias("size_bytes"))
    form = F.when(F.lower("url").rlike(r"\.(fastq|fq)(\.gz)?$"), "fastq").when(F.lower("url").rlike(r"\.(fasta|fa|fna)(\.gz)?$"), "fasta").when(F.lower("url").endswith(".bam"), "bam").otherwise("unknown")
    return rows.withColumn("format", form).join(recorded.select("url"), "url", "left_anti")

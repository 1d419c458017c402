"""Facts that mean different samples of one study, and the mapping's fixed and derived values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.keys import joined_distinct

# Words that tell a sample's type, and the attributes in which they are looked for, in this order.
TYPES = (("sediment", r"(?i)\b(?:sediment|soil)s?\b"), ("water", r"(?i)\bwater\b"))
ATTRIBUTES = ("isolation_source", "env_medium", "samp_mat_process")
#: Fields that keep every value, and those of them whose several values ask for review.
PIPED = ("targetTaxonomicAssay", "targetTaxonomicScope", "platform", "instrument", "samp_mat_process", "otu_db", "size_frac", "x_env_var_block", "spreadsheet_headers")
REVIEWED = ("platform", "instrument")
API_SUPPORT = ("structured_source", "deterministically_derived")


def type_in(text: Column) -> Column:
    """The only sample type that a text names, else null."""
    named = F.filter(F.array(*(F.when(text.rlike(p), F.lit(k)) for k, p in TYPES)), lambda x: x.isNotNull())
    return F.when(F.size(named) == 1, named[0])


def type_of_quote(value: Column, quote: Column) -> Column:
    """The type that the first sentence of the quote that holds the value, and names one type only, gives."""
    parts = F.split(F.regexp_replace(quote, r"(?<=[.!?])\s+", "\n"), "\n")
    told = F.transform(F.filter(parts, lambda s: F.contains(F.lower(s), F.lower(value))), type_in)
    return F.try_element_at(F.filter(told, lambda t: t.isNotNull()), F.lit(1))


def entity_types(facts: DataFrame) -> DataFrame:
    """(study_id, entity_id, type): by the first attribute in order, as oldest given, that names a type. facts: study_id,
    entity_id, field, value, created_at."""
    rank = F.coalesce(*(F.when(F.col("field") == a, i) for i, a in enumerate(ATTRIBUTES)))
    first = facts.where(rank.isNotNull()).groupBy("study_id", "entity_id", rank.alias("rank")).agg(F.min(F.struct("created_at", "value")).alias("f"))
    named = F.coalesce(*(F.when(F.col("f.value").rlike(p), F.lit(k)) for k, p in TYPES))
    return first.where(named.isNotNull()).groupBy("study_id", "entity_id").agg(F.min_by(named, "rank").alias("type"))


def routed(facts: DataFrame, types: DataFrame) -> DataFrame:
    """(study_id, entity_id, field, value, review_required): values that a study's facts tie to different sample types.

    facts: study_id, field, value, quote, created_at, of fields that may mean different samples; types: the study's own samples
    (study_id, entity_id, type). A field takes part only if its facts name two types. Where a sample's type is one of those, each
    sample gets its type's oldest value. Where none is, and another field of the study is in the same conflict, all values go to
    the study as one, for review; else the oldest fact wins for the study.
    """
    real = facts.where("value IS NOT NULL")
    told = real.withColumn("type", type_of_quote(F.col("value"), F.col("quote")))
    by_type = told.where("type IS NOT NULL").groupBy("study_id", "field", "type").agg(F.min(F.struct("created_at", "value")).alias("f")).select("study_id", "field", "type", "f.value", "f.created_at")
    split = by_type.groupBy("study_id", "field").agg(F.count("*").alias("k")).where("k > 1").select("study_id", "field")
    conflicts = split.groupBy("study_id").agg(F.count("*").alias("fields"))
    rows = by_type.join(split, ["study_id", "field"])
    placed = rows.join(types, ["study_id", "type"]).select("study_id", "entity_id", "field", "value", F.lit(False).alias("review_required"))
    none = F.lit(None).cast(types.schema["entity_id"].dataType).alias("entity_id")
    left = rows.join(placed.select("study_id", "field").distinct(), ["study_id", "field"], "left_anti").join(conflicts, "study_id")
    many = joined_distinct(left.where("fields > 1"), ["study_id", "field"], "value", ["created_at"], name="value")
    oldest = real.join(left.where("fields = 1").select("study_id", "field").distinct(), ["study_id", "field"], "left_semi").groupBy("study_id", "field").agg(F.min(F.struct("created_at", "value")).alias("f"))
    return (
        placed.unionByName(many.select("study_id", none, "field", "value", F.lit(True).alias("review_required")))
        .unionByName(oldest.select("study_id", none, "field", "f.value", F.lit(False).alias("review_required")))
    )


def piped_by_support(mapped: DataFrame, key: list[str]) -> DataFrame:
    """Fields that keep every distinct value: those of structured sources first, then the others, each by age; "not found" goes
    if there is anything else. Several values ask for review in the fields of REVIEWED. mapped: key, value, support_type,
    created_at, and the field in target_field."""
    parts = mapped.select(*key, (~F.col("support_type").isin(*API_SUPPORT)).cast("int").alias("late"), "created_at", F.posexplode(F.split("value", r"\|")).alias("ord", "value")).withColumn("value", F.trim("value")).where("value <> ''")
    first = parts.groupBy(*key, F.lower("value").alias("_k")).agg(F.min(F.struct("late", "created_at", "ord", "value")).alias("f"))
    all_ = first.groupBy(*key).agg(F.array_sort(F.collect_list("f")).alias("fs"))
    real = F.filter("fs", lambda f: F.lower(f["value"]) != "not found")
    kept = F.when(F.size("fs") > 1, real).otherwise(F.col("fs"))
    return all_.select(*key, F.array_join(F.transform(kept, lambda f: f["value"]), " | ").alias("value"), (F.col("target_field").isin(*REVIEWED) & (F.size(kept) > 1)).alias("review_required"))


def identity_values(entities: DataFrame, seen: DataFrame) -> DataFrame:
    """(study_id, entity_id, field, value): a sample's names and a library's id from its external id, where nothing else gives
    them. entities: study_id, entity_id, level, external_id; seen: entity_id, field."""
    fields = F.when(F.col("level") == "sample", F.array(F.lit("samp_name"), F.lit("materialSampleID"))).when((F.col("level") == "experiment_run") & ~F.col("external_id").startswith("internal:"), F.array(F.lit("lib_id")))
    rows = entities.where("external_id <> ''").select("study_id", "entity_id", F.explode(fields).alias("field"), F.col("external_id").alias("value"))
    return rows.join(seen.select("entity_id", "field").distinct(), ["entity_id", "field"], "left_anti").select("study_id", "entity_id", "field", "value")


def constants(studies: DataFrame, facts: DataFrame, field: str, value: str) -> DataFrame:
    """(study_id, field, value): a fixed value, such as the checklist's version, for each study that has no fact of the field."""
    have = facts.where((F.col("field") == field) & F.col("entity_id").isNull()).select("study_id").distinct()
    return studies.select("study_id").join(have, "study_id", "left_anti").select("study_id", F.lit(field).alias("field"), F.lit(value).alias("value"))

"""Facts to standardised values: rules, unions, defaults, overrides, and the pivot to wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import values as V

#: Rule transforms by name; add to it to extend the rule table.
TRANSFORMS: dict[str, object] = {
    "identity": lambda c: c,
    "constant_md5": lambda c: F.lit("MD5"),
    "latitude": V.latitude,
    "longitude": V.longitude,
    "single_latitude": lambda c: V.single_coordinate(c, "S"),
    "single_longitude": lambda c: V.single_coordinate(c, "W"),
    "min_metres": V.min_metres,
    "max_metres": V.max_metres,
    "event_date": V.event_date,
    "not_pointer": V.not_pointer,
    "licence_url": V.licence_url,
    "open_access": V.open_access,
    "file_forward": lambda c: V.file_name(c, 1),
    "file_reverse": lambda c: V.file_name(c, 2),
    "checksum_forward": lambda c: V.semicolon_part(c, 1),
    "checksum_reverse": lambda c: V.semicolon_part(c, 2),
    "percent": V.percent,
    "volume": V.volume,
    "error_tool": V.error_tool,
    "pcr_flag": lambda c: V.control_flag(c, V.PCR),
    "negative_control": lambda c: V.control_flag(c, V.NEGATIVE_CONTROLS),
    "positive_control": lambda c: V.control_flag(c, V.POSITIVE_CONTROLS),
    "control_category": V.control_category,
}

RULES = "rule_no int, source_fact_type string, source_entity_level string, target_table string, target_field string, transform string, enum_name string, review_required boolean"


def transformed(name: Column, value: Column, used: list[str]) -> Column:
    out = F.lit(None).cast("string")
    for k in used:
        out = F.when(name == k, TRANSFORMS[k](value)).otherwise(out)
    return out


def apply_rules(facts: DataFrame, rules: DataFrame, used: list[str] | None = None) -> DataFrame:
    """Facts by the rules of their type and level (a rule without level takes any); what a transform gives null for goes.
    Spark broadcasts the rule table if it is as small as such tables are."""
    hit = (facts.fact_type == rules.source_fact_type) & (rules.source_entity_level.isNull() | (rules.source_entity_level == facts.entity_level))
    both = facts.join(rules, hit)
    return both.withColumn("value", transformed(F.col("transform"), F.col("raw_value"), used or list(TRANSFORMS))).where("value IS NOT NULL")


def without_replaced(facts: DataFrame, normalised: DataFrame) -> DataFrame:
    """Mapped facts less the native ones of a field for which a normalised fact of the study exists: by target field."""
    return facts.join(normalised.select("study_id", "target_field").distinct(), ["study_id", "target_field"], "left_anti").unionByName(facts.join(normalised.select("fact_id"), "fact_id", "left_semi"))


def winners(mapped: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The oldest value of each target; a later different one asks for review. One aggregate, combined before the shuffle."""
    rest = [c for c in mapped.columns if c not in key]
    g = mapped.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_w"), (F.min("value") != F.max("value")).alias("_differ"))
    return g.select(*key, *(F.col("_w")[c].alias(c) if c != "review_required" else (F.col("_w")[c] | F.col("_differ")).alias(c) for c in rest)).select(*mapped.columns)


def piped(mapped: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Fields that keep every distinct value, structured sources first; "not found" goes if there is anything else."""
    first = mapped.where("value IS NOT NULL").groupBy(*key, F.lower("value").alias("_k")).agg(F.min(F.struct(*order, F.col("value").alias("_v"))).alias("_f"))
    all_ = first.groupBy(*key).agg(F.array_sort(F.collect_list("_f")).alias("_fs"))
    real = F.filter("_fs", lambda f: F.lower(f["_v"]) != "not found")
    return all_.select(*key, F.array_join(F.transform(F.when(F.size(real) > 0, real).otherwise(F.col("_fs")), lambda f: f["_v"]), " | ").alias("value"))


def with_units(values: DataFrame, units: DataFrame) -> DataFrame:
    """The value and its unit (the entity's, else the study's) unless it holds the unit already. units: study_id, entity_id
    (null: study-wide), field, unit."""
    own = units.where("entity_id IS NOT NULL").select("study_id", "entity_id", "field", F.col("unit").alias("u1"))
    wide = units.where("entity_id IS NULL").select("study_id", "field", F.col("unit").alias("u2"))
    j = values.join(own, ["study_id", "entity_id", "field"], "left").join(wide, ["study_id", "field"], "left")
    u = F.coalesce("u1", "u2")
    return j.withColumn("value", F.when(u.isNull() | F.contains(F.lower("value"), F.lower(u)), F.col("value")).otherwise(F.concat_ws(" ", "value", u))).drop("u1", "u2")


def layered(frames: list[DataFrame], key: list[str]) -> DataFrame:
    """Values of several steps, for each key the first step's that has it: overrides first, then winners, then defaults."""
    out = None
    for i, f in enumerate(frames):
        f = f.select(*key, "value").withColumn("_p", F.lit(i))
        out = f if out is None else out.unionByName(f)
    return out.groupBy(*key).agg(F.min_by("value", F.struct("_p", "value")).alias("value"))


def with_defaults(entity: DataFrame, study: DataFrame, entities: DataFrame) -> DataFrame:
    """Every entity's fields: its own values, else those of its study. entity: study_id, entity_id, field, value."""
    spread = entities.select("study_id", "entity_id").join(study.select("study_id", "field", "value"), "study_id")
    return layered([entity, spread.select("study_id", "entity_id", "field", "value")], ["study_id", "entity_id", "field"])


def wide(values: DataFrame, key: list[str], fields: list[str], field: str = "field", value: str = "value") -> DataFrame:
    """One column per field of the fixed list; the list makes the plan one aggregation."""
    return values.groupBy(*key).pivot(field, fields).agg(F.min(value))


def mutual_fill(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Where only one of two fields is given, the other points to it."""
    x, y = V.some(F.col(a)), V.some(F.col(b))
    return rows.withColumns({a: F.when(x.isNull() & y.isNotNull(), F.lit(f"N/A see {b}")).otherwise(x), b: F.when(y.isNull() & x.isNotNull(), F.lit(f"N/A see {a}")).otherwise(y)})


def layout(files: DataFrame, by: str = "study_id") -> DataFrame:
    """paired end if a run has two files or more, single end if one, no files if none; both ask for review. With any access
    status given, only accessible runs count. files: study, fastq_ftp, access (null allowed)."""
    n = F.size(F.filter(F.split(F.coalesce("fastq_ftp", F.lit("")), ";"), lambda x: F.trim(x) != ""))
    any_status = F.max(F.col("access").isNotNull()).over(Window.partitionBy(by))
    rows = files.withColumn("_s", any_status).withColumn("_n", F.when(~F.col("_s") | (F.lower(F.trim("access")) == "accessible"), n).otherwise(0))
    out = rows.groupBy(by).agg(F.max(F.col("_n") >= 2).alias("two"), F.max(F.col("_n") == 1).alias("one"))
    return out.select(by, F.when(F.col("two"), "paired end").when(F.col("one"), "single end").otherwise("no files").alias("lib_layout"), (F.col("two") & F.col("one")).alias("review_required"))


def fused_primers(sequences: DataFrame, by: list[str], least: int = 15, tail: int = 10) -> DataFrame:
    """Per key a short sequence that a longer one contains, and what the longer has besides: the shortest such, with the
    shortest longer one. Sequences of a key are few (a study's primers)."""
    s = sequences.select(*by, F.upper(F.regexp_replace("sequence", r"[\s'-]", "")).alias("s")).where(F.col("s").rlike(V.NUCLEOTIDES)).distinct()
    a, b = s.withColumnRenamed("s", "short"), s.withColumnRenamed("s", "long")
    pairs = a.join(b, by).where((F.length("long") > F.length("short")) & (F.length("short") >= least) & F.contains("long", "short"))
    best = pairs.groupBy(*by).agg(F.min(F.struct(F.length("short").alias("n"), "short", F.length("long").alias("m"), "long")).alias("p"))
    at = F.instr(F.col("p.long"), F.col("p.short"))
    adapter = F.when(at == 1, F.substring("p.long", F.length("p.short") + 1, F.length("p.long"))).otherwise(F.substring("p.long", F.lit(1), at - 1))
    return best.select(*by, F.col("p.short").alias("primer"), adapter.alias("adapter")).where(F.length("adapter") >= tail)


def project_ids(ids: DataFrame, order: tuple[str, ...] = ("bioproject_accession", "ena_study_accession", "sra_study_accession", "doi")) -> DataFrame:
    """A study's project id: its first identifier in the order of types."""
    place = F.coalesce(*(F.when(F.col("type") == t, i) for i, t in enumerate(order)))
    return ids.where(place.isNotNull()).groupBy("study_id").agg(F.min_by("value", F.struct(place, "value")).alias("project_id"))


def primers_from_corpus(facts: DataFrame) -> DataFrame:
    """Sequences for primer names of studies that give none, from other studies: the oldest that names both. facts: study_id,
    kind (name or sequence), value, created_at."""
    name = facts.where("kind = 'name'").select("study_id", F.lower("value").alias("name"), "created_at")
    seq = facts.where("kind = 'sequence'").select("study_id", F.col("value").alias("sequence"))
    known = name.join(seq, "study_id").groupBy("name").agg(F.min_by("sequence", F.struct("created_at", "sequence")).alias("sequence"))
    return name.join(seq.select("study_id"), "study_id", "left_anti").join(known, "name").select("study_id", "name", "sequence").distinct()


def crosswalk(terms: DataFrame, by_name: DataFrame, by_alias: DataFrame) -> DataFrame:
    """terms (term) resolved by exact name, else by alias, else case aside; which way is told."""
    low = by_name.groupBy(F.lower("name").alias("l")).agg(F.min("target").alias("t3"))
    j = terms.join(by_name.select(F.col("name").alias("term"), F.col("target").alias("t1")), "term", "left")
    j = j.join(by_alias.select(F.col("alias").alias("term"), F.col("target").alias("t2")), "term", "left").join(low, F.lower("term") == F.col("l"), "left")
    return j.select("term", F.coalesce("t1", "t2", "t3").alias("target"), F.when(F.col("t1").isNotNull(), "name").when(F.col("t2").isNotNull(), "alias").when(F.col("t3").isNotNull(), "case").otherwise("unresolved").alias("method"))


def run(facts: DataFrame, rules: DataFrame, used: list[str], normalised: DataFrame, pipe_fields: list[str], defaults: DataFrame) -> DataFrame:
    """The mapping as a chain of contributions, resolved once: rules, suppression of native facts, piped fields, winners,
    and defaults only where nothing else gives the field."""
    key = ["study_id", "entity_id", "target_field"]
    mapped = without_replaced(apply_rules(facts.where("review_status <> 'rejected'"), rules, used), normalised)
    first = winners(mapped.where(~F.col("target_field").isin(*pipe_fields)), key, ["created_at", "fact_id"])
    many = piped(mapped.where(F.col("target_field").isin(*pipe_fields)), key, ["created_at", "fact_id"])
    return layered([first.select(*key, "value"), many, defaults], key)

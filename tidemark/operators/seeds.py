"""Seeds: runs to studies, publication candidates, the seed report, ingestion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.graph import components
from tidemark.operators.predicates import ACCESS_RANK, present

CONFIDENCE = {"very_high": 4, "high": 3, "medium": 2, "low": 1}


def rank(c: Column, ranks: dict[str, int]) -> Column:
    return F.coalesce(*(F.when(c == k, v) for k, v in ranks.items()), F.lit(0))


def listed_bytes(sizes: Column) -> Column:
    """The sum of the whole numbers in a list split at ; or ,."""
    parts = F.transform(F.split(F.coalesce(sizes, F.lit("")), "[;,]"), lambda x: F.when(F.trim(x).rlike(r"^\d+$"), F.trim(x).cast("long")).otherwise(0))
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)


def runs_to_studies(runs: DataFrame) -> DataFrame:
    """One row per study of its runs, keyed by BioProject, else secondary, else study accession.

    Texts are the first given ones in the order of run accessions; percentages have two decimals, halves to even, over
    the distinct samples, or the runs if no sample is given.
    """
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    first = lambda c: F.min_by(text(c), F.when(text(c).isNotNull(), F.col("run_accession"))).alias(c)
    given = lambda c: F.count_if(present(F.col(c))).alias(f"with_{c}")
    access = rank(F.col("sequence_accessibility_status"), ACCESS_RANK)
    fields = ("collection_date", "lat_lon", "depth", "environment", "sample_collection", "library", "target_gene", "protocol")
    rows = runs.withColumns({"lat_lon": F.when(present(F.col("lat")) & present(F.col("lon")), "1"), "environment": F.coalesce(text("environment_biome"), text("environment_feature"), text("environment_material")), "library": F.coalesce(text("library_strategy"), text("library_source")), "protocol": F.coalesce(text("extraction_protocol"), text("library_construction_protocol"))})
    out = rows.groupBy(F.coalesce(text("bioproject_accession"), text("secondary_study_accession"), text("study_accession")).alias("canonical_dataset_id")).agg(
        *(first(c) for c in ("bioproject_accession", "secondary_study_accession", "study_accession", "study_title")),
        F.count("*").alias("run_count"),
        F.count_distinct(text("sample_accession")).alias("n1"),
        F.count_distinct(text("secondary_sample_accession")).alias("n2"),
        F.count_if(access >= 1).alias("downloadable_run_count"),
        F.count_if(F.col("sequence_accessibility_status") == "fastq_confirmed").alias("fastq_run_count"),
        F.sum(listed_bytes(F.col("fastq_bytes"))).alias("fastq_bytes_total"),
        F.max_by("sequence_accessibility_status", access).alias("sequence_accessibility_status"),
        F.array_join(F.array_sort(F.collect_set(text("marine_match_methods"))), "|").alias("marine_match_methods"),
        *(given(c) for c in fields),
    )
    out = out.where("canonical_dataset_id IS NOT NULL").withColumn("sample_count", F.when(F.col("n1") > 0, F.col("n1")).otherwise(F.col("n2")))
    over = F.when(F.col("sample_count") > 0, F.col("sample_count")).otherwise(F.col("run_count"))
    for c in ("collection_date", "lat_lon", "depth"):
        out = out.withColumn(f"pct_{c}", F.bround(F.col(f"with_{c}") / over * 100, 2))
    score = sum(((F.col(f"with_{c}") > 0).cast("int") for c in fields), F.lit(0))
    return out.withColumn("metadata_usefulness_score", score).drop("n1", "n2")


def primary_candidates(candidates: DataFrame, study: str = "study_id") -> DataFrame:
    """Per study the primary publication and how sure it is: the earliest of high confidence with an identifier, then the more
    confident, then the smaller id; ambiguous if the first two tie on date and confidence."""
    has_id = F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("normalized_doi", "pmid", "pmcid", "openalex_id"))).isNotNull()
    level = rank(F.col("match_confidence"), CONFIDENCE)
    date = F.coalesce(F.nullif(F.col("publication_date"), F.lit("")), F.lpad(F.nullif("publication_year", F.lit(0)).cast("string"), 4, "0"), F.lit("9999"))
    rows = candidates.select(study, "id", has_id.alias("has_id"), (has_id & (level >= 3)).alias("high"), F.struct(date.alias("date"), (-level).alias("level"), "id").alias("key"))
    best = rows.groupBy(study).agg(F.count("*").alias("n"), F.max("has_id").alias("any_id"), F.min(F.when(F.col("high"), F.col("key"))).alias("best"))
    tied = rows.where("high").groupBy(study, F.col("key.date").alias("d"), F.col("key.level").alias("l")).agg(F.count("*").alias("k"))
    out = best.join(tied.withColumnRenamed(study, "_s"), (F.col(study) == F.col("_s")) & (F.col("best.date") == F.col("d")) & (F.col("best.level") == F.col("l")), "left")
    status = F.when(F.col("best").isNull(), "publication_candidates_low_confidence").when(F.col("k") > 1, "resolved_ambiguous").when(F.col("n") > 1, "resolved_multiple_publications").otherwise("resolved")
    return out.select(study, F.col("best.id").alias("primary_id"), status.alias("status"), F.col("n").alias("n_candidates"))


def seed_report(studies: DataFrame, candidates: DataFrame, kind: str) -> DataFrame:
    """Studies with their primary publication, other DOIs and status; kind is "mgnify" or "ena"."""
    primary = candidates.where("is_primary = 1").select("study_id", "normalized_doi", "match_confidence", "title")
    other = candidates.groupBy("study_id").agg(F.count("*").alias("publication_candidate_count"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("is_primary") == 0, F.col("normalized_doi")))), "|").alias("alternate_dois"))
    sure = F.col("normalized_doi").isNotNull() & F.col("match_confidence").isin("very_high", "high")
    if kind == "ena":
        status = F.when((F.col("downloadable_run_count") > 0) & sure, "complete").when(F.col("publication_resolution_status") == "publication_candidates_low_confidence", "publication_candidates_low_confidence").otherwise("sequence_data_found_no_paper")
    else:
        status = F.when(sure, "complete").when(F.col("publication_resolution_status") == "openalex_no_resolve_reprocess", "sequence_data_found_no_paper").otherwise(F.col("publication_resolution_status"))
    rows = studies.join(primary, "study_id", "left").join(other, "study_id", "left")
    return rows.select(
        F.lit(kind).alias("seed_source"), F.col("study_id").cast("string").alias("canonical_dataset_id"), "study_title", "run_count", "downloadable_run_count",
        F.col("normalized_doi").alias("primary_doi"), F.col("match_confidence").alias("publication_match_confidence"),
        F.nullif("alternate_dois", F.lit("")).alias("alternate_dois"), F.coalesce("publication_candidate_count", F.lit(0)).alias("publication_candidate_count"), status.alias("seed_status"),
    )


def paper_seeds(mgnify: DataFrame, ena: DataFrame, candidates_m: DataFrame, candidates_e: DataFrame) -> DataFrame:
    return seed_report(mgnify, candidates_m, "mgnify").unionByName(seed_report(ena, candidates_e, "ena"))


def new_study(group: Column) -> Column:
    return F.concat(F.lit("NEW-"), group.cast("string"))


def ingest(seeds: DataFrame, excluded: DataFrame, known: DataFrame, new: Callable[[Column], Column] = new_study) -> DataFrame:
    """(seed_id, study_id): seeds that aren't excluded, with the known study of one of their identifiers, else a new one; seeds
    of one batch that share an identifier become one study. A seed with an excluded DOI goes with all its identifiers. seeds:
    seed_id, type, value; known: type, value, study_id. new names a new study by its smallest seed."""
    out = seeds.join(excluded.select(F.lit("doi").alias("type"), F.col("doi").alias("value")), ["type", "value"], "left_semi").select("seed_id").distinct()
    rows = seeds.join(out, "seed_id", "left_anti")
    heads = rows.groupBy("type", "value").agg(F.min("seed_id").alias("b"))
    labels = components(rows.join(heads, ["type", "value"]).select(F.col("seed_id").alias("a"), "b"))
    groups = rows.join(labels, rows.seed_id == labels.node, "left").withColumn("group", F.coalesce("label", "seed_id"))
    found = groups.join(known, ["type", "value"], "left").groupBy("group").agg(F.min("study_id").alias("old"))
    return groups.select("seed_id", "group").distinct().join(found, "group").select("seed_id", F.coalesce("old", new(F.col("group"))).alias("study_id"))


def merged_candidates(rows: DataFrame, keys: list[str], fills: list[str], score: str) -> DataFrame:
    """Publication candidates of a study that share any key, as one: the first given value of every column, the best score."""
    links = None
    for k in keys:
        own = rows.where(F.col(k).isNotNull())
        heads = own.groupBy("study_id", k).agg(F.min("id").alias("b"))
        part = own.join(heads, ["study_id", k]).select(F.col("id").alias("a"), "b")
        links = part if links is None else links.union(part)
    at = rows.join(components(links).withColumnRenamed("node", "id"), "id", "left").withColumn("id0", F.coalesce("label", "id"))
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("id"))).alias(c) for c in dict.fromkeys([*keys, *fills])]
    return at.groupBy("study_id", F.col("id0").alias("candidate_id")).agg(*first, F.max(score).alias(score))


def resolution_queue(studies: DataFrame, order: dict[str, int], n: int) -> DataFrame:
    return studies.orderBy(F.coalesce(*(F.when(F.col("status") == k, v) for k, v in order.items()), F.lit(99)), "study_id").limit(n)


def capped(rows: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first `most` rows of each key, each with whether its key had more (the cap is the feature)."""
    w = Window.partitionBy(*by)
    return rows.withColumn("_n", F.row_number().over(w.orderBy(*order))).withColumn("overflow", F.count("*").over(w) > most).where(F.col("_n") <= most).drop("_n")

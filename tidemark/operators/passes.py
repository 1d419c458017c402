"""Passes over a study's facts that add, default or flag values, and checks of registries and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import some, squeezed
from tidemark.keys import joined_distinct


def accepted(facts: DataFrame) -> DataFrame:
    return facts.where("review_status <> 'rejected'")


def experiment_runs(facts: DataFrame, linked: DataFrame, kinds: tuple[str, ...], anchors: tuple[str, ...]) -> DataFrame:
    """Experiments for sequencing runs that have none: named by library, library name or experiment accession, else by an
    internal key, with their sample. facts: study_id, run_id, kind, value, created_at; linked: run_id."""
    own = facts.where(F.col("kind").isin(*kinds)).join(linked, "run_id", "left_anti")
    first = lambda *names: F.coalesce(*(F.min_by(F.when(F.col("kind") == n, some(F.col("value"))), F.when(F.col("kind") == n, F.col("created_at"))) for n in names))
    got = own.groupBy("study_id", "run_id").agg(first("lib_id", "library_name", "experiment_accession").alias("lib"), first("sample_accession", "samp_name").alias("sample_id"), F.max(F.col("kind").isin(*anchors)).alias("anchored"))
    return got.where("anchored").select("study_id", "run_id", F.coalesce("lib", F.concat(F.lit("internal:run:"), F.col("run_id").cast("string"))).alias("experiment_id"), "sample_id")


def filtration_default(facts: DataFrame, target: str, evidence: tuple[str, ...], active: str) -> DataFrame:
    """Studies with evidence of filters but no stated kind: 1 if any evidence matches `active`, else 0."""
    f = accepted(facts)
    given = f.where(F.col("kind") == target).select("study_id").distinct()
    text = F.concat_ws(" ", "value", "quote")
    return f.where(F.col("kind").isin(*evidence)).join(given, "study_id", "left_anti").groupBy("study_id").agg(F.when(F.max(text.rlike(active)), "1").otherwise("0").alias("value"))


def recorded_by(samples: DataFrame, authors: DataFrame) -> DataFrame:
    """Who recorded a study's samples: their submitters if any are given, else the paper's first author.
    samples: study_id, submitter, created_at; authors: study_id, authors (piped)."""
    real = joined_distinct(samples.where(some(F.col("submitter")).isNotNull()), ["study_id"], "submitter", ["created_at"], name="value")
    first = authors.select("study_id", some(F.substring_index("authors", "|", 1)).alias("value")).where("value IS NOT NULL")
    return real.withColumn("method", F.lit("submitter")).unionByName(first.join(real, "study_id", "left_anti").withColumn("method", F.lit("first_author")))


def untraceable_primers(facts: DataFrame, name: str, sequence: str, reference: str, corpus: DataFrame) -> DataFrame:
    """Studies that name a primer, but give neither its sequence nor a reference, when no other study gives one either.
    corpus: primer (lower case)."""
    f = accepted(facts)
    named = f.where(F.col("kind") == name).select("study_id", F.lower(F.trim("value")).alias("primer")).distinct()
    has = f.where(F.col("kind").isin(sequence, reference)).select("study_id").distinct()
    return named.join(has, "study_id", "left_anti").join(corpus, "primer", "left_anti").select("study_id").distinct()


def detection_flags(studies: DataFrame, detected: DataFrame, sections: list[str]) -> DataFrame:
    """A 0 or 1 column for each section of the list, for every study."""
    wide = detected.groupBy("study_id").pivot("section", sections).agg(F.max(F.lit("1")))
    return studies.select("study_id").join(wide, "study_id", "left").na.fill("0", sections)


def replicate_range(groups: DataFrame, by: str) -> DataFrame:
    """Replicates of a study: 0, one number, or least-most over its groups (by, n; n null without groups)."""
    r = groups.groupBy(by).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    return r.select(by, F.when(F.col("lo").isNull(), "0").when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", "lo", "hi")).alias("replicates"))


def exported_studies(studies: DataFrame, links: DataFrame) -> DataFrame:
    """Studies to export: all but those whose entities are all at home in other studies. links: study_id, home_study_id."""
    linked = links.select("study_id").distinct()
    homed = links.where("study_id = home_study_id").select("study_id").distinct()
    return studies.join(linked.join(homed, "study_id", "left_anti"), "study_id", "left_anti")


def accessible(studies: DataFrame, entities: DataFrame, facts: DataFrame) -> DataFrame:
    """Studies with an entity, or an accepted status fact of confirmed or likely data."""
    said = accepted(facts).where("kind = 'sequence_data_status' AND lower(value) IN ('confirmed', 'likely')").select("study_id")
    return studies.join(entities.select("study_id").unionByName(said).distinct(), "study_id", "left_semi")


def weekly_plan(studies: DataFrame, now: Column, days: int) -> DataFrame:
    """How many studies can be refreshed, and how many of those weren't checked for `days` or more."""
    return studies.agg(F.count_if("refreshable").alias("refreshable"), F.count_if(F.col("refreshable") & (F.date_diff(now, "last_checked") >= days)).alias("stale"))


def registry_problems(terms: DataFrame, parents: DataFrame) -> DataFrame:
    """(problem, term): ids given twice, blank names, and parents that aren't terms. terms: id, name; parents: id, parent."""
    twice = terms.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_id").alias("problem"), F.col("id").alias("term"))
    blank = terms.where(some(F.col("name")).isNull()).select(F.lit("blank_name").alias("problem"), F.col("id").alias("term"))
    lost = parents.join(terms.select(F.col("id").alias("parent")), "parent", "left_anti").select(F.lit("unknown_parent").alias("problem"), F.col("parent").alias("term")).distinct()
    return twice.unionByName(blank).unionByName(lost)


def title_similarity(left: Column, right: Column) -> Column:
    """The Ratcliff-Obershelp ratio of two titles in a plain form (tags, punctuation and articles dropped), by an Arrow-batched
    UDF over pairs that a join by study has made: no built-in computes it."""
    import pandas as pd
    from difflib import SequenceMatcher

    def ratio(a: "pd.Series", b: "pd.Series") -> "pd.Series":
        return pd.Series([1.0 if x == y and x else SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])

    ratio.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(ratio, "double")(plain_title(left), plain_title(right))


def plain_title(title: Column) -> Column:
    t = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "<[^>]+>", " ")
    return squeezed(F.regexp_replace(F.regexp_replace(t, "[^a-z0-9]+", " "), r"\b(?:a|an|the)\b", " "))


def title_confidence(score: Column) -> Column:
    return F.when(score >= 0.98, "high").when(score >= 0.92, "medium")


#: Sequencing and assay cues: label and pattern, tried in this order.
CHECKSUMS = (("MD5", r"(?i)\bmd5\b"), ("SHA-256", r"(?i)\bsha-?256\b"), ("SHA-1", r"(?i)\bsha-?1\b"))


def labels_found(text: Column, cues: tuple[tuple[str, str], ...]) -> Column:
    """The labels whose pattern a text matches, in the order in which they first occur."""
    hits = F.filter(F.array(*(F.when(text.rlike(p), F.struct(F.regexp_instr(text, F.lit(p)).alias("at"), F.lit(i).alias("i"), F.lit(label).alias("label"))) for i, (label, p) in enumerate(cues))), lambda x: x.isNotNull())
    return F.array_join(F.transform(F.array_sort(hits), lambda x: x["label"]), " | ")


def minimum_read_length(text_sentences: Column) -> Column:
    """The first minimum read length in base pairs that a sentence on discarding or keeping reads states."""
    return F.nullif(F.regexp_extract(F.try_element_at(F.filter(text_sentences, lambda s: s.rlike(r"(?i)(discard|remov|retain|kept|minimum|shorter|longer)") & s.rlike(r"(?i)\b\d{2,4}\s*(bp|bases?|nt|base pairs?)\b")), F.lit(1)), r"(?i)\b(\d{2,4})\s*(?:bp|bases?|nt|base pairs?)\b", 1), F.lit(""))


def around(text: Column, pattern: str, width: int = 40) -> Column:
    """The first match with up to `width` characters on either side."""
    return F.regexp_extract(text, rf"(?is).{{0,{width}}}(?:{pattern}).{{0,{width}}}", 0)

"""Row predicates and classifiers, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import NUCLEOTIDES, bound, contains_any, doi_like, squeezed


def marine(texts: list[Column], accepted: tuple[str, ...], rejected: tuple[str, ...]) -> Column:
    """A rejected term beats an accepted one; no text is false; no accepted terms accept any text."""
    text = F.lower(F.concat_ws(" ", *(F.nullif(t, F.lit("")) for t in texts)))
    ok = contains_any(text, tuple(map(str.lower, accepted))) if accepted else F.lit(True)
    bad = contains_any(text, tuple(map(str.lower, rejected))) if rejected else F.lit(False)
    return (text != "") & ~bad & ok


def experiment_status(types: Column, accepted: tuple[str, ...]) -> Column:
    hit = contains_any(F.lower(F.coalesce(types, F.lit(""))), tuple(map(str.lower, accepted)))
    return F.when(hit, "experiment_type_accepted").otherwise("experiment_type_unresolved")


def has_positive_size(sizes: Column) -> Column:
    """A list of sizes, split at ; or , has a positive whole number."""
    parts = F.transform(F.split(F.coalesce(sizes, F.lit("")), "[;,]"), lambda x: F.trim(x))
    return F.exists(parts, lambda x: x.rlike(r"^\d+$") & ~x.rlike("^0+$"))


def present(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def accessibility(fastq: Column, fastq_bytes: Column, submitted: Column, submitted_bytes: Column, submitted_format: Column, sra: Column, sra_bytes: Column) -> Column:
    """How well a run's reads can be had, best first."""
    return (
        F.when(present(fastq) & has_positive_size(fastq_bytes), "fastq_confirmed")
        .when(present(submitted) & (has_positive_size(submitted_bytes) | present(submitted_format)), "submitted_reads_confirmed")
        .when(present(sra) & has_positive_size(sra_bytes), "sra_archive_confirmed")
        .when(present(fastq) | present(submitted) | present(sra), "sequence_locator_present_unverified")
        .otherwise("no_downloadable_reads")
    )


ACCESS_RANK = {"no_downloadable_reads": 0, "sequence_locator_present_unverified": 1, "sra_archive_confirmed": 2, "submitted_reads_confirmed": 3, "fastq_confirmed": 4}


def file_level(name: Column, size: Column) -> Column:
    """2 for sequence files and archives named as such, 1 for other archives of 1 MB or more, else 0."""
    low = F.lower(name)
    archive = low.rlike(r"\.(zip|tar\.gz|tgz|tar|rar|7z)$")
    return F.when(low.rlike(r"\.(fastq|fq|fasta|fa)(\.gz)?$|\.fna$"), 2).when(archive & low.rlike(r"fastq|fq_|_fq\.|fasta|reads|sequence"), 2).when(archive & (F.coalesce(size, F.lit(0)) >= 1_000_000), 1).otherwise(0)


def classify_listings(files: DataFrame, by: str, name: str, size: str) -> DataFrame:
    best = files.groupBy(by).agg(F.max(file_level(F.col(name), F.col(size))).alias("level"))
    return best.select(by, F.when(F.col("level") == 2, "confirmed").when(F.col("level") == 1, "likely").otherwise("absent").alias("status"))


def plausible_publication(has_id: Column, title: Column, kind: Column, confidence: Column, doi: Column) -> Column:
    """Any identifier or title; a review, preprint or similar only above low confidence; a DOI must be one."""
    secondary = F.coalesce(kind, F.lit("")).isin("review", "preprint", "dataset", "component", "peer-review", "editorial")
    return (has_id | present(title)) & ~(secondary & (confidence == "low")) & (~present(doi) | doi_like(doi))


def publication_title(title: Column) -> Column:
    """Five words or more and a cue of a study."""
    return (F.size(F.split(squeezed(title), " ")) >= 5) & F.lower(title).rlike(r"\b(reveals?|diversity|communit(y|ies)|analysis|effects?|study|assessment|using|across|dynamics)\b")


#: What a model writes for an absent value.
ABSENT = ("", "n/a", "na", "none", "null", "unknown", "not available", "not applicable", "not reported", "not specified", "not stated", "not provided", "not mentioned", "not found", "missing", "-")


def absent(value: Column) -> Column:
    v = squeezed(F.lower(F.coalesce(value, F.lit(""))))
    bare = F.regexp_replace(v, "[.;:]+$", "")
    return v.isin(*ABSENT) | bare.isin(*ABSENT) | bare.rlike(r"^(not\s+)?(explicitly\s+)?(stated|specified|reported|provided|mentioned)(\s+in\s+(the\s+)?text)?$")


def quoted(quote: Column, text: Column) -> Column:
    """The quote stands in the text, white space aside; a blank quote never does."""
    return F.coalesce(bound(squeezed(quote), lambda q: F.when(q != "", F.contains(squeezed(text), q))), F.lit(False))


# Facts whose value must be a sequence, and those whose volume must stand in the quote.
SEQUENCES = ("forward_primer_sequence", "reverse_primer_sequence")
VOLUMES = ("pcr_reaction_volume", "template_dna_volume", "second_pcr_reaction_volume", "second_pcr_template_dna_volume")


def supported(kind: Column, value: Column, quote: Column) -> Column:
    """Whether a quote bears a fact's value out: a primer's sequence is one (six IUPAC letters or more), and a volume stands in
    the quote as it is written, thin spaces and both micro signs aside. Other facts are."""
    plain = lambda c: squeezed(F.lower(F.translate(c, "\u2009\u202fµμ", "  uu")))
    sequence = F.trim(value).rlike(NUCLEOTIDES) & (F.length(F.trim(value)) >= 6)
    return F.when(kind.isin(*SEQUENCES), sequence).when(kind.isin(*VOLUMES), F.contains(plain(quote), plain(value))).otherwise(True)


def evidence_ok(support: Column, quote: Column, locator: Column) -> Column:
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    return F.when(support == "explicit", ~blank(quote)).when(support == "structured_source", ~blank(locator)).otherwise(True)


def in_vocabulary(values: DataFrame, terms: DataFrame, enum: str, value: str) -> DataFrame:
    """values with `valid`: a closed list (two terms or more) needs the value; an open one a link or a prefixed name; an
    unknown list takes anything."""
    sizes = terms.groupBy(F.col("enum_name").alias(enum)).agg(F.count("*").alias("_n"))
    exact = terms.select(F.col("enum_name").alias(enum), F.col("permissible_value").alias(value)).distinct().withColumn("_hit", F.lit(True))
    out = values.join(sizes, enum, "left").join(exact, [enum, value], "left")
    valid = F.when(F.col("_n").isNull(), True).when(F.col("_n") > 1, F.col("_hit").isNotNull()).otherwise(F.col("_hit").isNotNull() | F.contains(F.col(value), F.lit(":")))
    return out.withColumn("valid", valid).drop("_n", "_hit")


def looks_like_primer(value: Column) -> Column:
    v = F.regexp_replace(value, r"\s", "")
    return (F.length(v) >= 6) & v.rlike(NUCLEOTIDES)


def visible(required: Column, active: Column) -> Column:
    """A field shows if it needs no flag or one of its flags is active."""
    return (F.size(required) == 0) | F.arrays_overlap(required, active)


#: What the titles of sections on methods and data hold, and those of sections that aren't read.
METHOD_TITLES = ("method", "material", "procedure", r"\bdna\b", "sampl", "study (area|site)", "environmental", "extraction", "fixation", "sorting", "pcr", "qpcr", "quantitative pcr", "amplif", "assay", "primer", "librar", "sequenc", "data analys", "bioinformatic", "taxonom", "standard curve", "data availab", "supplementary method", "quality control")
RESULT_TITLES = (r"\bresults?\b", r"\bdiscussion\b", r"\bconclusions?\b")


def relevant_title(title: Column, above: Column | None = None) -> Column:
    """Whether a section is read: its title or one above it (an array) is on methods or data, and its own isn't on results,
    discussion or conclusions."""
    wanted, unwanted = "(?i)" + "|".join(METHOD_TITLES), "(?i)" + "|".join(RESULT_TITLES)
    own = title.rlike(wanted)
    if above is not None:
        own = own | F.exists(above, lambda t: t.rlike(wanted))
    return F.coalesce(own & ~title.rlike(unwanted), F.lit(False))

"""Facts from landed archive records: projects and samples as XML, run reports as rows, resolved ids, capped listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.values import squeezed

PROJECT = (
    "DocumentSummary struct<_uid:string,Submission:struct<_submitted:string>,Project:struct<ProjectID:struct<ArchiveID:struct<_accession:string>>,"
    "ProjectDescr:struct<Name:string,Title:string,Description:string>,ProjectType:struct<ProjectTypeSubmission:struct<Target:struct<Organism:struct<OrganismName:string>>>>>>"
)
SAMPLES = (
    "BioSample array<struct<_accession:string,_submission_date:string,_package:string,Models:struct<Model:string>,"
    "Ids:struct<Id:array<struct<_db_label:string,_VALUE:string>>>,Description:struct<Title:string,Organism:struct<_taxonomy_id:string,_taxonomy_name:string>>,"
    "Owner:struct<Name:string,Contacts:struct<Contact:array<struct<Name:struct<First:string,Last:string>>>>>,"
    "Attributes:struct<Attribute:array<struct<_attribute_name:string,_VALUE:string>>>>>"
)

# How assembled genomes and generic titles are told.
ASSEMBLED = r"(?i)\bmetagenome-assembled genome\b"
GENERIC_TITLE = r"(?i)^(?:MIMARKS|MIMS|MIGS|MIMAG|MIUVIG|MISAG|Environmental|Metagenome|Metagenomic)\b.*\bsample\b.*$|^(?:Bio)?Sample\s+\d+$"
#: Fields of a run report by what they describe.
STUDY_FIELDS = ("study_title", "study_accession", "secondary_study_accession", "center_name", "first_public")
RUN_FIELDS = ("run_alias", "instrument_platform", "instrument_model", "base_count", "read_count", "fastq_ftp", "fastq_md5", "fastq_bytes", "submitted_ftp", "submitted_md5", "sra_ftp", "last_updated", "sample_accession", "experiment_accession", "tax_id", "scientific_name", "nominal_length", "library_layout")
EXPERIMENT_FIELDS = ("library_name", "library_strategy", "library_source", "library_selection", "experiment_title")


def assembled(package: Column, model: Column, title: Column) -> Column:
    """Whether a sample record stands for an assembled genome, not for a sample: by its package or model, else its title."""
    none = F.lit("")
    return F.upper(F.coalesce(package, none)).startswith("MIMAG") | (F.upper(F.coalesce(model, none)) == "MIMAG") | F.coalesce(title, none).rlike(ASSEMBLED)


def generic_title(title: Column) -> Column:
    return F.coalesce(title.rlike(GENERIC_TITLE), F.lit(False))


def unpivoted(rows: DataFrame, keep: list[str], fields: dict[str, Column]) -> DataFrame:
    """(keep, field, value) of the fields that have a value."""
    pairs = F.array(*(F.struct(F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in fields.items()))
    return rows.select(*keep, F.explode(pairs).alias("f")).select(*keep, "f.field", "f.value").where("value IS NOT NULL AND trim(value) <> ''")


def project_facts(payloads: DataFrame, key: str = "payload_id", body: str = "body") -> DataFrame:
    """(key, accession, field, value) of project records; a record that can't be read gives none."""
    r = payloads.select(key, F.from_xml(F.col(body), PROJECT, {"rowTag": "RecordSet"}).alias("r")).select(key, "r.DocumentSummary.*")
    rows = r.select(key, F.col("Project.ProjectID.ArchiveID._accession").alias("accession"), "Project", "Submission")
    d = "Project.ProjectDescr"
    fields = {"name": f"{d}.Name", "title": f"{d}.Title", "description": f"{d}.Description", "organism": "Project.ProjectType.ProjectTypeSubmission.Target.Organism.OrganismName", "submitted": "Submission._submitted"}
    return unpivoted(rows, [key, "accession"], {k: F.col(v) for k, v in fields.items()})


def resolved_uids(searches: DataFrame, summaries: DataFrame) -> DataFrame:
    """(accession, uid, ambiguous): which record a search for an accession means. searches: accession, position, uid; summaries:
    uid, own (its own accession; a uid that several summaries give has all of theirs).

    The only hit is it; of several, the first whose own accession is the one searched for; if none is, the first, which is
    ambiguous and goes to review.
    """
    named = summaries.select("uid", F.upper(F.trim("own")).alias("_own")).distinct().withColumn("_same", F.lit(True))
    rows = searches.withColumn("_own", F.upper(F.trim("accession"))).join(named, ["uid", "_own"], "left")
    g = rows.groupBy("accession").agg(F.count("*").alias("n"), F.min(F.struct("position", "uid")).alias("first"), F.min(F.when(F.col("_same"), F.struct("position", "uid"))).alias("exact"))
    return g.select("accession", F.coalesce("exact.uid", "first.uid").alias("uid"), ((F.col("n") > 1) & F.col("exact").isNull()).alias("ambiguous"))


def samples(payloads: DataFrame, key: str = "payload_id", body: str = "body") -> DataFrame:
    """(key, accession, title, package, model, submitted, organism, owner, contact, attributes, position): sample records; the
    name among a record's ids is an attribute too, if the record gives none itself."""
    s = payloads.select(key, F.posexplode(F.from_xml(F.col(body), SAMPLES, {"rowTag": "BioSampleSet"})["BioSample"]).alias("position", "s")).where("s._accession <> ''")
    given = F.filter(F.coalesce("s.Attributes.Attribute", F.expr("cast(array() as array<struct<_attribute_name:string,_VALUE:string>>)")), lambda a: (a["_attribute_name"] != "") & a["_VALUE"].isNotNull())
    pairs = F.transform(given, lambda a: F.struct(a["_attribute_name"].alias("name"), a["_VALUE"].alias("value")))
    named = F.transform(F.filter(F.coalesce("s.Ids.Id", F.expr("cast(array() as array<struct<_db_label:string,_VALUE:string>>)")), lambda i: (i["_db_label"] == "Sample name") & (i["_VALUE"] != "")), lambda i: F.struct(F.lit("sample_name").alias("name"), i["_VALUE"].alias("value")))
    attributes = F.when(F.exists(pairs, lambda a: a["name"] == "sample_name"), pairs).otherwise(F.concat(pairs, F.slice(named, 1, 1)))
    contact = F.try_element_at("s.Owner.Contacts.Contact", F.lit(1))["Name"]
    o = "s.Description.Organism"
    return s.select(
        key, F.col("s._accession").alias("accession"), F.col("s.Description.Title").alias("title"), F.col("s._package").alias("package"), F.col("s.Models.Model").alias("model"),
        squeezed(F.col("s._submission_date")).alias("submitted"), F.coalesce(F.nullif(F.col(f"{o}._taxonomy_name"), F.lit("")), F.col(f"{o}._taxonomy_id")).alias("organism"),
        F.col("s.Owner.Name").alias("owner"), squeezed(F.concat_ws(" ", contact["First"], contact["Last"])).alias("contact"), attributes.alias("attributes"), "position",
    )


def sample_facts(records: DataFrame, canonical: Column | None = None) -> DataFrame:
    """(accession, field, value): attributes, organism and submission of samples(), without assembled genomes. canonical names an
    attribute (column name) otherwise; a cultivar or, without one, the organism is the host species too."""
    real = records.where(~assembled(F.col("package"), F.col("model"), F.col("title")))
    each = real.select("accession", F.explode("attributes").alias("a")).select("accession", "a.name", F.col("a.value").alias("value")).where("trim(value) <> ''")
    renamed = each.select("accession", (canonical if canonical is not None else F.lower(F.trim("name"))).alias("field"), "value")
    own = each.select("accession", F.col("name").alias("field"), "value").unionByName(renamed).unionByName(each.where("lower(name) = 'cultivar'").select("accession", F.lit("host_species").alias("field"), "value"))
    extra = unpivoted(real, ["accession"], {"organism": F.col("organism"), "host_species": F.col("organism"), "eventDate_submitted": F.col("submitted")})
    return own.distinct().unionByName(extra.join(own.select("accession", "field").distinct(), ["accession", "field"], "left_anti"))


def capped(rows: DataFrame, by: str, order: list[str], most: int, note: str) -> tuple[DataFrame, DataFrame]:
    """The first `most` rows of each key, and a note (key, field, value) for each key that has more: none goes unseen."""
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    total = rows.groupBy(by).agg(F.count("*").alias("n")).where(F.col("n") > most)
    told = F.concat(F.lit(f"Only the first {most} of "), F.col("n").cast("string"), F.lit(" were processed"))
    return ranked.where(F.col("_n") <= most).drop("_n"), total.select(by, F.lit(note).alias("field"), told.alias("value"))


def run_report(rows: DataFrame, most: int = 500) -> DataFrame:
    """(study_accession, level, entity, field, value): a read-run report as facts of its study, runs and experiments.

    A study's fields come from its first run; an experiment is known by its accession, else its library's name, else
    internal:ena:<run>, and links to its run and sample. Of a study with more than `most` runs the first count, with a note.
    """
    first, note = capped(rows, "study_accession", ["run_accession"], most, "run_coverage_note")
    experiment = F.coalesce(F.nullif(F.trim("experiment_accession"), F.lit("")), F.nullif(F.trim("library_name"), F.lit("")), F.concat(F.lit("internal:ena:"), F.col("run_accession")))
    first = first.withColumn("_e", experiment)
    have = lambda names: {c: F.col(c) for c in names if c in rows.columns}
    part = lambda d, level: d.withColumn("level", F.lit(level))
    heads = first.groupBy("study_accession").agg(*(F.min_by(c, "run_accession").alias(f"_{c}") for c in STUDY_FIELDS if c in rows.columns))
    study = unpivoted(heads.withColumn("entity", F.col("study_accession")), ["study_accession", "entity"], {c: F.col(f"_{c}") for c in STUDY_FIELDS if c in rows.columns})
    runs = unpivoted(first.withColumn("entity", F.col("run_accession")), ["study_accession", "entity"], have(RUN_FIELDS))
    experiments = unpivoted(first.withColumn("entity", F.col("_e")), ["study_accession", "entity"], have(EXPERIMENT_FIELDS) | {"sequenced_in_run": F.col("run_accession"), "derived_from_sample": F.col("sample_accession")}).distinct()
    notes = note.select("study_accession", F.col("study_accession").alias("entity"), "field", "value")
    out = part(study, "project").unionByName(part(runs, "sequencing_run")).unionByName(part(experiments, "experiment_run")).unionByName(part(notes, "project"))
    return out.select("study_accession", "level", "entity", "field", "value")


#: Columns of a run report whose accession a study may be looked up by.
HIERARCHY = ("run_accession", "experiment_accession", "sample_accession", "secondary_sample_accession", "submission_accession", "secondary_study_accession")


def parent_studies(accessions: DataFrame, runs: DataFrame) -> DataFrame:
    """(accession, study_accession): the study of each accession of any level, by landed run reports; several are ambiguous and
    give the smallest with ambiguous set."""
    levels = F.array(*(F.upper(F.trim(F.col(c))) for c in HIERARCHY if c in runs.columns))
    rows = runs.select(F.explode(F.filter(levels, lambda a: a.isNotNull() & (a != ""))).alias("_a"), "study_accession").distinct()
    g = rows.groupBy("_a").agg(F.min("study_accession").alias("study_accession"), (F.count("*") > 1).alias("ambiguous"))
    return accessions.select("accession").distinct().join(g, F.upper(F.trim("accession")) == F.col("_a")).select("accession", "study_accession", "ambiguous")


def occurrences(payloads: DataFrame, wanted: tuple[str, ...], path: str = "$.results", most: int = 50, key: str = "payload_id", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(key, record, field, value): the wanted fields of the first `most` records of a listing, at any depth of a record, and a
    note for each listing that has more."""
    from tidemark.sources.payloads import leaves

    records = payloads.select(key, F.posexplode(F.from_json(F.get_json_object(body, path), "array<string>")).alias("record", "r"))
    first, note = capped(records, key, ["record"], most, "occurrence_coverage_note")
    each = first.select(key, "record", F.explode(leaves(F.col("r"))).alias("l")).select(key, "record", F.col("l.key").alias("field"), F.col("l.value").alias("value"))
    return each.where(F.lower("field").isin(*(w.lower() for w in wanted)) & (F.trim("value") != "")).distinct(), note


def citing_datasets(payloads: DataFrame, key: str = "payload_id", body: str = "body") -> DataFrame:
    """(key, doi, relation, cited): datasets of a listing with what they say of which identifier."""
    related = "array<struct<relatedIdentifier:string,relationType:string>>"
    each = payloads.select(key, F.explode(F.from_json(F.get_json_object(body, "$.data"), "array<string>")).alias("d"))
    rows = each.select(key, F.lower(F.get_json_object("d", "$.attributes.doi")).alias("doi"), F.explode(F.from_json(F.get_json_object("d", "$.attributes.relatedIdentifiers"), related)).alias("x"))
    return rows.select(key, "doi", F.col("x.relationType").alias("relation"), F.lower("x.relatedIdentifier").alias("cited")).where("doi <> '' AND cited <> ''").distinct()


def supplement_references(payloads: DataFrame, key: str = "payload_id", body: str = "body") -> DataFrame:
    """(key, href): files that an article's XML names as supplementary, each once."""
    parts = F.regexp_extract_all(body, F.lit(r"(?is)<supplementary-material\b.*?</supplementary-material>"), F.lit(0))
    hrefs = F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(r"""(?i)xlink:href\s*=\s*["']([^"']+)["']"""), F.lit(1))))
    return payloads.select(key, F.explode(F.array_distinct(hrefs)).alias("href"))

"""Public identifiers: normal forms, type detection, and accessions in running text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import bound

#: The public grammars of accessions, upper case, by type.
ACCESSIONS = {
    "bioproject_accession": r"PRJ(NA|EB|DB)\d+",
    "biosample_accession": r"SAM(N|E|D)[A-Z]?\d+",
    "sra_submission_accession": r"(SRA|ERA|DRA)\d+",
    "sra_study_accession": r"(SRP|ERP|DRP)\d+",
    "sra_sample_accession": r"(SRS|ERS|DRS)\d+",
    "sra_experiment_accession": r"(SRX|ERX|DRX)\d+",
    "sra_run_accession": r"(SRR|ERR|DRR)\d+",
    "sra_analysis_accession": r"(SRZ|ERZ|DRZ)\d+",
    "ena_study_accession": r"(ERP\d+|PRJEB\d+)",
    "assembly_accession": r"GC[AF]_\d{9}\.\d+",
    "cncb_project_accession": r"PRJCA\d+",
    "cncb_biosample_accession": r"SAMC\d+",
    "cncb_study_accession": r"CRA\d+",
    "cncb_experiment_accession": r"CRX\d+",
    "cncb_run_accession": r"CRR\d+",
}
DOI = r"^10\.\d{4,9}/\S+$"
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: The order in which a bare string's type is tried.
GUESS_ORDER = ("cncb_project_accession", "bioproject_accession", "cncb_biosample_accession", "biosample_accession", "sra_submission_accession", "ena_study_accession", "sra_study_accession", "sra_sample_accession", "sra_experiment_accession", "sra_run_accession", "sra_analysis_accession", "assembly_accession", "cncb_study_accession", "cncb_experiment_accession", "cncb_run_accession")


def doi(raw: Column) -> Column:
    """Lower case, without resolver prefix, link artefact and outer slashes; null if it isn't a DOI."""
    bare = F.regexp_replace(F.trim(raw), r"(?i)^(https?://(dx\.)?doi\.org/|doi:)", "")
    bare = F.regexp_replace(bare, r"(?i)(open_in_new|external\s+link|external-link)$", "")
    bare = F.lower(F.regexp_replace(F.trim(bare), "^/+|/+$", ""))
    return F.when(bare.rlike(DOI), bare)


def normalise(kind: Column, raw: Column) -> Column:
    """The normal form for the type; null where the value doesn't fit it; other types are only trimmed."""

    def normal(x: Column) -> Column:
        k, v = x["kind"], x["raw"]
        upper, lower = F.upper(v), F.lower(v)
        pmid = F.regexp_replace(v, r"(?i)^pmid:?\s*", "")
        pmcid = F.when(upper.startswith("PMC"), upper).otherwise(F.concat(F.lit("PMC"), upper))
        out = F.when(k.isin("doi", "dataset_doi"), doi(v))
        out = out.when(k == "pmid", F.when(pmid.rlike(r"^\d+$"), pmid)).when(k == "pmcid", F.when(pmcid.rlike(r"^PMC\d+$"), pmcid))
        out = out.when(k.isin("gbif_dataset_key", "obis_dataset_uuid"), F.when(lower.rlike(UUID), lower))
        for name, pattern in ACCESSIONS.items():
            out = out.when(k == name, F.when(upper.rlike(f"^{pattern}$"), upper))
        return out.otherwise(v)

    return bound(F.struct(kind.alias("kind"), F.trim(raw).alias("raw")), normal)


def guess(raw: Column) -> Column:
    """The type of a bare identifier; null rather than a wrong guess."""

    def kind(v: Column) -> Column:
        out = None
        for name in GUESS_ORDER:
            hit = v.rlike(f"(?i)^{ACCESSIONS[name]}$")
            out = F.when(hit, name) if out is None else out.when(hit, name)
        bare = F.regexp_replace(F.regexp_replace(v, r"(?i)^(https?://(dx\.)?doi\.org/|doi:)", ""), "^/+|/+$", "")
        return out.when(v.rlike(r"(?i)^PMC\d+$"), "pmcid").when(bare.rlike(DOI), "doi").when(v.rlike("(?i)^https?://"), "url").when(v.rlike(r"^\d+$"), "pmid")

    return bound(F.trim(raw), kind)


#: Accessions as they stand in running text, in the order in which they are looked for.
IN_TEXT = {
    "cncb_project_accession": r"PRJCA\d+",
    "bioproject_accession": r"PRJ(?:NA|EB|DB)\d+",
    "cncb_biosample_accession": r"SAMC\d+",
    "biosample_accession": r"SAM(?:N|D|EA)\d+",
    "sra_submission_accession": r"(?:SRA|ERA|DRA)\d+",
    "sra_study_accession": r"(?:SRP|ERP|DRP)\d+",
    "sra_sample_accession": r"(?:SRS|ERS|DRS)\d+",
    "sra_experiment_accession": r"(?:SRX|ERX|DRX)\d+",
    "sra_run_accession": r"(?:SRR|ERR|DRR)\d+",
    "sra_analysis_accession": r"(?:SRZ|ERZ|DRZ)\d+",
    "assembly_accession": r"GC[AF]_\d{9}\.\d+",
    "cncb_study_accession": r"CRA\d+",
    "cncb_experiment_accession": r"CRX\d+",
    "cncb_run_accession": r"CRR\d+",
}
RANGES = {"sra_sample_accession": "SRS|ERS|DRS", "sra_run_accession": "SRR|ERR|DRR"}
LONGEST_RANGE = 500


def archive(accession: Column, kind: Column) -> Column:
    v = F.upper(accession)
    starts = lambda *p: v.rlike("^(" + "|".join(p) + ")")
    return (
        F.when(kind.startswith("cncb_"), "CNCB")
        .when(kind == "assembly_accession", F.when(v.startswith("GCF_"), "NCBI").otherwise("INSDC"))
        .when(starts("PRJDB", "SAMD", "DR[APSXRZ]"), "DDBJ")
        .when(starts("PRJEB", "SAMEA", "ER[APSXRZ]"), "ENA")
        .when(starts("PRJNA", "SAMN", "SR[APSXRZ]"), "NCBI")
        .otherwise("unknown")
    )


def accessions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, accession, identifier_type, archive): each accession of a text once, ranges of up to 500 written out; key names a row.

    A range takes its accessions' zero padding from its first; a longer or falling one isn't expanded, and its ends are
    found as single accessions. One scan of the texts, and no shuffle.
    """
    found = lambda values, kind: F.transform(values, lambda v: F.struct(v.alias("accession"), F.lit(kind).alias("identifier_type")))
    number = lambda c: c.try_cast("decimal(38,0)")
    digits = lambda n: n.cast("decimal(38,0)").cast("string")

    def ends(pattern: str) -> Callable[[Column], Column]:
        at = lambda m, i: F.regexp_extract(m, pattern, i)
        return lambda m: F.struct(m.alias("whole"), F.upper(at(m, 1)).alias("letters"), at(m, 2).alias("a"), number(at(m, 2)).alias("lo"), number(at(m, 3)).alias("hi"))

    def written(m: Column) -> Column:
        steps = F.sequence(F.lit(0), (m["hi"] - m["lo"]).cast("int"))
        return F.transform(steps, lambda i: F.concat(m["letters"], F.lpad(digits(m["lo"] + i), F.greatest(F.length(m["a"]), F.length(digits(m["lo"] + i))), F.lit("0"))))

    parts, masked = [], F.col(text)
    for kind, letters in RANGES.items():
        pattern = rf"(?i)\b({letters})(\d+)\s*[-–—]\s*(?:{letters})?(\d+)\b"
        each = F.transform(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), ends(pattern))
        fits = F.filter(each, lambda m: (m["hi"] >= m["lo"]) & (m["hi"] - m["lo"] < LONGEST_RANGE))
        parts.append(found(F.flatten(F.transform(fits, written)), kind))
        masked = F.aggregate(fits, masked, lambda acc, m: F.replace(acc, m["whole"], F.lit(" ")))
    single = bound(F.upper(masked), lambda t: F.flatten(F.array(*(found(F.regexp_extract_all(t, F.lit(rf"\b{p}\b"), F.lit(0)), kind) for kind, p in IN_TEXT.items()))))
    each = docs.select(key, F.explode(F.array_distinct(F.concat(*parts, single))).alias("f")).select(key, "f.accession", "f.identifier_type")
    return each.withColumn("archive", archive(F.col("accession"), F.col("identifier_type")))

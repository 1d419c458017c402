"""Facts from landed repository payloads: JSON records to long rows, file listings, nested walks, and a page-wise reader."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: By source, the JSON path of each field; add a source by adding its paths.
FIELDS = {
    "crossref": {"doi": "$.DOI", "title": "$.title[0]", "container_title": "$.container-title[0]", "publisher": "$.publisher", "publication_year": "$.issued.date-parts[0][0]", "license": "$.license", "type": "$.type"},
    "europe_pmc": {"doi": "$.doi", "pmid": "$.pmid", "pmcid": "$.pmcid", "title": "$.title", "container_title": "$.journalTitle", "publication_year": "$.pubYear", "open_access": "$.isOpenAccess"},
    "openalex": {"doi": "$.doi", "openalex_id": "$.id", "title": "$.display_name", "publication_year": "$.publication_year", "open_access": "$.open_access.is_oa", "type": "$.type"},
    "datacite": {"doi": "$.data.attributes.doi", "title": "$.data.attributes.titles[0].title", "publisher": "$.data.attributes.publisher", "publication_year": "$.data.attributes.publicationYear"},
    "obis": {"title": "$.results[0].title", "dataset_uuid": "$.results[0].id", "records": "$.results[0].statistics.Occurrence", "license": "$.results[0].intellectualrights"},
    "gbif": {"title": "$.title", "doi": "$.doi", "dataset_key": "$.key", "license": "$.license", "type": "$.type"},
    "pangaea": {"title": "$.name", "doi": "$.identifier", "license": "$.license", "publication_year": "$.datePublished"},
    "bcodmo": {"title": "$.name", "doi": "$.identifier", "license": "$.license"},
    "zenodo": {"doi": "$.doi", "title": "$.metadata.title", "publication_date": "$.metadata.publication_date", "license": "$.metadata.license.id"},
    "dryad": {"doi": "$.identifier", "title": "$.title", "license": "$.license"},
    "figshare": {"doi": "$.doi", "title": "$.title", "license": "$.license.name"},
    "osf": {"title": "$.data.attributes.title", "publication_date": "$.data.attributes.date_created"},
}
#: By source, the array of files and the paths of name and size in it.
LISTINGS = {"zenodo": ("$.files", "$.key", "$.size"), "dryad": ("$._embedded.stash:files", "$.path", "$.size"), "figshare": ("$.files", "$.name", "$.size"), "osf": ("$.data", "$.attributes.name", "$.attributes.size")}


def facts(payloads: DataFrame, source: str, key: str = "payload_id", body: str = "body") -> DataFrame:
    """(key, field, value) of a source's payloads; missing fields give no row."""
    paths = FIELDS[source]
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("field"), F.get_json_object(body, p).alias("value")) for k, p in paths.items())))
    return payloads.select(key, pairs.alias("f")).select(key, "f.field", "f.value").where("value IS NOT NULL AND value <> ''")


def listing(payloads: DataFrame, source: str, key: str = "payload_id", body: str = "body") -> DataFrame:
    """(key, name, size_bytes) of a repository's files; nothing is downloaded."""
    files, name, size = LISTINGS[source]
    each = payloads.select(key, F.explode(F.from_json(F.get_json_object(body, files), "array<string>")).alias("f"))
    return each.select(key, F.get_json_object("f", name).alias("name"), F.get_json_object("f", size).try_cast("long").alias("size_bytes"))


def run_facts(rows: DataFrame, fields: list[str], key: str = "run_accession") -> DataFrame:
    """Report rows to long facts keyed by run, experiment (accession, library name, else internal:ena:<run>) and field."""
    experiment = F.coalesce(F.nullif("experiment_accession", F.lit("")), F.nullif("library_name", F.lit("")), F.concat(F.lit("internal:ena:"), F.col(key)))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields)))
    return rows.select(key, experiment.alias("experiment"), pairs.alias("f")).select(key, "experiment", "f.field", "f.value").where("value IS NOT NULL AND value <> ''")


def walk(node: object, path: str = "$") -> Iterator[tuple[str, str, str]]:
    """(key, path, value) of every leaf of nested JSON."""
    if isinstance(node, dict):
        for k, v in node.items():
            yield from walk(v, f"{path}.{k}")
    elif isinstance(node, list):
        for i, v in enumerate(node):
            yield from walk(v, f"{path}[{i}]")
    elif node is not None and node != "":
        yield path.rpartition(".")[2].partition("[")[0], path, str(node)


def leaves(body: Column) -> Column:
    """The leaves of a JSON text, array<struct<key, path, value>>; none for text that isn't JSON. An Arrow-batched UDF:
    no built-in walks JSON of unknown shape."""
    def of(s: pd.Series) -> pd.Series:
        def one(x: str) -> list:
            try:
                return [dict(zip(("key", "path", "value"), t, strict=True)) for t in walk(json.loads(x))]
            except (TypeError, ValueError):
                return []

        return s.map(one)

    return F.pandas_udf(of, "array<struct<key:string,path:string,value:string>>")(body)


class PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options.get("paths", "").split(",") if p]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value) as f:
            for i, row in enumerate(json.load(f).get("data", [])):
                yield partition.value, i, json.dumps(row, sort_keys=True)


class LandedPages(DataSource):
    """spark.read.format("landed_pages").option("paths", "a.json,b.json"): records of landed result pages, a page a partition.
    Pages lie where every executor can open them."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "page string, position int, body string"

    def reader(self, schema) -> PageReader:  # noqa: ANN001
        return PageReader(self.options)

"""What a source of records must offer, the registry of sources, and landed responses as the cache of what was fetched.

Records lie in a bronze table (url_key, url, status, body, fetched_at). Reading it is the cache; only requests that it lacks
are fetched, by a transport that the caller gives, with limits on rate and retries. Tests land responses and use no network.
"""

from __future__ import annotations

import hashlib
import time
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import archives, payloads

BRONZE = "url_key string, url string, status int, body string, attempts int"


def url_key(url: Column) -> Column:
    return F.sha2(url, 256)


class Adapter(ABC):
    """A source: which of the landed payloads are its own, and the facts and related identifiers that they give.

    payloads have payload_id, source, identifier, body, fetched_at; facts come as payload_id, field, value; related
    identifiers as payload_id, identifier_type, value; the watermark as the time of the last fetch.
    """

    name: str

    def records(self, landed: DataFrame) -> DataFrame:
        return landed.where(F.col("source") == self.name)

    def search(self, landed: DataFrame, words: str) -> DataFrame:
        """Landed records whose body holds all the words, case aside."""
        found = self.records(landed)
        for w in words.split():
            found = found.where(F.contains(F.lower("body"), F.lit(w.lower())))
        return found

    def fetch(self, landed: DataFrame, wanted: DataFrame) -> DataFrame:
        """The last landed record of each wanted identifier."""
        mine = self.records(landed).join(wanted.select("identifier").distinct(), "identifier", "left_semi")
        return mine.groupBy("identifier").agg(F.max_by(F.struct(*mine.columns), F.struct("fetched_at", "payload_id")).alias("r")).select("r.*")

    @abstractmethod
    def facts(self, landed: DataFrame) -> DataFrame: ...

    def related(self, landed: DataFrame) -> DataFrame:
        """Identifiers among the facts: fields that are named as identifiers are."""
        kinds = ("doi", "pmid", "pmcid", "openalex_id", "dataset_uuid", "dataset_key", "accession")
        return self.facts(landed).where(F.col("field").isin(*kinds)).select("payload_id", F.col("field").alias("identifier_type"), "value").distinct()

    def watermark(self, landed: DataFrame) -> DataFrame:
        return self.records(landed).agg(F.max("fetched_at").alias("last_fetched"))


class JsonAdapter(Adapter):
    """A source whose fields are paths in JSON records."""

    def __init__(self, name: str) -> None:
        self.name = name

    def facts(self, landed: DataFrame) -> DataFrame:
        return payloads.facts(self.records(landed), self.name)


class ProjectAdapter(Adapter):
    name = "ncbi_bioproject"

    def facts(self, landed: DataFrame) -> DataFrame:
        got = archives.project_facts(self.records(landed))
        return got.select("payload_id", "field", "value").unionByName(got.select("payload_id", F.lit("accession").alias("field"), F.col("accession").alias("value")).distinct())


class SampleAdapter(Adapter):
    name = "ncbi_biosample"

    def facts(self, landed: DataFrame) -> DataFrame:
        records = archives.samples(self.records(landed))
        got = archives.sample_facts(records)
        return records.select("payload_id", "accession").join(got, "accession").select("payload_id", "field", "value")


#: Sources by name; add to it to extend what can be read.
ADAPTERS: dict[str, Adapter] = {n: JsonAdapter(n) for n in payloads.FIELDS} | {a.name: a for a in (ProjectAdapter(), SampleAdapter())}


def all_facts(landed: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(source, payload_id, field, value) of every adapter's records."""
    out = None
    for n in names or list(ADAPTERS):
        got = ADAPTERS[n].facts(landed).select(F.lit(n).alias("source"), "payload_id", "field", "value")
        out = got if out is None else out.unionByName(got)
    return out


def missing(requests: DataFrame, bronze: DataFrame) -> DataFrame:
    """(url_key, url): requests (url) that have no landed answer; failed answers are asked for again."""
    wanted = requests.select("url").distinct().select(url_key(F.col("url")).alias("url_key"), "url")
    return wanted.join(bronze.where("status = 200").select("url_key"), "url_key", "left_anti")


@dataclass(frozen=True)
class Limits:
    """Attempts, the first and longest wait between them in seconds, and requests a second of one task."""

    attempts: int = 4
    first_wait: float = 1.0
    longest_wait: float = 30.0
    per_second: float = 3.0

    def wait(self, attempt: int) -> float:
        return min(self.first_wait * 2 ** (attempt - 1), self.longest_wait)


def again(status: int) -> bool:
    """Whether an answer is worth another attempt: none (0: a timeout), too many requests, or a server's error."""
    return status in (0, 429) or status >= 500


def fetch(wanted: DataFrame, transport: Callable[[str], tuple[int, str]], limits: Limits = Limits(), tasks: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Bronze rows for missing(): transport is called in at most `tasks` tasks, each within its limits. Write the result before
    it is read twice: each read fetches again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for url in b.column("url").to_pylist():
                for attempt in range(1, limits.attempts + 1):
                    sleep(1 / limits.per_second if attempt == 1 else limits.wait(attempt - 1))
                    status, body = transport(url)
                    if not again(status):
                        break
                rows.append((hashlib.sha256(url.encode()).hexdigest(), url, status, body if status == 200 else None, attempt))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32()), strict=True)], ["url_key", "url", "status", "body", "attempts"])

    return wanted.select("url_key", "url").repartition(tasks).mapInArrow(run, BRONZE)


def landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)

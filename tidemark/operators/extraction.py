"""Model-assisted extraction by contract: pluggable backends, candidate selection, verification, and fallbacks."""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.values import some, squeezed
from tidemark.operators.predicates import absent, quoted
from tidemark.shared import materialise, ship


class Backend(ABC):
    """Answers prompts; instances are sent to the executors, so they hold no connections."""

    label = "backend"

    @abstractmethod
    def generate(self, prompt: str) -> str: ...

    def generate_json(self, prompt: str, retries: int = 2) -> object | None:
        """The parsed answer; after an unreadable one the prompt is repeated with a request for JSON, `retries` times at most."""
        ask = prompt
        for _ in range(retries + 1):
            got = parse(self.generate(ask))
            if got is not None:
                return got
            ask = f"{prompt}\n\nAnswer with JSON only."
        return None


class Mock(Backend):
    """Answers by the first key that the prompt contains."""

    label = "mock"

    def __init__(self, answers: dict[str, str], default: str = "[]") -> None:
        self.answers, self.default = answers, default

    def generate(self, prompt: str) -> str:
        return next((v for k, v in self.answers.items() if k in prompt), self.default)


class Disabled(Backend):
    label = "disabled"

    def generate(self, prompt: str) -> str:
        raise RuntimeError("model calls are disabled")


def parse(text: str) -> object | None:
    """JSON with or without a code fence; of a list that is cut off, the items before the cut."""
    lines = text.strip().splitlines()
    if lines and lines[0].startswith("```"):
        lines = lines[1 : -1 if lines[-1].startswith("```") else None]
    body = "\n".join(lines).strip()
    try:
        return json.loads(body)
    except ValueError:
        pass
    items, at, read = [], 1, json.JSONDecoder()
    while body.startswith("[") and at < len(body):
        at += len(body[at:]) - len(body[at:].lstrip(" \t\r\n,"))
        try:
            item, at = read.raw_decode(body, at)
        except ValueError:
            break
        items.append(item)
    return items or None


FACTS = "section_id string, fact_type string, value string, evidence_ids array<string>"


def segmented(sections: DataFrame, key: str, parts: Column) -> DataFrame:
    """(key, segment_id, text): the parts of a section as <key>.P001, <key>.P002, ...; numbers above 999 are longer."""
    rows = sections.select(key, F.posexplode(parts).alias("pos", "text"))
    number = (F.col("pos") + 1).cast("string")
    return rows.select(key, F.concat(F.col(key).cast("string"), F.lit(".P"), F.lpad(number, F.greatest(F.lit(3), F.length(number)), F.lit("0"))).alias("segment_id"), "text")


def ask(prompts: DataFrame, backend: Backend) -> DataFrame:
    """What the backend answers to (section_id, prompt): its facts, unchecked."""
    ship(prompts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, prompt in zip(b["section_id"], b["prompt"], strict=True):
                got = backend.generate_json(prompt)
                facts = got if isinstance(got, list) else got.get("facts", []) if isinstance(got, dict) else []
                for f in facts:
                    if isinstance(f, dict):
                        ids = f.get("evidence_id", f.get("evidence_ids")) or []
                        out.append((str(key), str(f.get("fact_type", "")), str(f.get("value", "")), [ids] if isinstance(ids, str) else [str(x) for x in ids]))
            yield pd.DataFrame(out, columns=["section_id", "fact_type", "value", "evidence_ids"])

    return prompts.select(F.col("section_id").cast("string"), "prompt").mapInPandas(run, FACTS)


def verified(facts: DataFrame, segments: DataFrame, allowed: list[str]) -> DataFrame:
    """Facts of an allowed type with a real value whose evidence is a segment of their section, each once; the evidence's text
    is the quote."""
    rows = facts.where(F.col("fact_type").isin(*allowed) & ~absent(F.col("value"))).withColumn("segment_id", F.explode("evidence_ids"))
    hit = rows.join(segments.select(F.col("section_id").cast("string").alias("section_id"), "segment_id", "text"), ["section_id", "segment_id"])
    return hit.groupBy("section_id", "fact_type", "value").agg(F.array_join(F.array_sort(F.collect_set("segment_id")), ",").alias("evidence"), F.min_by("text", "segment_id").alias("quote"))


def extract(sections: DataFrame, parts: Column, backend: Backend, allowed: list[str], question: str) -> DataFrame:
    """Verified facts of every section (section_id); sections for which the first pass gives none are asked once more. The first
    pass is written, so no section is asked twice for it, and both branches see one answer."""
    segments = segmented(sections, "section_id", parts)
    body = segments.groupBy("section_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_id", "text"))), lambda s: F.concat(s["segment_id"], F.lit(": "), s["text"])), "\n").alias("body"))
    answers = materialise(ask(body.select("section_id", F.concat(F.lit(f"{question}\n"), "body").alias("prompt")), backend), "model-answers")
    first = verified(answers, segments, allowed)
    rest = body.withColumn("section_id", F.col("section_id").cast("string")).join(first.select("section_id").distinct(), "section_id", "left_anti")
    again = verified(ask(rest.select("section_id", F.concat(F.lit(f"[recall] {question}\n"), "body").alias("prompt")), backend), segments, allowed)
    return first.unionByName(again)


def candidates(sentences: DataFrame, key: str, cue: str, most: int = 40) -> DataFrame:
    """The first `most` sentences of a text that match a cue (the cap is the prompt's), numbered from 1."""
    rows = sentences.where(F.col("sentence").rlike(cue)).withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("pos")))
    return rows.where(F.col("n") <= most)


def judged(studies: DataFrame, answers: DataFrame, allowed: list[str] | None, fallback: str = "not found") -> DataFrame:
    """A field's value by study: the first allowed answer, else the fallback. answers: study_id, position, value."""
    ok = answers.where(some(F.col("value")).isNotNull() & ~absent(F.col("value")))
    if allowed:
        ok = ok.where(F.lower(F.trim("value")).isin(*map(str.lower, allowed)))
    best = ok.groupBy("study_id").agg(F.min_by(F.trim("value"), F.struct("position", "value")).alias("value"))
    return studies.select("study_id").join(best, "study_id", "left").select("study_id", F.coalesce("value", F.lit(fallback)).alias("value"))


def to_verify(facts: DataFrame, done: DataFrame) -> DataFrame:
    """Explicit facts that a model extracted with a quote, and that no verifier has judged yet."""
    mine = facts.where((F.col("support_type") == "explicit") & (F.col("extraction_method") == "llm_text_extraction") & some(F.col("evidence_quote")).isNotNull())
    return mine.join(done.select("fact_id"), "fact_id", "left_anti")


def corrections(values: DataFrame, elevation: DataFrame) -> DataFrame:
    """Depths that only repeat a positive elevation: to be cleared, each with its audit row. values: study_id, entity_id, value;
    elevation: the same."""
    e = elevation.select("study_id", "entity_id", F.col("value").try_cast("double").alias("e"))
    hit = values.join(e, ["study_id", "entity_id"]).where((F.col("value").try_cast("double") == F.col("e")) & (F.col("e") > 0))
    return hit.select("study_id", "entity_id", F.col("value").alias("old_value"), F.lit(None).cast("string").alias("new_value"), F.lit("depth repeats elevation").alias("reason"))


def quote_ok(quote: Column, text: Column) -> Column:
    return quoted(squeezed(quote), text)

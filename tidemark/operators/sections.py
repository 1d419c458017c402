"""Model-assisted passes over sections: categories of sentences, terms of their runs, normal forms, and facts of a whole study.

What a model says only counts if it refers to what it was given and to an allowed value; the rest is deterministic.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import some, squeezed
from tidemark.operators.extraction import Backend, ask, segmented
from tidemark.operators.predicates import absent, quoted
from tidemark.operators.texts import runs
from tidemark.shared import materialise


def _prompt(question: str, body: Column) -> Column:
    return F.concat(F.lit(f"{question}\n"), body)


def _listed(rows: DataFrame, key: str, label: str, text: str) -> DataFrame:
    """(section_id, body): the rows of a key as lines "label: text", in the order of their labels."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(label).alias("l"), F.col(text).alias("t")))), lambda r: F.concat(r["l"], F.lit(": "), r["t"]))
    return rows.groupBy(F.col(key).alias("section_id")).agg(F.array_join(lines, "\n").alias("body"))


def categorised(sections: DataFrame, parts: Column, backend: Backend, categories: list[str], gate: str | None = None) -> DataFrame:
    """(section_id, segment_id, text, category): what the backend calls each sentence of a section (section_id); sections that
    don't match `gate` aren't asked for. A category that isn't allowed, or of an unknown sentence, is ignored; of several for a
    sentence the first in the list counts."""
    rows = segmented(sections, "section_id", parts).withColumn("section_id", F.col("section_id").cast("string"))
    body = _listed(rows, "section_id", "segment_id", "text")
    asked = ask((body.where(F.col("body").rlike(gate)) if gate else body).select("section_id", _prompt("Which category is each sentence of? " + ", ".join(categories), F.col("body")).alias("prompt")), backend)
    rank = F.coalesce(*(F.when(F.col("fact_type") == c, i) for i, c in enumerate(categories)))
    told = asked.where(rank.isNotNull()).select("section_id", F.explode("evidence_ids").alias("segment_id"), rank.alias("rank"), "fact_type").groupBy("section_id", "segment_id").agg(F.min_by("fact_type", "rank").alias("category"))
    return materialise(rows.join(told, ["section_id", "segment_id"], "left").select("section_id", "segment_id", "text", "category"), "sentence-categories")


def run_texts(sentences: DataFrame, bridge: int = 2) -> DataFrame:
    """(section_id, run, category, segment_id, text): the sentences of each run of one category, with up to `bridge` untold ones
    inside it."""
    at = sentences.withColumn("pos", F.regexp_extract("segment_id", r"(\d+)$", 1).cast("int"))
    found = runs(at, "section_id", "pos", "category", bridge).select("section_id", F.col("first").alias("a"), F.col("last").alias("b"), F.col("tag").alias("category"))
    inside = at.drop("category").join(found, "section_id").where(F.col("pos").between(F.col("a"), F.col("b")))
    return inside.select("section_id", F.concat_ws("#", "section_id", "a").alias("run"), "category", "segment_id", "text")


def term_facts(run_rows: DataFrame, backend: Backend, terms: dict[str, list[str]], batch_chars: int = 6000) -> tuple[DataFrame, DataFrame]:
    """(run, category, term, value, evidence) of every run's terms, and the leftovers (run, category, segment_id, text).

    A run longer than batch_chars is asked about in batches. A fact counts if its term is one of the category's, its evidence a
    sentence of the run, and its value stands in that sentence. Leftovers are sentences of a run that no fact is from.
    """
    size = F.sum(F.length("text") + 1).over(_by_run())
    rows = run_rows.withColumn("batch", F.concat_ws("#", "run", F.floor((size - 1) / batch_chars)))
    body = _listed(rows, "batch", "segment_id", "text").join(rows.select(F.col("batch").alias("section_id"), "category").distinct(), "section_id")
    wanted = F.create_map(*(F.lit(x) for c, ts in terms.items() for x in (c, ", ".join(ts))))
    prompts = body.where(F.col("category").isin(*terms)).select("section_id", F.concat(F.lit("Which values do these sentences give for "), wanted[F.col("category")], F.lit("?\n"), "body").alias("prompt"))
    asked = materialise(ask(prompts, backend), "model-answers")
    hit = asked.withColumn("segment_id", F.explode("evidence_ids")).join(rows.select(F.col("batch").alias("section_id"), "run", "category", "segment_id", "text"), ["section_id", "segment_id"])
    allowed = F.coalesce(*(F.when(F.col("category") == c, F.col("fact_type").isin(*ts)) for c, ts in terms.items()), F.lit(False))
    good = hit.where(allowed & ~absent(F.col("value")) & quoted(F.col("value"), F.col("text")))
    facts = good.groupBy("run", "category", F.col("fact_type").alias("term"), "value").agg(F.min("segment_id").alias("evidence"))
    left = run_rows.join(good.select("run", "segment_id").distinct(), ["run", "segment_id"], "left_anti").select("run", "category", "segment_id", "text")
    return facts, left


def _by_run():  # noqa: ANN202  a window is made when a session is there
    from pyspark.sql.window import Window

    return Window.partitionBy("run").orderBy("segment_id")


def normalised(values: DataFrame, backend: Backend, vocabulary: list[str]) -> DataFrame:
    """(study_id, value): a study's values in the vocabulary's terms, distinct, in the order in which they first occur. values:
    study_id, position, value. A value that is a term, case aside, is taken as such; the backend is asked once for each of the
    others, and an answer outside the vocabulary is dropped."""
    known = F.create_map(*(F.lit(x) for t in vocabulary for x in (t.lower(), t)))
    rows = values.withColumn("value", squeezed(F.col("value"))).where("value <> ''").withColumn("term", F.try_element_at(known, F.lower("value")))
    others = rows.where("term IS NULL").select(F.col("value").alias("section_id")).distinct()
    asked = ask(others.select("section_id", _prompt("Which of these terms is it? " + ", ".join(vocabulary), F.col("section_id")).alias("prompt")), backend)
    said = asked.select(F.col("section_id").alias("value"), F.try_element_at(known, F.lower(F.trim("value"))).alias("_t")).where("_t IS NOT NULL").groupBy("value").agg(F.min("_t").alias("said"))
    each = rows.join(said, "value", "left").select("study_id", "position", F.coalesce("term", "said").alias("term")).where("term IS NOT NULL")
    first = each.groupBy("study_id", "term").agg(F.min("position").alias("position"))
    return first.groupBy("study_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "term"))), lambda r: r["term"]), " | ").alias("value"))


#: For a fact of the whole study, the titles of the sections that are read, in this order, and how its value is
#: found without a model.
STUDY_FACTS = {
    "study_factor": (("abstract", "introduction", "methods"), None),
    "taxonomic_scope": (("abstract", "methods"), None),
    "rights_holder": (("copyright", "rights", "license"), r"(?i)(?:©|\(c\)|copyright)\s*(?:\d{4})?\s*(?:by\s+)?([^.;\n]{2,80})"),
    "funding_source": (("funding", "acknowledgement", "acknowledgment"), r"(?i)\b(?:funded|supported)\s+by\s+(?:the\s+)?([^.;\n]{2,120})"),
}


def study_facts(sections: DataFrame, backend: Backend | None, field: str, most_chars: int = 6000) -> DataFrame:
    """(study_id, value, method): a fact of each study from the first kind of section that it has, by the backend if that gives
    a value, else by the field's pattern. sections: study_id, position, title, text. Studies without such a section have none."""
    titles, pattern = STUDY_FACTS[field]
    rank = F.coalesce(*(F.when(F.lower("title").contains(t), i) for i, t in enumerate(titles)))
    rows = sections.where(rank.isNotNull()).withColumn("_r", rank)
    best = rows.groupBy("study_id").agg(F.min("_r").alias("_r"))
    text = rows.join(best, ["study_id", "_r"]).groupBy("study_id").agg(F.substring(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda r: r["text"]), "\n"), 1, most_chars).alias("body"))
    found = text.select("study_id", some(F.regexp_extract("body", pattern, 1)).alias("fallback")) if pattern else text.select("study_id", F.lit(None).cast("string").alias("fallback"))
    if backend is not None:
        asked = ask(text.select(F.col("study_id").cast("string").alias("section_id"), _prompt(f"What is the {field}? Answer as a list of facts of type {field}.", F.col("body")).alias("prompt")), backend)
        good = asked.where((F.col("fact_type") == field) & ~absent(F.col("value"))).groupBy("section_id").agg(F.min("value").alias("said"))
        found = found.join(good, F.col("study_id").cast("string") == F.col("section_id"), "left").drop("section_id")
    else:
        found = found.withColumn("said", F.lit(None).cast("string"))
    return found.select("study_id", F.coalesce("said", "fallback").alias("value"), F.when(F.col("said").isNotNull(), "model").otherwise("pattern").alias("method")).where("value IS NOT NULL")


class ByWords(Backend):
    """A mock that answers by patterns: each line "id: text" that matches one gives a fact of its type, with the match's first
    group as the value."""

    label = "words"

    def __init__(self, patterns: dict[str, str]) -> None:
        self.patterns = patterns

    def generate(self, prompt: str) -> str:
        import re

        out = []
        for line in prompt.split("\n")[1:]:
            at, _, text = line.partition(": ")
            for kind, p in self.patterns.items():
                m = re.search(p, text or at)
                if m:
                    out.append({"fact_type": kind, "value": m[1] if m.re.groups else m[0], "evidence_id": at})
        return json.dumps(out)

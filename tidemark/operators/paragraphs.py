"""Paragraphs of a text that may hold facts, and the categories that they are read for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.operators.texts import term_pattern

# How reference lists, captions, table bodies and headings in running text are told.
REFERENCES = r"(?i)^\s*(references|bibliography|literature\s+cited)\s*$"
REFERENCE_ENTRY = r"^\s*\d{1,3}\.\s+[A-Z]"
CAPTION = r"(?i)^\s*(fig(?:ure)?\.?|table)\s*s?\s*\d"
TABLE_BODY = r"(?i)(?:#\s*of\s+(?:quality[-\s]*filtered\s+)?reads|#\s*of\s+OTUs|uniquely\s+mapping\s+to\s+OTUs|mapping\s+efficiency)\b"
METHOD_START = r"(?i)\b(?:DNA\s+was\s+(?:isolated|extracted)|RNA\s+was\s+(?:isolated|extracted)|nucleic\s+acids?\s+were\s+(?:isolated|extracted))\b"
INLINE_HEADING = r"(?<=[.!?])\s+(?:[A-Za-z]{2,}\s+){1,3}(?:[IVXLC]{1,4}|\d{1,4})\s+(?=[A-Z][a-z])"


def without_references(paragraphs: Column) -> Column:
    """The paragraphs before the first that heads a list of references or is an entry of one."""
    marks = F.transform(paragraphs, lambda p: p.rlike(REFERENCES) | p.rlike(REFERENCE_ENTRY))
    at = F.array_position(marks, F.lit(True))
    return F.when(at > 0, F.slice(paragraphs, F.lit(1), at.cast("int") - 1)).otherwise(paragraphs)


def without_table_body(paragraph: Column) -> Column:
    """A paragraph that begins with a table of sequencing figures, from its first sentence on extraction on."""
    at = F.regexp_instr(paragraph, F.lit(METHOD_START))
    return F.when(paragraph.rlike(TABLE_BODY) & (at > 0), F.trim(F.substring(paragraph, at, F.length(paragraph)))).otherwise(paragraph)


def readable(text: Column) -> Column:
    """Paragraphs between blank lines: none from the references on, no captions, no table bodies before methods, and no numbered
    headings that run into a sentence."""
    squeezed = F.transform(F.split(text, r"\n\s*\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    kept = F.filter(without_references(F.filter(squeezed, lambda p: p != "")), lambda p: ~p.rlike(CAPTION))
    cut = F.filter(F.transform(kept, without_table_body), lambda p: p != "")
    return F.transform(cut, lambda p: F.regexp_replace(p, INLINE_HEADING, " "))


def categories(paragraph: Column, terms: dict[str, list[str]]) -> Column:
    """array<string>: the categories of which a paragraph holds a term, in the order given; without any it isn't read."""
    held = (F.when(paragraph.rlike("(?i)(?:" + "|".join(term_pattern(t)[4:] for t in ts) + ")"), F.lit(c)) for c, ts in terms.items())
    return F.filter(F.array(*held), lambda c: c.isNotNull())

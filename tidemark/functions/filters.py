"""Facts on filters in a text on how a sample was processed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What sizes, materials and names are told by, and what must stand near a size.
PORE, PORE_NEAR = r"(?i)\d+(?:\.\d+)?\s*(?:µm|um|micrometers?|microns?)\b", r"(?i)\bpore\b|\bfilt\w*\b"
DIAMETER, DIAMETER_NEAR = r"(?i)(\d+(?:\.\d+)?)\s*mm\b", r"(?i)\bfilter\b|\bdisc\b|\bdisk\b|\bmembrane\b"
MATERIALS = ("cellulose ester", "cellulose", "glass fiber", "nylon", "polyethersulfone", "thermoplastic membrane", "track etched polycarbonate")
NAMES = ("Sterivex", "Millipore", "Whatman", "Nalgene", "Supor", "Durapore")
ACTIVE = r"(?i)\b(?:Sterivex|active(?:ly)?\s+filter|pumped?|pumping|pump|peristaltic|vacuum|suction|pressure|overpressure|pressuri[sz]ed|compressed\s+air|forced\s+through|flow\s*rate|flowrate)\b"
PASSIVE = r"(?i)\bpassive\b|\bsubmerged\b|\bgravity\b"


def near_match(text: Column, pattern: str, near: str, group: int, reach: int = 40) -> Column:
    """The first match's group, if `near` matches within `reach` characters around the match."""
    at, hit = F.regexp_instr(text, F.lit(pattern)), F.regexp_extract(text, pattern, 0)
    start = F.greatest(at - reach, F.lit(1))
    around = F.substring(text, start, at - start + F.length(hit) + reach)
    return F.when((at > 0) & around.rlike(near), F.regexp_extract(text, pattern, group))


def first_word(text: Column, words: tuple[str, ...]) -> Column:
    """The first of the words, in their order, that the text holds as a word."""
    return F.coalesce(*(F.when(text.rlike(rf"(?i)\b{w}\b"), F.lit(w)) for w in words))


def filter_facts(text: Column) -> Column:
    """struct<size_frac, filter_diameter, filter_material, filter_name, filter_passive_active_0_1>: a pore size near a pore or
    filter, a diameter near a filter or disc, the first known material and name, and 1 for active filtration, 0 for passive or
    if anything else on a filter is told."""
    size, diameter = near_match(text, PORE, PORE_NEAR, 0), near_match(text, DIAMETER, DIAMETER_NEAR, 1)
    material, name = first_word(text, MATERIALS), first_word(text, NAMES)
    told = F.coalesce(size, diameter, material, name).isNotNull()
    active = F.when(text.rlike(ACTIVE), "1").when(text.rlike(PASSIVE) | told, "0")
    return F.struct(size.alias("size_frac"), diameter.alias("filter_diameter"), material.alias("filter_material"), name.alias("filter_name"), active.alias("filter_passive_active_0_1"))

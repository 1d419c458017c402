"""Value strategies: what a field takes from a sentence. Each gives an array of values; STRATEGIES names them.

collected() folds the sentences of a text into distinct values in reading order. All but phrases() are built-in expressions;
phrases() needs spans that depend on the values found before, so it is an Arrow-batched function over a text's sentences.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.texts import term_pattern

# The vocabularies and phrase patterns by which fields are recognised; results depend on them as they stand.
KITS = (
    r"(?i)\bMiSeq\s+Reagent\s+Kit(?:\s+v\d+)?\b",
    r"(?i)\bNextera\s+XT\s+Index\s+Kit(?:\s*\([^)]+\))?",
    r"(?i)\bTitanium\s+chemistry\b",
    r"(?i)\b(?:v2|v3)\s+chemistry\b",
    r"\bTruSeq\s+\w+(?:\s+\w+){0,3}\s+[Kk]it\b",
    r"\b[A-Z][A-Za-z0-9-]*(?:\s+[A-Z0-9][A-Za-z0-9-]*){0,5}\s+(?:Index|Library|Sequencing|Reagent|Amplicon|Barcode)\s+[Kk]it(?:\s*\([^)]+\))?",
)
THERMOCYCLERS = (
    r"(?i)\bDNA\s+Engine\s+Tetrad\s*2\s+Thermal\s+Cycler\b",
    r"(?i)\b[A-Z][A-Za-z0-9-]*(?:\s+[A-Z0-9][A-Za-z0-9-]*){0,5}\s+(?:Thermal\s+Cycler|thermocycler|Cycler|PCR\s+System)\b(?:\s*\([^)]+\))?",
)
TOOL_VERSION = r"(?:\s+(?:v(?:ersion)?\.?\s*)?\d+(?:\.\d+)*)?\b"
TRIM_TOOLS = {"adapter": ("SeqPrep", "Trimmomatic"), "length_quality": ("Trimmomatic", "USEARCH")}
TRIM_CUES = {
    "adapter": r"(?i)\badapters?\b|\bILLUMINACLIP\b|\bbarcodes?\b|\bprimers?\s+(?:removal|sequences)\b",
    "length_quality": r"(?i)\bquality\b|\bshort\s+reads?\b|\blength\b|\bMINLEN\b|\bLEADING\b|\bTRAILING\b|\bSLIDINGWINDOW\b",
}
LENGTH_UNIT = r"(bp|base\s+pairs?|bases?|nt|nucleotides?)?\b"
LENGTH_GUARD = r"(?i)minlen|\bTrimmomatic\b|\btrim(?:med|ming)?\s+(?:reads?\s+)?to\s+\d+|\breads?\s+(?:that\s+)?(?:became|become|were|are)?\s*shorter\s+than\s+\d+"
LENGTHS = (
    r"(?i)\bMINLEN\s*:\s*(\d+)()\b",
    rf"(?i)\breads?\s+(?:that\s+)?(?:became|become|were|are)?\s*shorter\s+than\s+(\d+)\s*{LENGTH_UNIT}[^.]{{0,120}}\bdiscard(?:ed|ing)?\b",
    rf"(?i)\b(?:remov(?:e|ed|ing)|discard(?:ed|ing)?|filter(?:ed|ing)?)\s+(?:all\s+)?reads?\s+(?:shorter\s+than|below|less\s+than|under)\s+(\d+)\s*{LENGTH_UNIT}",
    rf"(?i)\bminimum\s+read\s+length\s+(?:of|=|:)?\s*(\d+)\s*{LENGTH_UNIT}",
    rf"(?i)\btrim(?:med|ming)?\s+(?:reads?\s+)?to\s+(\d+)\s*{LENGTH_UNIT}",
)
BOTH_GENES = r"(?i)\b16S\s+(?:and|/|,)\s+18S\s+(?:SSU\s+rRNA|rRNA\s+SSU)\b"
GENE_TERMS = ("16S rRNA SSU", "18S rRNA SSU", "16S SSU rRNA", "18S SSU rRNA", "16S rRNA", "18S rRNA", "16S", "18S", "COI", "ITS", "12S", "23S", "rbcL", "nifH", "amoA")
PRIMER_SEQUENCE = r"(?i)\b5\s*[′'’`]\s*([ACGTRYSWKMBDHVN\s*]+?)\s*3\s*[′'’`]"
PRIMER_NAMES = (r"(?i)\b([A-Za-z0-9][A-Za-z0-9_.-]{1,50})\s+(?:forward|reverse)\s+primers?\b", r"(?i)\bmatches\s+([A-Za-z0-9][A-Za-z0-9_.-]{1,50})\s+primers?\b")
NOT_PRIMERS = ("unique", "universal", "indexed", "tailed")
MIXTURE = r"(?i)\b(?:PCR|qPCR|reaction)\s+mix(?:ture)?\b|\bmaster\s*mix\b|\bpolymerase\s+chain\s+reaction\s*\(?PCR\)?\s+mixture\b"
POLYMERASE = r"(?i)\b(?:Taq|Phusion|Pfu|ExTaq|KAPA|Q5|GoTaq|Platinum|AmpliTaq|HotStar(?:Taq)?|iProof)\b|\b\w+\s+(?:DNA\s+)?polymerase\b"
BUFFER = r"(?i)\bbuffer\b|\bdNTPs?\b"
BRANDS = r"(?i)\bmaster\s*mix\b|\bTaqMan\b|\bSYBR\b|\bLuna\b|\bPowerUp\b|\bQuantiTect\b|\bSsoAdvanced\b"
CYCLING = r"(?i)\s*,?\s+(?:and\s+)?(?:was|were)\s+amplified\s+using\b|\s*,?\s+with\s+a\s+cycling\s+profile\b|\s*,?\s+with\s+cycling\s+conditions\b|\s*,?\s+under\s+(?:the\s+)?(?:following\s+)?cycling\s+conditions\b|\s+PCR\s+conditions\s+were\b"
ASSAYS = (
    ("targeted", r"(?i)\b(?:quantitative\s+PCR|digital\s+PCR|targeted\s+assay|hydrolysis\s+probes?|qPCR|ddPCR|TaqMan)\b"),
    ("metabarcoding", r"(?i)\b(?:metabarcoding|community\s+profiling|amplicon\s+sequencing|biodiversity\s+assessment|high[-\s]+throughput\s+sequencing|multiple\s+taxa|universal\s+primers|(?-i:HTS))\b"),
)


def _none() -> Column:
    return F.expr("cast(array() as array<string>)")


def _only(condition: Column, values: Column) -> Column:
    return F.when(condition, values).otherwise(_none())


def _some(*values: Column) -> Column:
    return F.filter(F.array(*values), lambda x: x.isNotNull() & (x != ""))


def whole_sentence(sentence: Column, terms: list[str]) -> Column:
    """The sentence, if it holds any of the terms."""
    return _only(sentence.rlike("(?i)(?:" + "|".join(term_pattern(t)[4:] for t in terms) + ")"), F.array(F.trim(sentence)))


def labels(sentence: Column, named: tuple[tuple[str, str], ...]) -> Column:
    """The labels whose pattern the sentence matches, in the order of the list."""
    return _some(*(F.when(sentence.rlike(p), F.lit(k)) for k, p in named))


def _window(sentence: Column, direction: str) -> Column:
    """What a sentence says of a direction's primer: up to, or from, the words "reverse primer"; null if nothing."""
    at = F.regexp_instr(sentence, F.lit(r"(?i)\breverse\s+primers?\b"))
    letter = direction[0].upper()
    says = lambda c: c.rlike(rf"(?i)\b{direction}\s+primers?\b|\bSP[-_]?{letter}\b|\b\d{{1,2}}S\s+rRNA\s+{letter}\b")
    part = F.when(at == 0, sentence).otherwise(F.substring(sentence, F.lit(1), at - 1) if direction == "forward" else F.substring(sentence, at, F.length(sentence)))
    return F.when(sentence.rlike("(?i)primer") & says(part), part)


def primer_sequences(sentence: Column, direction: str) -> Column:
    """Sequences between 5' and 3', as IUPAC letters."""
    hits = F.regexp_extract_all(F.coalesce(_window(sentence, direction), F.lit("")), F.lit(PRIMER_SEQUENCE), F.lit(1))
    return F.filter(F.transform(hits, lambda x: F.regexp_replace(F.upper(x), "[^ACGTRYSWKMBDHVN]", "")), lambda x: x != "")


def primer_names(sentence: Column, direction: str) -> Column:
    """Names before "forward/reverse primer", those that "matches ... primer" states, and those that end in the direction's letter."""
    part = F.coalesce(_window(sentence, direction), F.lit(""))
    directed = rf"(?i)\b(\d{{1,2}}S\s+rRNA\s+{direction[0].upper()})\b"
    hits = F.concat(*(F.regexp_extract_all(part, F.lit(p), F.lit(1)) for p in (*PRIMER_NAMES, directed)))
    bare = F.transform(hits, lambda x: F.regexp_replace(x, r"^[ .;,]+|[ .;,]+$", ""))
    return F.filter(bare, lambda x: (x != "") & ~F.lower(x).isin(*NOT_PRIMERS))


def mixture(sentence: Column, commercial: bool) -> Column:
    """A sentence on a reaction's mixture, up to its cycling conditions; it is commercial if it names a brand."""
    about = sentence.rlike(MIXTURE) | (sentence.rlike(POLYMERASE) & sentence.rlike(BUFFER))
    stop = F.regexp_instr(sentence, F.lit(CYCLING))
    value = F.when(stop > 0, F.regexp_replace(F.substring(sentence, F.lit(1), stop - 1), r"^[ ,;]+|[ ,;]+$", "")).otherwise(F.trim(sentence))
    return _only(about & (sentence.rlike(BRANDS) == commercial), F.array(value))


def trim_tools(sentence: Column, purpose: str, reach: int = 90) -> Column:
    """Tools, with their versions, whose first mention has a cue of the purpose within `reach` characters."""
    out = []
    for tool in TRIM_TOOLS[purpose]:
        pattern = rf"(?i)\b{tool}{TOOL_VERSION}"
        at, hit = F.regexp_instr(sentence, F.lit(pattern)), F.regexp_extract(sentence, pattern, 0)
        first = F.greatest(at - reach, F.lit(1))
        near = F.substring(sentence, first, at - first + F.length(hit) + reach)
        out.append(F.when((at > 0) & near.rlike(TRIM_CUES[purpose]), hit))
    return _some(*out)


def minimum_length(sentence: Column) -> Column:
    """The least length of reads that are kept, in bp: by the first pattern that fits a sentence on trimming."""
    unit = lambda u: F.when(u.rlike(r"(?i)^(bp|base\s+pairs?|bases?|nt|nucleotides?)?$"), F.lit("bp")).otherwise(F.lower(u))
    hit = F.coalesce(*(F.when(sentence.rlike(p), F.concat_ws(" ", F.regexp_extract(sentence, p, 1), unit(F.regexp_extract(sentence, p, 2)))) for p in LENGTHS))
    return _only(sentence.rlike(LENGTH_GUARD), _some(hit))


def phrases(sentences: Column, patterns: tuple[str, ...]) -> Column:
    """The distinct phrases of a text (an array of sentences) in reading order, pattern by pattern in each sentence. A phrase
    occupies its place for the patterns after it, unless its value was found before."""
    compiled = [re.compile(p) for p in patterns]

    def of(text: list[str] | None) -> list[str]:
        found: dict[str, str] = {}
        for s in text or []:
            taken: list[tuple[int, int]] = []
            for m in (m for p in compiled for m in p.finditer(s)):
                value = m[0].strip(" .;,")
                if value and value.lower() not in found and all(m.end() <= a or b <= m.start() for a, b in taken):
                    found[value.lower()] = value
                    taken.append(m.span())
        return list(found.values())

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(map(of, texts.to_pylist()), pa.list_(pa.string()))

    return run(sentences)


def collected(sentences: DataFrame, key: str, values: Column) -> DataFrame:
    """(key, value, pos, ord): distinct values of a text, equal ones but for case as first written, with where that was.
    sentences: key, pos, sentence; values: an array for each."""
    each = sentences.select(key, "pos", F.posexplode(values).alias("ord", "value"))
    first = each.groupBy(key, F.lower("value").alias("_k")).agg(F.min(F.struct("pos", "ord", "value")).alias("f"))
    return first.select(key, "f.value", "f.pos", "f.ord")


def joined(found: DataFrame, key: str, sep: str = " | ") -> DataFrame:
    """(key, value): the values of collected() as one, in reading order."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "ord", "value")))
    return found.groupBy(key).agg(F.array_join(F.transform(rows, lambda r: r["value"]), sep).alias("value"))


def genes(sentences: DataFrame, key: str, terms: tuple[str, ...] = GENE_TERMS) -> DataFrame:
    """(key, value): a text's target genes. "16S and 18S SSU rRNA" names both genes in full and goes first; of the names of one
    marker the fullest stays (SSU, rRNA, bare), where it was first written."""
    joined_terms = "|".join(term_pattern(t)[4:] for t in sorted(terms, key=lambda t: (-len(t), t)))
    named = collected(sentences, key, F.regexp_extract_all("sentence", F.lit(f"(?i)(?:{joined_terms})"), F.lit(0))).withColumn("late", F.lit(1))
    both = collected(sentences, key, _only(F.col("sentence").rlike(BOTH_GENES), F.array(F.lit("16S rRNA SSU"), F.lit("18S rRNA SSU")))).withColumn("late", F.lit(0))
    low = F.lower("value")
    marker = F.when(low.contains("16s"), "16S").when(low.contains("18s"), "18S")
    rank = F.when(low.contains("ssu"), 3).when(low.contains("rrna"), 2).otherwise(1)
    name = F.when(rank == 3, F.concat(marker, F.lit(" rRNA SSU"))).when(rank == 2, F.concat(marker, F.lit(" rRNA"))).otherwise(marker)
    rows = both.unionByName(named).select(key, F.coalesce(marker, low).alias("kind"), F.when(marker.isNull(), 0).otherwise(rank).alias("rank"), F.coalesce(name, "value").alias("value"), F.struct("late", "pos", "ord").alias("at"))
    best = rows.groupBy(key, "kind").agg(F.min(F.struct((-F.col("rank")).alias("rank"), "at", "value")).alias("b"))
    return best.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b.at", "b.value"))), lambda r: r["value"]), " | ").alias("value"))


#: Strategies by name over a sentence; add to it to extend what fields can ask for.
STRATEGIES: dict[str, Callable[[Column], Column]] = {
    "commercial_mixture": lambda s: mixture(s, True),
    "custom_mixture": lambda s: mixture(s, False),
    "adapter_trim_tool": lambda s: trim_tools(s, "adapter"),
    "length_quality_trim_tool": lambda s: trim_tools(s, "length_quality"),
    "minimum_read_length": minimum_length,
    "forward_primer_name": lambda s: primer_names(s, "forward"),
    "reverse_primer_name": lambda s: primer_names(s, "reverse"),
    "forward_primer_sequence": lambda s: primer_sequences(s, "forward"),
    "reverse_primer_sequence": lambda s: primer_sequences(s, "reverse"),
    "assay_type": lambda s: labels(s, ASSAYS),
}


def by_strategy(sentences: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """(key, field, value) of all fields in one pass over the sentences. fields: field to a strategy's name."""

    def of(field: str, strategy: str) -> Column:
        return F.transform(STRATEGIES[strategy](F.col("sentence")), lambda v, i: F.struct(F.lit(field).alias("field"), i.alias("ord"), v.alias("value")))

    pairs = F.flatten(F.array(*(of(f, s) for f, s in fields.items())))
    each = sentences.select(key, "pos", F.explode(pairs).alias("v")).select(key, "pos", "v.*")
    first = each.groupBy(key, "field", F.lower("value").alias("_k")).agg(F.min(F.struct("pos", "ord", "value")).alias("f"))
    return first.groupBy(key, "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda r: r["value"]), " | ").alias("value"))


def in_context(sentences: DataFrame, key: str, needed: str, foreign: str, own: str) -> DataFrame:
    """Sentences whose neighbourhood (with the one before and after) matches `needed`, and `own` where it matches `foreign`;
    the neighbourhood is column window."""
    at = Window.partitionBy(key).orderBy("pos")
    rows = sentences.withColumn("window", F.concat_ws(" ", F.lag("sentence").over(at), "sentence", F.lead("sentence").over(at)))
    return rows.where(F.col("window").rlike(needed) & (~F.col("window").rlike(foreign) | F.col("window").rlike(own)))

"""Text operators: paragraphs, sections, term and flag matching, sentence runs, page furniture."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.values import squeezed


def paragraphs(text: Column) -> Column:
    """Paragraphs in order, without captions (Figure 1, Table 2) and blank ones."""
    parts = F.transform(F.split(text, r"\n[ \t]*\n|\n"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: (p != "") & ~p.rlike(r"(?i)^(figure|fig\.|table)\s*\d+"))


def sentences(text: Column) -> Column:
    """Sentences in order: split after . ! ? before white space."""
    return F.filter(F.transform(F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\n"), "\n"), lambda s: F.trim(s)), lambda s: s != "")


def posexploded(df: DataFrame, key: str, parts: Column, name: str) -> DataFrame:
    return df.select(key, F.posexplode(parts).alias("pos", name))


def term_pattern(term: str) -> str:
    """A term as a pattern: any white space for a space, a hyphen or white space for a hyphen, on word boundaries."""
    body = re.escape(term).replace(r"\ ", r"\s+").replace(r"\-", r"[-\s]+")
    return rf"(?i)(?<![A-Za-z0-9]){body}(?![A-Za-z0-9])"


def terms_found(text: Column, terms: list[str], sep: str = " | ") -> Column:
    """The terms of a text as first written, longest first where they overlap, each once but for case."""
    joined = "|".join(term_pattern(t)[4:] for t in sorted(terms, key=lambda t: (-len(t), t)))
    hits = F.regexp_extract_all(text, F.lit(f"(?i)(?:{joined})"), F.lit(0))
    none = F.expr("cast(array() as array<string>)")
    once = F.aggregate(hits, none, lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))
    return F.array_join(once, sep)


def flag(text_sentences: Column, positive: str, none: str) -> Column:
    """1 if a sentence matches `positive` and not `none`, 0 if one matches both only, else null."""
    yes = F.exists(text_sentences, lambda s: s.rlike(positive) & ~s.rlike(none))
    no = F.exists(text_sentences, lambda s: s.rlike(positive) & s.rlike(none))
    return F.when(yes, "1").when(no, "0")


def first_sentence_value(text_sentences: Column, needs: str, pattern: str, group: int = 1) -> Column:
    """The group of the first sentence that matches both."""
    hit = F.try_element_at(F.filter(text_sentences, lambda s: s.rlike(needs) & s.rlike(pattern)), F.lit(1))
    return F.regexp_extract(hit, pattern, group)


def context(rows: DataFrame, key: str, order: str, value: str, width: int = 1) -> DataFrame:
    """Each row's value with those of its neighbours."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-width, width)
    return rows.withColumn("context", F.array_join(F.collect_list(value).over(w), " "))


def runs(rows: DataFrame, key: str, order: str, tag: str, bridge: int = 2) -> DataFrame:
    """Runs of rows of one tag with at most `bridge` untagged rows inside: key, run's first and last place, tag, rows."""
    w = Window.partitionBy(key).orderBy(order)
    tagged = rows.where(F.col(tag).isNotNull())
    broken = (F.col(tag) != F.lag(tag).over(w)) | (F.col(order) - F.lag(order).over(w) > bridge + 1)
    islands = tagged.withColumn("_b", F.coalesce(broken.cast("int"), F.lit(1))).withColumn("run", F.sum("_b").over(w))
    return islands.groupBy(key, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.first(tag).alias("tag"), F.count("*").alias("n")).drop("run")


def before_references(rows: DataFrame, key: str, order: str, line: str) -> DataFrame:
    """Rows before the first that is a heading of references."""
    w = Window.partitionBy(key).orderBy(order)
    mark = F.lower(F.trim(F.col(line))).rlike(r"^(references|bibliography|literature cited)\.?$")
    return rows.withColumn("_r", F.max(mark).over(w)).where("NOT _r").drop("_r")


def until_other_heading(rows: DataFrame, key: str, order: str, wanted: Column, heading: Column) -> DataFrame:
    """Rows up to the first heading that isn't wanted once a wanted one has come."""
    w = Window.partitionBy(key).orderBy(order)
    rows = rows.withColumn("_seen", F.max(wanted).over(w)).withColumn("_stop", F.col("_seen") & heading & ~wanted)
    return rows.withColumn("_stopped", F.max("_stop").over(w)).where("_seen AND NOT _stopped").drop("_seen", "_stop", "_stopped")


def budgeted(parts: Column, budget: int, least: int) -> Column:
    """Leading parts within a budget of characters: a part that doesn't fit is cut to what is left, or skipped if that is
    under `least`; later, shorter parts may still fit."""
    start = F.struct(F.lit(budget).alias("left"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        fits, room = F.length(p) <= acc["left"], acc["left"] >= least
        cut = F.when(fits, p).otherwise(F.substring(p, F.lit(1), acc["left"]))
        take = fits | room
        return F.struct(F.when(take, acc["left"] - F.length(cut)).otherwise(acc["left"]).alias("left"), F.when(take, F.concat(acc["out"], F.array(cut))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def chunked(parts: Column, most: int) -> Column:
    """Paragraphs packed in order into chunks of at most `most` characters; a longer paragraph is a chunk of its own."""
    start = F.struct(F.lit("").alias("now"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        joined = F.when(acc["now"] == "", p).otherwise(F.concat(acc["now"], F.lit("\n\n"), p))
        fits = F.length(joined) <= most
        closed = F.when(fits | (acc["now"] == ""), acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["now"])))
        return F.struct(F.when(fits | (acc["now"] == ""), joined).otherwise(p).alias("now"), closed.alias("out"))

    return F.aggregate(parts, start, step, lambda acc: F.when(acc["now"] == "", acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["now"]))))


def furniture(lines: DataFrame, doc: str, page: str, line: str) -> DataFrame:
    """Lines that stand on at least max(3, pages / 3) pages of a document and have 120 characters or fewer."""
    given = lines.select(doc, page, F.trim(F.col(line)).alias("line")).where("line <> '' AND length(line) <= 120").distinct()
    pages = lines.groupBy(doc).agg(F.count_distinct(page).alias("pages"))
    n = given.groupBy(doc, "line").agg(F.count("*").alias("n"))
    return n.join(pages, doc).where(F.col("n") >= F.greatest(F.lit(3), F.floor(F.col("pages") / 3))).select(doc, "line", "n")


def clean_page(text: Column) -> Column:
    """Hyphenated line ends joined, ligatures written out, single spaces, none before punctuation or inside brackets."""
    t = F.regexp_replace(text, r"(\w)-\n(\w)", "$1$2")
    for a, b in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff")):
        t = F.replace(t, F.lit(a), F.lit(b))
    t = squeezed(t)
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\s+([,.;:)\]])", "$1"), r"([(\[])\s+", "$1"), r"\s+", " ")


def text_quality(text: Column) -> Column:
    """Words and spaces per character, less wide gaps by line and joined words."""
    n = F.greatest(F.length(text), F.lit(1))
    words = F.regexp_count(text, F.lit(r"[A-Za-z]{2,}")) / n
    return words + 0.1 * F.regexp_count(text, F.lit(" ")) / n - 0.02 * F.regexp_count(text, F.lit(r" {4,}")) - 0.01 * F.regexp_count(text, F.lit(r"[a-z][A-Z]"))


def is_heading(line: Column, inside_methods: Column) -> Column:
    """A short line without a final stop (unless upper case) that is a known heading or, in methods, a title of 2 to 10 words."""
    v = squeezed(line)
    stop = v.rlike("[.,;:]$") & (v != F.upper(v))
    known = F.lower(v).rlike(r"^(\d+(\.\d+)*\.?\s+)?(abstract|introduction|methods?|materials? and methods|results?|discussion|conclusions?|references|acknowledge?ments|data availability)\.?$")
    titled = v.rlike(r"^[A-Z]\S*(\s+\S+){1,9}$") & inside_methods
    return (F.length(v).between(1, 140)) & ~stop & (known | titled)


def leaf_sections(html: Column) -> Column:
    """Headed blocks of a page: struct<title, text> for each h1 to h3 and what follows it, tags stripped."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>(.*?)(?=<h[1-3]|$)"), F.lit(0))
    strip = lambda c: squeezed(F.regexp_replace(c, r"(?s)<[^>]*>", " "))
    pick = lambda b, i: strip(F.regexp_extract(b, r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>(.*)", i))
    return F.transform(blocks, lambda b: F.struct(pick(b, 1).alias("title"), pick(b, 2).alias("text")))


def plain(html: Column) -> Column:
    return squeezed(F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"(?s)<[^>]*>", " "))

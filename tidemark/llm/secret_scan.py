"""Secret scanning over an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed; only pairs of a blob and a rule version that the ledger lacks are
scanned; findings are joined back to all paths that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, materialise, scratch, text_of


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and non-overlapping; a match counts if its group `group` has `least` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: What may stand around the base64 of a key: white space, quotes, escapes, and the marks of comments,
#: quotations and diffs; never the dashes that begin a next key.
_GAP = r"""(?:[\x20\x09-\x0D"'+,;#*>|/]|-(?!----)|\\[nrt]?)*+"""
_BASE64 = "[A-Za-z0-9+/]"
#: From the BEGIN line to the next END line, with no other BEGIN or END between, whatever the text between looks like. Where
#: that END is missing: headers such as DEK-Info, runs of 20 base64 characters or more, and one run after them if the last
#: isn't padded; without such a run a line of nothing but base64. All loops are possessive, so long texts need no stack.
PRIVATE_KEY = (
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"
    r"(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----"
    rf"""|(?:{_GAP}[A-Za-z]++-[A-Za-z]++:[\x20\x09]*+(?:(?!-----)[^\x20\x09-\x0D"'\\])*+)*+"""
    rf"(?:(?:{_GAP}{_BASE64}{{20,}}+(?!=))++(?:{_GAP}{_BASE64}++={{0,2}}+)?+|{_GAP}{_BASE64}{{20,}}+={{1,2}}+"
    rf"""|["'\x20\x09]*+(?:\r?\n|\\n){_GAP}{_BASE64}++={{0,2}}+(?=["'\x20\x09]*+(?:[\r\n]|$)))?+)"""
)

#: In the order by which spans that start together are listed; the first three are the base.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
    Rule("private_key", PRIVATE_KEY, 0, 1, 2),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,255}", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,250}", 0, 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 20),
)

FOUND = "array<struct<start:int,rank:int,end:int,kind:string>>"
LEDGER = f"blob string, scanned array<string>, found {FOUND}"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's spans in code points: pieces between matches and the matches give every start by a running sum."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    between = F.split(text, rule.pattern, -1)
    parts = F.arrays_zip(F.slice(between, F.lit(1), F.size(matches)).alias("b"), matches.alias("m"), groups.alias("g"))
    empty = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {FOUND})").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["b"])
        end = start + F.length(p["m"])
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(F.length(p["g"]) >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(parts, empty, step, lambda acc: acc["out"])
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), found).otherwise(F.expr(f"cast(array() as {FOUND})"))


def scan(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Bring the ledger up to date with the versions' texts; returns the blobs' findings under these rules (blob, found).

    The ledger is a Parquet table that only grows: a row holds a blob, the rule versions it was scanned by, and what they
    found. Blobs without findings are entered too, so that they aren't scanned again.
    """
    spark = versions.sparkSession
    keys = [r.key for r in rules]
    blobs = versions.select(text_of(text_col).alias("t")).groupBy(F.sha2("t", 256).alias("blob")).agg(F.any_value("t").alias("t"))
    known = ledger(spark, ledger_path)
    if known is None:
        unseen = blobs.withColumn("todo", F.array(*map(F.lit, keys)))
    else:
        seen = known.select("blob", F.explode("scanned").alias("key")).where(F.col("key").isin(keys)).groupBy("blob").agg(F.collect_set("key").alias("seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(F.array(*map(F.lit, keys)), F.coalesce("seen", F.expr("cast(array() as array<string>)")))).where("size(todo) > 0")
    none = F.expr(f"cast(array() as {FOUND})")
    found = F.flatten(F.array(*(F.when(F.array_contains("todo", r.key), spans(F.col("t"), r, i)).otherwise(none) for i, r in enumerate(rules))))
    unseen.select("blob", F.col("todo").alias("scanned"), F.array_sort(found).alias("found")).write.mode("append").parquet(ledger_path)
    hits = ledger(spark, ledger_path).where("size(found) > 0")
    if known is None:
        return hits.select("blob", "found")
    ranks = {r.key: i for i, r in enumerate(rules)}
    each = hits.select("blob", "scanned", F.explode("found").alias("f"))
    now = each.where(F.exists("scanned", lambda k: k.isin(keys) & (F.split_part(k, F.lit("@"), F.lit(1)) == F.col("f.kind"))))
    rank = F.coalesce(*(F.when(F.col("f.kind") == r.kind, F.lit(i)) for i, r in enumerate(rules)), F.lit(len(ranks)))
    again = F.struct(F.col("f.start").alias("start"), rank.alias("rank"), F.col("f.end").alias("end"), F.col("f.kind").alias("kind"))
    return materialise(now.groupBy("blob").agg(F.sort_array(F.collect_set(again)).alias("found")), "secret-found")


def ledger(spark: SparkSession, path: str) -> DataFrame | None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def findings(versions: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Every row of versions with its blob and what was found (columns blob and found, named otherwise if versions has those):
    spans in code points by start, then rule.

    A null text is the empty one; it and texts without secrets get an empty array. Repeated rows and rows that share a text
    get the same spans. An empty table gives no rows. Without a path, the ledger is a new one.
    """
    blob, found = fresh(versions, "blob"), fresh(versions, "found")
    hits = scan(versions, ledger_path or scratch(versions.sparkSession, "secret-ledger"), rules, text_col).select(F.col("blob").alias(blob), F.col("found").alias(found))
    rows = versions.withColumn(blob, F.sha2(text_of(text_col), 256)).join(hits, blob, "left")
    return rows.select(*versions.columns, blob, F.coalesce(found, F.expr(f"cast(array() as {FOUND})")).alias(found))


def digest(versions: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger_path: str | None = None) -> DataFrame:
    """Per row: the id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = findings(versions.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ledger_path)
    told = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        F.col("id").alias(id_col),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(told(F.filter("found", lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
        told(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", length_col: str | None = None, ledger_path: str | None = None) -> DataFrame:
    """docs with every found span replaced, and length_col set to the new length in those; overlapping spans are replaced
    once. Texts without findings, null ones too, stay as they are."""
    rows, found = findings(docs, ledger_path, text_col=text_col), fresh(docs, "found")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        inside = s["end"] <= acc["at"]
        gap = F.substring(F.col(text_col), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        with_mark = F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mark)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(with_mark).alias("out"))

    done = F.aggregate(found, start, step)
    text = F.when(F.size(found) == 0, F.col(text_col)).otherwise(F.concat(done["out"], F.substring(F.col(text_col), done["at"] + 1, F.length(text_col))))
    rows = rows.withColumn(text_col, text)
    if length_col:
        rows = rows.withColumn(length_col, F.when(F.size(found) == 0, F.col(length_col)).otherwise(F.length(text_col)).cast(docs.schema[length_col].dataType))
    return rows.select(*docs.columns)

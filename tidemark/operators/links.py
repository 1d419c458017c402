"""Matching of studies and samples: identifiers, aliases, date and place windows, replicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import tokens
from tidemark.keys import one_many_none


def by_identifier(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """The study of each row's first candidate that is known: candidates (row_id, position, type, value), known (type, value, study_id)."""
    hits = candidates.join(known, ["type", "value"])
    return hits.groupBy("row_id").agg(F.min(F.struct("position", "study_id")).alias("m")).select("row_id", F.col("m.study_id").alias("study_id"))


def aliases(alias: DataFrame, canonical: DataFrame) -> DataFrame:
    """Per alias (study_id, alias_id, name): the only canonical sample (study_id, sample_id, name) of its study whose tokens
    end with the alias's, ambiguous for several, else none. Canonical names are written out by their suffixes, so the join is
    on equal keys."""
    mine = alias.select("study_id", "alias_id", F.array_join(tokens(F.col("name")), "\u001f").alias("suffix")).where("suffix <> ''")
    t = canonical.select("study_id", "sample_id", tokens(F.col("name")).alias("t")).where("size(t) > 0")
    tails = t.select("study_id", "sample_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("t")), lambda i: F.array_join(F.slice("t", i, F.size("t")), "\u001f"))).alias("suffix"))
    return one_many_none(mine.join(tails.distinct(), ["study_id", "suffix"], "left"), ["study_id", "alias_id"], "sample_id")


def consistency(pairs: DataFrame, old: DataFrame, new: DataFrame, days: int = 365, span: int = 730, degrees: float = 2.0) -> DataFrame:
    """Per pair (pair_id, study_id, source_id): do the new source's dates and places fit the study's? old and new hold
    (study_id or source_id, date, lat, lon), nulls allowed.

    Dates fit if the ranges are at most `days` apart; with none on the new side a study range over `span` days doesn't fit.
    Places fit if all lie within `degrees` of the study's box. One misfit is inconsistent; else one fit is consistent.
    """

    def box(df: DataFrame, key: str, p: str) -> DataFrame:
        return df.groupBy(key).agg(*(f(c).alias(f"{p}_{n}_{c}") for c in ("date", "lat", "lon") for n, f in (("lo", F.min), ("hi", F.max))))

    x = pairs.join(box(old, "study_id", "o"), "study_id", "left").join(box(new, "source_id", "n"), "source_id", "left")
    wide = F.date_diff("o_hi_date", "o_lo_date") > span
    fits = (F.col("n_lo_date") <= F.date_add("o_hi_date", days)) & (F.col("n_hi_date") >= F.date_sub("o_lo_date", days))
    dates = F.when(F.col("o_lo_date").isNull(), "not_assessed").when(F.col("n_lo_date").isNull(), F.when(wide, "inconsistent").otherwise("not_assessed")).when(fits, "consistent").otherwise("inconsistent")
    inside = F.lit(True)
    for c in ("lat", "lon"):
        inside &= (F.col(f"n_lo_{c}") >= F.col(f"o_lo_{c}") - degrees) & (F.col(f"n_hi_{c}") <= F.col(f"o_hi_{c}") + degrees)
    places = F.when(F.col("o_lo_lat").isNull() | F.col("n_lo_lat").isNull(), "not_assessed").when(inside, "consistent").otherwise("inconsistent")
    out = x.select("pair_id", dates.alias("dates"), places.alias("places"))
    return out.withColumn("status", F.when((F.col("dates") == "inconsistent") | (F.col("places") == "inconsistent"), "inconsistent").when((F.col("dates") == "consistent") | (F.col("places") == "consistent"), "consistent").otherwise("not_assessed"))


def replicates(names: DataFrame, scope: list[str], key: str = "sample_id", name: str = "name") -> DataFrame:
    """Replicate groups within a scope, by the first of three signals that holds: _repN (two or more), a trailing number after
    a space or underscore (two or more, generic bases aside), consecutive trailing letters (three or more, none twice).
    A sample that one signal has grouped isn't looked at by the next."""
    left = names.select(*scope, F.col(key).alias("sample_id"), F.trim(F.col(name)).alias("name"))
    out = None
    for signal, pattern, least in (("explicit_rep_marker", r"(?i)^(.+?)[-_](?:rep(?:licate)?)[-_]?(\d+)$", 2), ("trailing_number_suffix", r"^(.+?)[_ ]+(\d+)$", 2), ("trailing_letter_suffix", r"^(.+)[-_]([A-Za-z])$", 3)):
        rows = left.where(F.col("name").rlike(pattern)).select(*scope, "sample_id", F.regexp_extract("name", pattern, 1).alias("base"), F.upper(F.regexp_extract("name", pattern, 2)).alias("tail"))
        if signal == "trailing_number_suffix":
            rows = rows.where(~F.trim("base").rlike(r"(?i)^(?:bio)?samples?|^specimens?|^isolates?|^libraries?|^runs?$"))
        n = rows.groupBy(*scope, "base").agg(F.count("*").alias("n"), F.count_distinct("tail").alias("k"), (F.max(F.ascii("tail")) - F.min(F.ascii("tail")) + 1).alias("width"))
        ok = F.col("n") >= least
        if signal == "trailing_letter_suffix":
            ok &= (F.col("k") == F.col("n")) & (F.col("width") == F.col("n"))
        got = rows.join(n.where(ok).select(*scope, "base"), [*scope, "base"]).select(*scope, "sample_id", "base", F.lit(signal).alias("signal"))
        left = left.join(got.select(*scope, "sample_id"), [*scope, "sample_id"], "left_anti")
        out = got if out is None else out.unionByName(got)
    return out


def equal_conditions(samples: DataFrame, scope: list[str], known: list[str], maybe: str) -> DataFrame:
    """Samples of a scope with equal known values (all given, case aside) and equal, possibly missing `maybe`: two or more."""
    keys = [F.lower(F.trim(F.col(c))) for c in known]
    rows = samples
    for c in known:
        rows = rows.where(F.trim(F.coalesce(F.col(c), F.lit(""))) != "")
    g = rows.groupBy(*scope, *(k.alias(f"_{i}") for i, k in enumerate(keys)), F.lower(F.trim(F.col(maybe))).alias("_m")).agg(F.count("*").alias("n"), F.min("sample_id").alias("first"))
    return g.where("n > 1").select(*scope, "first", "n")

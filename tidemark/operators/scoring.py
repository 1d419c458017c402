"""Extraction scoring against gold: one-to-one matching and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.values import calendar_date, squeezed


def match_key(label: str, value: str) -> list:
    norm = lambda c: squeezed(F.lower(F.regexp_replace(c, "_", " ")))
    v = squeezed(F.lower(F.col(value)))
    return [norm(F.col(label)).alias("l"), F.coalesce(calendar_date(F.col(value)).cast("string"), v).alias("v")]


def score_cases(gold: DataFrame, got: DataFrame, case: str = "case_id", label: str = "label", value: str = "value") -> DataFrame:
    """Per case, true and false positives and false negatives when each gold fact can match once: the smaller count of each
    (label, value) is matched; dates of one day are equal however written."""
    side = lambda df, n: df.select(case, *match_key(label, value)).groupBy(case, "l", "v").agg(F.count("*").alias(n))
    both = side(gold, "g").join(side(got, "p"), [case, "l", "v"], "full")
    g, p = F.coalesce("g", F.lit(0)), F.coalesce("p", F.lit(0))
    return both.groupBy(case).agg(F.sum(F.least(g, p)).alias("tp"), F.sum(F.greatest(p - g, F.lit(0))).alias("fp"), F.sum(F.greatest(g - p, F.lit(0))).alias("fn"))


def summarise(results: DataFrame, by: str, ranges: int = 1000) -> DataFrame:
    """Precision, recall and F1 (0 where undefined), mean and median latency, and the latency at place max(1, int(0.95 n)).

    The place is found by counts of equal ranges of latency, and then by rank within one range, so no task sorts all of a
    model's results.
    """
    ends = results.groupBy(by).agg(F.min("latency").alias("_lo"), F.max("latency").alias("_hi"))
    width = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("latency") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * ranges)).otherwise(0)
    rows = results.join(ends, by).withColumn("_range", F.coalesce(width, F.lit(-1)))
    w = Window.partitionBy(by)
    counts = rows.groupBy(by, "_range").agg(F.count("*").alias("k")).withColumn("_n", F.sum("k").over(w)).withColumn("_upto", F.sum("k").over(w.orderBy("_range")))
    place = F.greatest(F.lit(1), F.floor(F.col("_n") * 0.95)) - (F.col("_upto") - F.col("k"))
    at = counts.where(place.between(1, F.col("k"))).select(by, "_range", place.alias("_place"))
    ranked = rows.join(at, [by, "_range"]).withColumn("_r", F.row_number().over(w.orderBy("latency", "case_id"))).where("_r = _place").select(by, F.col("latency").alias("p95_latency"))
    s = results.groupBy(by).agg(F.count("*").alias("n_cases"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg("latency").alias("mean_latency"), F.percentile("latency", 0.5).alias("median_latency")).join(ranked, by, "left")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    s = s.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return s.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))

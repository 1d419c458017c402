"""Semantics that recur in every stage: first accepted fact wins, ordered distinct joins, one/many/none, insert if absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in order, combined before the shuffle; the order is to settle ties."""
    rest = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*by, *(F.col("_r")[c].alias(c) for c in rest)).select(*rows.columns)


def first_accepted(facts: DataFrame, *by: str, order: tuple[str, ...] = ("created_at", "fact_id"), status: str | None = "review_status") -> DataFrame:
    """The oldest non-rejected fact of each key; equal times are settled by the fact's id."""
    return first_of(facts.where(F.col(status) != "rejected") if status else facts, list(by), list(order))


def joined_distinct(rows: DataFrame, by: list[str], value: str, order: list[str], sep: str = " | ", name: str = "joined") -> DataFrame:
    """Per key, values in order joined by sep; those equal but for case count once, as first written."""
    lower = F.lower(F.col(value))
    first = rows.where(F.col(value).isNotNull()).groupBy(*by, lower.alias("_k")).agg(F.min(F.struct(*order, F.col(value).alias("_v"))).alias("_f"))
    return first.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_f")), lambda s: s["_v"]), sep).alias(name))


def pipe_union(first: Column, second: Column, sep: str = " | ") -> Column:
    """Parts of two piped strings, the first's before the second's, equal ones but for case once; "not found" goes if
    there is anything else."""
    parts = F.filter(F.transform(F.split(F.concat_ws("|", first, second), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    none = F.expr("cast(array() as array<string>)")
    merged = F.aggregate(parts, none, lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))
    real = F.filter(merged, lambda x: F.lower(x) != "not found")
    return F.array_join(F.when(F.size(merged) > 1, real).otherwise(merged), sep)


def one_many_none(rows: DataFrame, by: list[str], candidate: str) -> DataFrame:
    """Per key: matched with the only candidate, ambiguous, or none."""
    got = rows.groupBy(*by).agg(F.count_distinct(candidate).alias("n"), F.min(candidate).alias("only"))
    return got.select(*by, F.when(F.col("n") == 1, "matched").when(F.col("n") > 1, "ambiguous").otherwise("none").alias("outcome"), F.when(F.col("n") == 1, F.col("only")).alias("match"))


def insert_absent(existing: DataFrame, new: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """existing, and the first new row of every natural key that it lacks; rows with a null in their key are always added."""
    null_key = F.greatest(*(F.col(k).isNull().cast("int") for k in by), F.lit(0)) == 1
    firsts = first_of(new.where(~null_key), by, order)
    return existing.unionByName(firsts.join(existing.select(*by), by, "left_anti")).unionByName(new.where(null_key))


def stable_id(prefix: str, *parts: Column) -> Column:
    """A surrogate id that follows from the natural key, so retries give the same."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(F.concat_ws("\u001f", *parts), 256), 1, 12))


def canonical_json_key(**fields: Column) -> Column:
    """An idempotency key: 32 hex digits of the SHA-256 of the fields as JSON, in the order of their names."""
    return F.substring(F.sha2(F.to_json(F.struct(*(v.alias(k) for k, v in sorted(fields.items())))), 256), 1, 32)

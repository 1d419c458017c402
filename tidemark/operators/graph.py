"""Graphs of studies: components, merges, roots, citation expansion, settling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.shared import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node reachable over links (a, b). Nodes without links don't appear.

    Labels spread to neighbours and then follow their own label's label, so paths shorten by more than half a round; each
    round is written to the shared folder in place of the last. Repeated links, links to oneself and null ends (ignored) are allowed.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = materialise(links.union(links.select("b", "a")).distinct().toDF("a", "b"), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("heard")), "b").groupBy(F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        near = labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = materialise(near.join(far, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        discard(labels)
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            discard(both)
            return labels


def study_components(studies: DataFrame, shared: DataFrame, lineage: DataFrame) -> DataFrame:
    """(study_id, component_id): studies that share an entity (shared: study_id, entity_id) or descend from one another
    (lineage: study_id, parent_id); the id is the smallest member. A study without links is its own component.

    An entity links its studies through the smallest of them, so it costs one link a study, not one a pair.
    """
    heads = shared.groupBy("entity_id").agg(F.min("study_id").alias("b"))
    links = shared.join(heads, "entity_id").select(F.col("study_id").alias("a"), "b").union(lineage.select("study_id", "parent_id"))
    return studies.select("study_id").distinct().join(components(links).withColumnRenamed("node", "study_id"), "study_id", "left").select("study_id", F.coalesce("label", "study_id").alias("component_id"))


def merged_ids(merges: DataFrame) -> DataFrame:
    """(study_id, into): where each absorbed study ends up when merges (study_id, into_id) are followed to their end."""
    labels = components(merges.select(F.col("study_id").alias("a"), F.col("into_id").alias("b")))
    ends = merges.select(F.col("into_id").alias("node")).distinct().join(merges.select(F.col("study_id").alias("node")), "node", "left_anti")
    last = labels.join(ends, "node").groupBy("label").agg(F.min("node").alias("into"))
    return labels.join(last, "label").where("node <> into").select(F.col("node").alias("study_id"), "into")


def repoint(table: DataFrame, merges: DataFrame, natural_key: list[str], order: list[str]) -> DataFrame:
    """table with absorbed studies replaced; of rows that collide on the natural key then, the first in order stays."""
    moved = table.join(merges, "study_id", "left").withColumn("study_id", F.coalesce("into", "study_id")).drop("into")
    own = [F.col(c) for c in table.columns]
    first = moved.groupBy(*natural_key).agg(F.min(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in table.columns])).alias("r"))
    return first.select(*(F.col("r")[f"_{c}"].alias(c) for c in table.columns)) if own else moved


def roots(links: DataFrame, years: DataFrame) -> DataFrame:
    """Per entity the study it belongs to: its only one, else the only one with the earliest publication year; without one
    it is ambiguous. links: entity_id, study_id; years: study_id, year (null allowed)."""
    rows = links.select("entity_id", "study_id").distinct().join(years, "study_id", "left")
    first = rows.groupBy("entity_id").agg(F.count("*").alias("n"), F.min("study_id").alias("only"), F.min("year").alias("first"))
    at = rows.join(first.select("entity_id", "first"), "entity_id").where(F.col("year") == F.col("first")).groupBy("entity_id").agg(F.count("*").alias("k"), F.min("study_id").alias("winner"))
    root = F.when(F.col("n") == 1, F.col("only")).when(F.col("k") == 1, F.col("winner"))
    out = first.join(at, "entity_id", "left").withColumn("root_study_id", root)
    return out.select("entity_id", "root_study_id", F.when(F.col("root_study_id").isNull(), "ambiguous").otherwise("determined").alias("root_status"))


def entity_homes(claims: DataFrame, shareable: tuple[str, ...]) -> DataFrame:
    """One entity per (level, accession), over all studies for shareable levels, else in each study: its home is the first
    claimant; several claimants leave its root pending. claims: level, study_id, accession, created_at. Claims without an
    accession stay separate entities."""
    scope = F.when(F.col("level").isin(*shareable), F.lit("*")).otherwise(F.col("study_id").cast("string"))
    named = claims.where("accession IS NOT NULL").groupBy("level", scope.alias("scope"), "accession")
    got = named.agg(F.min_by("study_id", F.struct("created_at", "study_id")).alias("home"), F.count_distinct("study_id").alias("n"))
    return got.select("level", "accession", "home", F.when(F.col("n") > 1, "pending").otherwise("determined").alias("root_status"))


def expand(start: DataFrame, edges: DataFrame, depth: int, fan_out: int) -> DataFrame:
    """(node, depth): what is reached from start (node) over edges (src, dst) in at most `depth` steps, each node following
    its `fan_out` smallest targets; a node keeps its smallest depth. Steps are a parameter, so the loop is bounded."""
    ranked = edges.distinct().groupBy("src").agg(F.slice(F.array_sort(F.collect_set("dst")), 1, fan_out).alias("t")).select("src", F.explode("t").alias("dst")) if fan_out else edges
    seen = materialise(start.select("node").distinct().withColumn("depth", F.lit(0)), "reach")
    for d in range(1, depth + 1):
        at = seen.where(F.col("depth") == d - 1)
        new = at.join(ranked, at.node == ranked.src).select(F.col("dst").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")
        seen = materialise(seen.unionByName(new.withColumn("depth", F.lit(d))), "reach")
    return seen


def settled(members: DataFrame, before: DataFrame, in_flight: DataFrame, generation: Column, most: int) -> DataFrame:
    """Per component: settled if its members are those of the snapshot and no task is in flight; stalled past `most`
    generations; else pending. members: component_id, study_id; before: component_id, signature; in_flight: study_id."""
    sign = F.sha2(F.array_join(F.array_sort(F.collect_set(F.col("study_id").cast("string"))), ","), 256)
    busy = members.join(in_flight.select("study_id").distinct().withColumn("_busy", F.lit(1)), "study_id", "left")
    now = busy.groupBy("component_id").agg(sign.alias("signature"), F.max(F.coalesce("_busy", F.lit(0))).alias("busy"))
    both = now.join(before.withColumnRenamed("signature", "was"), "component_id", "left")
    status = F.when((F.col("busy") == 0) & (F.col("signature") == F.col("was")), "settled").when(generation > most, "stalled").otherwise("pending")
    return both.select("component_id", "signature", status.alias("status"))

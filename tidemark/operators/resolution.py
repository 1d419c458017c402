"""Which study evidence belongs to: resolve or create, authority over shared entities, aliases folded into facts, primer chases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.graph import merged_ids
from tidemark.shared import materialise

#: Identifiers of data, which several studies may share; they never tell that two studies are one.
DATA_TYPES = ("bioproject_accession", "biosample_accession", "sra_study_accession", "ena_study_accession")


def lineage_linked(pairs: DataFrame, studies: DataFrame) -> DataFrame:
    """pairs (study_id, other, ...) and linked: whether one was discovered from the other, or both from one root. studies:
    study_id, parent_id, root_id (null: itself)."""
    side = lambda k: studies.select(F.col("study_id").alias(k), F.col("parent_id").alias(f"_p_{k}"), F.coalesce("root_id", "study_id").alias(f"_r_{k}"))
    both = pairs.join(side("study_id"), "study_id", "left").join(side("other"), "other", "left")
    linked = (F.col("_p_study_id") == F.col("other")) | (F.col("_p_other") == F.col("study_id")) | (F.col("_r_study_id") == F.col("_r_other"))
    return both.withColumn("linked", F.coalesce(linked, F.lit(False))).drop("_p_study_id", "_p_other", "_r_study_id", "_r_other")


def first_unlinked(asks: DataFrame, claims: DataFrame, studies: DataFrame, at: list[str]) -> DataFrame:
    """(study_id, *at, other): per ask (study_id, *at) the smallest `other` of the claims (*at, other) at its place that no lineage
    links to it; asks without one don't appear. Claims and asks are distinct, and no study asks where it claims.

    No pair of an ask and a claim is formed but parents and children: claims of one root are a run in order, runs are in the
    order of their first claims, and the first number that isn't taken away is the one that is sought.
    """
    side = studies.select("study_id", "parent_id", F.concat(F.lit("="), F.coalesce("root_id", "study_id").cast("string")).alias("_c")).distinct()
    rank = lambda by, order: F.row_number().over(Window.partitionBy(*by).orderBy(order))
    theirs = claims.join(side.withColumnsRenamed({"study_id": "other", "parent_id": "_p"}), "other", "left").withColumn("_c", F.coalesce("_c", F.lit("")))
    theirs = materialise(theirs.withColumn("_i", rank([*at, "_c"], "other")), "claims")
    runs = materialise(theirs.where("_i = 1").select(*at, "_c", "other", rank(at, "other").alias("_k")), "runs")
    mine = materialise(asks.join(side, "study_id", "left"), "asks")
    key = ["study_id", *at]
    parent = mine.where("parent_id IS NOT NULL").select(*key, F.col("_c").alias("_own"), F.col("parent_id").alias("other")).join(theirs.select(*at, "other", "_c", "_i"), [*at, "other"])
    child = theirs.where("_p IS NOT NULL").select(*at, F.col("_p").alias("study_id"), "other", "_c", "_i").join(mine.select(*key, F.col("_c").alias("_own")), key)
    gone = materialise(parent.select(*key, "_own", "_c", "_i").union(child.select(*key, "_own", "_c", "_i")).where("_own IS NULL OR _own <> _c").select(*key, "_c", "_i").distinct(), "gone")

    def free(taken: DataFrame, by: list[str], number: str) -> DataFrame:
        """Per key the smallest number from 1 that isn't among its (distinct) numbers."""
        return taken.withColumn("_n", rank(by, number)).groupBy(*by).agg((F.count_if(F.col(number) == F.col("_n")) + 1).cast("int").alias(number))

    inside = free(gone, [*key, "_c"], "_i").join(theirs.select(*at, "_c", "_i", "other"), [*at, "_c", "_i"])
    touched = gone.select(*key, "_c").union(mine.where("_c IS NOT NULL").select(*key, "_c")).distinct().join(runs.select(*at, "_c", "_k"), [*at, "_c"])
    outside = mine.select(*key).distinct().join(free(touched.select(*key, "_k"), key, "_k"), key, "left").withColumn("_k", F.coalesce("_k", F.lit(1))).join(runs.select(*at, "_k", "other"), [*at, "_k"])
    return inside.select(*key, "other").union(outside.select(*key, "other")).groupBy(*key).agg(F.min("other").alias("other"))


def resolve(evidence: DataFrame, known: DataFrame, studies: DataFrame, consistency: DataFrame | tuple[DataFrame, DataFrame], data_types: tuple[str, ...] = DATA_TYPES) -> DataFrame:
    """(evidence_id, study_id, type, value, decision, other): what becomes of each piece of evidence.

    evidence: evidence_id, study_id, type, value, confidence, created_at; known: study_id, type, value; consistency:
    study_id, other, consistent (a pair that isn't there isn't), or two tables (study_id, class) and (other, class) whose
    pairs of one class are consistent. An identifier that no study has is recorded; of several
    pieces of new evidence for one, the oldest is, and the others meet it. One that the study has itself is left. One of data
    is shared, and so is one of studies that discovery links. Else a structured source merges with the only other study, and
    evidence that isn't inferred with the only, or first, consistent one; the rest splits off a sibling for review.

    Evidence and the studies that have its identifier aren't paired, so a frequent identifier costs no more than its rows.
    """
    at = ["type", "value"]
    news = evidence.join(known.select(*at).distinct(), at, "left_anti")
    first = news.groupBy(*at).agg(F.min(F.struct("created_at", "evidence_id", "study_id")).alias("f"))
    recorded = materialise(first.select(*at, F.col("f.study_id").alias("other"), F.col("f.evidence_id").alias("_by")), "recorded")
    claims = materialise(known.select(*at, F.col("study_id").alias("other")).where("other IS NOT NULL").distinct().unionByName(recorded.where("other IS NOT NULL").drop("_by")), "claims")
    rows = evidence.groupBy("evidence_id", "study_id", *at, "confidence").agg(F.count("*").alias("_m"))
    per = rows.join(recorded.select(*at, F.col("_by").alias("evidence_id"), F.lit(True).alias("new")), [*at, "evidence_id"], "left")
    per = per.join(claims.groupBy(*at).agg(F.count("*").alias("_all")), at, "left")
    per = materialise(per.join(claims.select(*at, F.col("other").alias("study_id"), F.lit(True).alias("own")), [*at, "study_id"], "left"), "evidence")
    asks = per.where("new IS NULL AND own IS NULL AND _all > 0").where(~F.col("type").isin(*data_types)).select("study_id", *at).distinct().where("study_id IS NOT NULL")
    key = ["study_id", *at]
    only = first_unlinked(asks, claims, studies, at).withColumnRenamed("other", "only")
    if isinstance(consistency, tuple):
        takes, offers = (t.distinct() for t in consistency)
        best = first_unlinked(asks.join(takes, "study_id"), claims.join(offers, "other"), studies, [*at, "class"])
    else:
        good = consistency.where("consistent").select("study_id", "other").distinct()
        best = lineage_linked(asks.join(good, "study_id").join(claims, [*at, "other"], "left_semi"), studies).where("NOT linked")
    best = best.groupBy(*key).agg(F.min("other").alias("best"))
    per = per.join(only, key, "left").join(best, key, "left")
    structured, inferred, one = F.col("confidence") == "structured_source", F.col("confidence") == "inferred", F.col("_all") * F.col("_m") == 1
    merged = F.when(one & structured, F.col("only")).when(~inferred, F.col("best"))
    decision = F.when(F.coalesce("new", F.lit(False)), "record").when(F.coalesce("own", F.lit(False)), "noop").when(F.col("type").isin(*data_types) | F.col("only").isNull(), "share").when(merged.isNotNull(), "merge").otherwise("sibling")
    return per.select("evidence_id", "study_id", *at, decision.alias("decision"), F.when(decision == "merge", merged).when(decision == "sibling", F.col("only")).alias("other"))


def merges(decisions: DataFrame) -> DataFrame:
    """(study_id, into): the studies that resolve() absorbs, each with where it ends up; a cycle of merges has no end and is left."""
    into = decisions.where("decision = 'merge'").select(F.col("other").alias("study_id"), F.col("study_id").alias("into_id"))
    return merged_ids(into.groupBy("study_id").agg(F.min("into_id").alias("into_id")))


def next_frontier(siblings: DataFrame, lineage: DataFrame, visited: DataFrame) -> DataFrame:
    """(study_id): studies that a component's walk reaches next: through shared entities or lineage, and not visited yet."""
    return siblings.select("study_id").union(lineage.select("study_id")).distinct().join(visited.select("study_id"), "study_id", "left_anti")


def authoritative(links: DataFrame, entities: DataFrame) -> DataFrame:
    """The links (study_id, entity_id) whose entity is determined to be rooted in that very study. entities: entity_id,
    root_status, root_study_id."""
    rooted = entities.where("root_status = 'determined'").select("entity_id", F.col("root_study_id").alias("study_id"))
    return links.join(rooted, ["entity_id", "study_id"], "left_semi")


def sample_targets(facts: DataFrame, entities: DataFrame, field: str = "materialSampleID") -> DataFrame:
    """facts (study_id, field, value, ...) with entity_id: a fact of `field` names a sample of its study by external id, and goes
    if there is none; other facts have no entity from this. entities: entity_id, study_id, level, external_id."""
    samples = entities.where("level = 'sample'").groupBy("study_id", F.col("external_id").alias("value")).agg(F.min("entity_id").alias("entity_id"))
    is_id = F.col("field") == field
    return facts.where(~is_id).withColumn("entity_id", F.lit(None).cast(samples.schema["entity_id"].dataType)).unionByName(facts.where(is_id).join(samples, ["study_id", "value"]))


def folded_aliases(facts: DataFrame, aliases: DataFrame) -> DataFrame:
    """facts with each alias entity's replaced by the entity it is the same sample as; chains are followed to their end, and
    own says whether the fact was the entity's own. aliases: alias_id, canonical_id."""
    ends = merged_ids(aliases.select(F.col("alias_id").alias("study_id"), F.col("canonical_id").alias("into_id"))).select(F.col("study_id").alias("entity_id"), F.col("into").alias("_to"))
    return facts.join(ends, "entity_id", "left").withColumn("own", F.col("_to").isNull()).withColumn("entity_id", F.coalesce("_to", "entity_id")).drop("_to")


def alias_lists(aliases: DataFrame, names: DataFrame) -> DataFrame:
    """(entity_id, aliases): the names of the entities folded into each, in order. names: entity_id, external_id."""
    rows = aliases.join(names.withColumnRenamed("entity_id", "alias_id"), "alias_id").groupBy(F.col("canonical_id").alias("entity_id"))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("external_id", "alias_id"))), lambda r: r["external_id"]), " | ").alias("aliases"))


def primer_library(facts: DataFrame) -> DataFrame:
    """(direction, name, sequence): for every primer name of the corpus the oldest sequence given by a study that also gives the
    name. facts: study_id, direction, kind (name or sequence), value, created_at, review_status."""
    real = facts.where("review_status <> 'rejected' AND value IS NOT NULL")
    name = real.where("kind = 'name'").select("study_id", "direction", F.lower(F.trim("value")).alias("name")).where("name <> ''").distinct()
    seq = real.where("kind = 'sequence'").groupBy("study_id", "direction").agg(F.min(F.struct("created_at", "value")).alias("s"))
    return name.join(seq, ["study_id", "direction"]).groupBy("direction", "name").agg(F.min("s").alias("s")).select("direction", "name", F.col("s.value").alias("sequence"))


def chase(wanted: DataFrame, references: DataFrame, given: DataFrame, depth: int) -> DataFrame:
    """(study_id, primer, found_in, sequence, hops, capped): each study's primer without a sequence, followed back through the
    studies it is cited from until one gives the sequence, or `depth` hops are used up (capped) or nothing is cited.

    wanted: study_id, primer; references: study_id, primer, cited_id; given: study_id, primer, sequence. Of several that give it
    after as many hops the smallest counts. Every hop is written, so the loop is bounded and cheap to retry.
    """
    at = materialise(wanted.select("study_id", "primer", F.col("study_id").alias("at"), F.lit(0).alias("hops")).distinct(), "chase")
    have = given.groupBy(F.col("study_id").alias("at"), "primer").agg(F.min("sequence").alias("sequence"))
    step = references.select(F.col("study_id").alias("at"), "primer", "cited_id").distinct()
    all_ = at
    for hop in range(1, depth + 1):
        open_ = at.join(have, ["at", "primer"], "left_anti")
        new = open_.join(step, ["at", "primer"]).select("study_id", "primer", F.col("cited_id").alias("at"), F.lit(hop).alias("hops")).distinct()
        at = materialise(new.join(all_, ["study_id", "primer", "at"], "left_anti"), "chase")
        all_ = all_.unionByName(at)
    hit = all_.join(have, ["at", "primer"]).groupBy("study_id", "primer").agg(F.min(F.struct("hops", "at", "sequence")).alias("h"))
    ends = at.join(have, ["at", "primer"], "left_anti").join(step, ["at", "primer"], "left_semi").select("study_id", "primer").distinct().withColumn("_more", F.lit(True))
    out = wanted.select("study_id", "primer").distinct().join(hit, ["study_id", "primer"], "left").join(ends, ["study_id", "primer"], "left")
    return out.select("study_id", "primer", F.col("h.at").alias("found_in"), F.col("h.sequence").alias("sequence"), F.col("h.hops").alias("hops"), (F.col("h").isNull() & F.coalesce("_more", F.lit(False))).alias("capped"))


def organisms(facts: DataFrame, links: DataFrame) -> DataFrame:
    """(study_id, value): the distinct organisms of all entities linked to a study, in the order they were first seen."""
    from tidemark.keys import joined_distinct

    named = facts.where("field = 'organism' AND review_status <> 'rejected' AND trim(value) <> ''").withColumn("value", F.trim("value"))
    return joined_distinct(links.select("study_id", "entity_id").distinct().join(named.select("entity_id", "value", "created_at"), "entity_id"), ["study_id"], "value", ["created_at"], name="value")


def review_queue(results: DataFrame, order: Column | None = None) -> DataFrame:
    """Failed checks, by severity as text (descending) and age; ties by id."""
    return results.where("status = 'failed'").orderBy(order if order is not None else F.desc("severity"), "created_at", "result_id")

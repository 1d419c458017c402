"""The mapping of studies to the checklist as one plan: facts are prepared, rules give values, and later steps override or fill.

The steps of a sequential pass become layers with a priority, resolved once for each target: an override beats the rules' value,
the rules' beats what a step only fills in, and of the steps that fill the earlier beats the later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.mapping import apply_rules, without_replaced
from tidemark.operators.resolution import folded_aliases
from tidemark.operators.routing import piped_by_support

#: Steps in order, and what each does: prepares facts, gives the base values, overrides them, or fills what is missing.
STEPS = {
    "experiment_runs": "prepare",
    "sample_aliases": "prepare",
    "corpus_primers": "prepare",
    "filter_default": "prepare",
    "assay_taxa": "prepare",
    "recorded_by": "prepare",
    "checklist_version": "prepare",
    "sample_type_detection": "prepare",
    "rules": "base",
    "biological_replicates": "override",
    "identity_values": "fill",
    "library_layout": "fill",
    "fused_primers": "override",
    "mutual_reference": "fill",
    "assay_name": "fill",
    "withheld_default": "fill",
    "sample_type_routing": "fill",
}
KEY = ["study_id", "entity_id", "target_field"]


def prepared(facts: DataFrame, derived: dict[str, DataFrame], aliases: DataFrame | None = None) -> DataFrame:
    """Facts that aren't rejected, with aliases folded, and those that steps derive (as facts) for studies and entities that
    have none of the type."""
    real = facts.where("review_status <> 'rejected' AND raw_value IS NOT NULL")
    if aliases is not None:
        real = folded_aliases(real, aliases).drop("own")
    out, have = real, real.select("study_id", F.col("entity_id").alias("_e"), "fact_type").distinct()
    for step, rows in derived.items():
        if STEPS[step] != "prepare":
            raise ValueError(f"{step} doesn't prepare facts")
        mine = rows.select(*facts.columns).alias("m")
        known = have.withColumnsRenamed({"study_id": "_s", "fact_type": "_t"})
        out = out.unionByName(mine.join(known, (F.col("m.study_id") == F.col("_s")) & F.col("m.entity_id").eqNullSafe(F.col("_e")) & (F.col("m.fact_type") == F.col("_t")), "left_anti"))
    return out


def base(facts: DataFrame, rules: DataFrame, used: list[str], normalised: dict[str, str], pipe_fields: list[str], routed: DataFrame | None = None) -> DataFrame:
    """(study_id, entity_id, target_field, value, review_required) by the rules: native facts of a field that has a normalised
    one are left out (normalised: that fact type to the native one), fields that are routed by sample type too; piped fields
    keep every value, the others the oldest, in one aggregate each."""
    mapped = apply_rules(facts, rules, used)
    if normalised:
        mapped = without_replaced(mapped, mapped.where(F.col("fact_type").isin(*normalised)))
    if routed is not None:
        wide = routed.select("study_id", F.col("field").alias("fact_type")).distinct()
        mapped = mapped.where("entity_id IS NOT NULL").unionByName(mapped.where("entity_id IS NULL").join(wide, ["study_id", "fact_type"], "left_anti"))
    many = piped_by_support(mapped.where(F.col("target_field").isin(*pipe_fields)), KEY)
    order = F.struct("created_at", "fact_id")
    one = mapped.where(~F.col("target_field").isin(*pipe_fields)).groupBy(*KEY).agg(F.min_by(F.struct("value", "review_required"), order).alias("w"), (F.min("value") != F.max("value")).alias("differ"))
    return one.select(*KEY, F.col("w.value").alias("value"), (F.col("w.review_required") | F.col("differ")).alias("review_required")).unionByName(many.select(*KEY, "value", "review_required"))


def resolved(base_values: DataFrame, steps: dict[str, DataFrame]) -> DataFrame:
    """(study_id, entity_id, target_field, value, review_required, step): one value for each target, and the step that gave it.
    steps: by name, rows of the target, value and review_required."""
    order = list(STEPS)
    out = base_values.select(*KEY, "value", "review_required", F.lit("rules").alias("step"), F.lit(len(order)).alias("_p"))
    for name, rows in steps.items():
        if STEPS[name] not in ("override", "fill"):
            raise ValueError(f"{name} neither overrides nor fills")
        # later overrides beat earlier ones, earlier fills beat later ones
        place = -order.index(name) if STEPS[name] == "override" else len(order) + 1 + order.index(name)
        out = out.unionByName(rows.select(*KEY, "value", "review_required", F.lit(name).alias("step"), F.lit(place).alias("_p")))
    first = out.where("value IS NOT NULL").groupBy(*KEY).agg(F.min(F.struct("_p", "value", "review_required", "step")).alias("r"))
    return first.select(*KEY, "r.value", "r.review_required", "r.step")


def map_studies(facts: DataFrame, rules: DataFrame, used: list[str], derived: dict[str, DataFrame], steps: dict[str, DataFrame], aliases: DataFrame | None = None, normalised: dict[str, str] | None = None, pipe_fields: list[str] | None = None, routed: DataFrame | None = None) -> DataFrame:
    """The whole chain: prepared(), base(), resolved()."""
    return resolved(base(prepared(facts, derived, aliases), rules, used, normalised or {}, pipe_fields or [], routed), steps)

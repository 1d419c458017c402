"""Handlers of task types, polls of components, and the backfills that fill the queue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.keys import canonical_json_key
from tidemark.operators.tasks import CLAIMABLE, fail

#: A handler takes the tasks of its type and gives (task_id, ok); what it makes besides, it writes itself.
Handler = Callable[[DataFrame], DataFrame]


def dispatched(tasks: DataFrame, now: Column, handlers: dict[str, Handler]) -> DataFrame:
    """tasks after one round: each claimable task of a known type is completed if its handler says so, else it fails (a retry
    after the back-off, or manual review once its attempts are used up); others stay as they are."""
    ready = F.col("status").isin(*CLAIMABLE) & (F.col("available_after") <= now) & F.col("task_type").isin(*handlers)
    taken, rest = tasks.where(ready), tasks.where(~F.coalesce(ready, F.lit(False)))
    done = None
    for kind, handle in handlers.items():
        got = handle(taken.where(F.col("task_type") == kind)).select("task_id", F.col("ok").alias("_ok"))
        done = got if done is None else done.unionByName(got)
    told = taken.join(done, "task_id", "left").withColumn("_ok", F.coalesce("_ok", F.lit(False)))
    return rest.unionByName(told.where("_ok").withColumn("status", F.lit("completed")).drop("_ok")).unionByName(fail(told.where("NOT _ok").drop("_ok"), now))


def polled(components: DataFrame, now: Column, minutes: int) -> DataFrame:
    """components (component_id, status, generation): those that are pending are polled again after `minutes`, as the next
    generation; settled and stalled ones aren't."""
    again = F.col("status") == "pending"
    return components.withColumns({"available_after": F.when(again, now + F.make_dt_interval(mins=F.lit(minutes))), "generation": F.col("generation") + F.when(again, 1).otherwise(0)})


#: Which studies each backfill is for, over columns status, has_pmcid, has_facts, has_supplements, has_supplement_files,
#: has_values and refreshable.
BACKFILLS = {
    "discover_identifiers": "status = 'candidate'",
    "extract_text": "has_pmcid AND status <> 'not_accessible'",
    "map": "has_facts",
    "validate": "has_facts",
    "validate_values": "has_values",
    "verify_evidence": "has_values",
    "discover_supplements": "has_pmcid",
    "retrieve_supplements": "has_supplements",
    "extract_supplement_text": "has_supplement_files",
    "refresh": "refreshable",
    "rediscover_supplements": "refreshable AND has_pmcid",
    "rediscover_citations": "refreshable",
}


def backfill_tasks(studies: DataFrame, kinds: dict[str, str] = BACKFILLS) -> DataFrame:
    """(study_id, task_type, idempotency_key): all tasks that the backfills want, in one pass over the studies."""
    wanted = F.filter(F.array(*(F.when(F.expr(p), F.lit(k)) for k, p in kinds.items())), lambda x: x.isNotNull())
    rows = studies.select("study_id", F.explode(wanted).alias("task_type"))
    return rows.withColumn("idempotency_key", F.concat_ws(":", "task_type", canonical_json_key(study_id=F.col("study_id").cast("string"), task_type=F.col("task_type"))))


def enqueued(queue: DataFrame, studies: DataFrame, kinds: dict[str, str] = BACKFILLS) -> DataFrame:
    """The backfills' tasks that the queue (idempotency_key) doesn't hold."""
    return backfill_tasks(studies, kinds).join(queue.select("idempotency_key").distinct(), "idempotency_key", "left_anti")

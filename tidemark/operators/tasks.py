"""The work queue as tables: counts, claims, failures, stale claims, change detection, schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.values import backoff_seconds

STATUSES = ("pending", "claimed", "running", "completed", "retry_pending", "failed", "manual_review_required", "cancelled")
CLAIMABLE, IN_FLIGHT = ("pending", "retry_pending"), ("claimed", "running")


def count_by_status(tasks: DataFrame, statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """Tasks by status, 0 for statuses without any."""
    every = tasks.sparkSession.createDataFrame([(s,) for s in statuses], "status string")
    return every.join(tasks.groupBy("status").agg(F.count("*").alias("n")), "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def claim(tasks: DataFrame, now: Column, workers: int, order: tuple[str, ...] = ("priority", "created_at", "task_id")) -> DataFrame:
    """The next task of each of `workers` workers, in the order of the queue (a top-k, so only k rows a partition move)."""
    ready = tasks.where(F.col("status").isin(*CLAIMABLE) & (F.col("available_after") <= now))
    top = ready.orderBy(*order).limit(workers)
    return top.withColumn("worker", F.row_number().over(Window.orderBy(*order)))


def fail(tasks: DataFrame, now: Column) -> DataFrame:
    """What becomes of failed tasks: manual review once attempts are used up, else a retry after the back-off."""
    over = F.col("attempt_count") >= F.col("max_attempts")
    wait = backoff_seconds(F.col("attempt_count"))
    return tasks.withColumn("available_after", F.when(over, F.col("available_after")).otherwise(F.timestamp_seconds(F.unix_timestamp(now) + wait))).withColumn("status", F.when(over, "manual_review_required").otherwise("retry_pending"))


def release_stale(tasks: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Tasks claimed or running for `minutes` or more fail; all others stay."""
    stale = F.col("status").isin(*IN_FLIGHT) & F.coalesce(F.col("claimed_at") <= now - F.make_dt_interval(mins=F.lit(minutes)), F.lit(False))
    rows = tasks.withColumn("_stale", stale)
    return rows.where("NOT _stale").unionByName(fail(rows.where("_stale"), now)).drop("_stale")


def latest_state(events: DataFrame, key: str, order: list[str], state: str) -> DataFrame:
    """The last event's state of each key: the batch form of the task state machine."""
    return events.groupBy(key).agg(F.max_by(state, F.struct(*order)).alias(state), F.count("*").alias("n_events"))


def new_versions(latest: DataFrame, fetched: DataFrame, key: str = "identifier", digest: str = "content_hash") -> DataFrame:
    """Fetched rows that are new or whose content changed, with the version that they follow."""
    last = latest.groupBy(key).agg(F.max_by(F.struct("source_id", digest), F.struct("created_at", "source_id")).alias("_l"))
    j = fetched.join(last, key, "left").where(F.col("_l").isNull() | (F.col(f"_l.{digest}") != F.col(digest)))
    return j.select(*fetched.columns, F.col("_l.source_id").alias("parent_source_id"))


def due(runs: DataFrame, key: str, now: Column, days: int) -> DataFrame:
    """Keys whose last completed run is `days` or more ago."""
    last = runs.where(F.col("status") == "completed").groupBy(key).agg(F.max("started_at").alias("last"))
    return last.select(key, "last", (F.date_diff(now, "last") >= days).alias("due"))


def enqueue(tasks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted tasks whose idempotency key isn't in the queue, each key once."""
    return wanted.dropDuplicates(["idempotency_key"]).join(tasks.select("idempotency_key"), "idempotency_key", "left_anti")


def watermarks(checks: DataFrame) -> DataFrame:
    """Per source and query the last check; it is set by failed checks too."""
    return checks.groupBy("source", "query").agg(F.max("checked_at").alias("last_checked"), F.count("*").alias("n_checks"))


def overlap_window(rows: DataFrame, at: str, days: int = 14) -> DataFrame:
    """Rows from `days` before the latest on, to be read again."""
    top = rows.agg((F.max(at) - F.make_dt_interval(days=F.lit(days))).alias("_from"))
    return rows.join(F.broadcast(top), F.col(at) >= F.col("_from")).drop("_from")  # one row


def first_claimants(ids: DataFrame, accession: str, order: list[str]) -> DataFrame:
    return ids.groupBy(accession).agg(F.min(F.struct(*order, "study_id")).alias("_f"), F.count("*").alias("n")).select(accession, F.col("_f.study_id").alias("study_id"), "n")

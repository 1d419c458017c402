"""Event windows (an extension) and the task state machine, for streams and for tables alike."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.shared import ship


def watermarked(events: DataFrame, late: str) -> DataFrame:
    return events.withWatermark("ts", late) if events.isStreaming else events


def tumbling(events: DataFrame, width: str, late: str = "1 hour") -> DataFrame:
    """Count and total by window and type; on a stream, events up to `late` behind are counted."""
    g = watermarked(events, late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, step: str, late: str = "1 hour") -> DataFrame:
    g = watermarked(events, late).groupBy(F.window("ts", width, step).alias("w")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """A user's sessions: events at most `gap` apart."""
    g = watermarked(events, late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


#: What each event makes of a task, by the state before; other events are ignored.
MOVES = {
    ("pending", "claim"): "claimed",
    ("retry_pending", "claim"): "claimed",
    ("claimed", "start"): "running",
    ("running", "complete"): "completed",
    ("claimed", "complete"): "completed",
    ("pending", "cancel"): "cancelled",
    ("retry_pending", "cancel"): "cancelled",
    ("claimed", "cancel"): "cancelled",
    ("running", "cancel"): "cancelled",
}
FINAL = ("completed", "cancelled", "manual_review_required")


def advance(state: str, attempts: int, event: str, most: int) -> tuple[str, int]:
    """The next state and attempts used; a failure retries until `most` attempts, then asks for review."""
    if state in FINAL:
        return state, attempts
    if event == "fail":
        return ("manual_review_required" if attempts >= most else "retry_pending", attempts) if state in ("claimed", "running") else (state, attempts)
    to = MOVES.get((state, event), state)
    return to, attempts + (to == "claimed" != state)


class TaskMachine(StatefulProcessor):
    """Keeps each task's state and attempts; releases a claim that nothing was heard of for `stale_ms`."""

    def __init__(self, most: int = 3, stale_ms: int = 3_600_000) -> None:
        self.most, self.stale_ms = most, stale_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("task", "status string, attempts int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802  the interface's name
        now, attempts = self.state.get() if self.state.exists() else ("pending", 0)
        events = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        for event in events["event"]:
            now, attempts = advance(now, attempts, event, self.most)
        self.state.update((now, attempts))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if now in ("claimed", "running"):
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.stale_ms)
        yield pd.DataFrame({"task_id": [key[0]], "status": [now], "attempts": [attempts]})

    def handleExpiredTimer(self, key: tuple, timers, expired) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802
        now, attempts = self.state.get()
        now, attempts = advance(now, attempts, "fail", self.most)
        self.state.update((now, attempts))
        yield pd.DataFrame({"task_id": [key[0]], "status": [now], "attempts": [attempts]})

    def close(self) -> None:
        pass


def task_states(events: DataFrame, most: int = 3, stale_ms: int = 3_600_000) -> DataFrame:
    """The stream of task states over a stream of (task_id, event, ts, event_id)."""
    ship(events.sparkSession)
    return events.groupBy("task_id").transformWithStateInPandas(TaskMachine(most, stale_ms), outputStructType="task_id long, status string, attempts int", outputMode="Update", timeMode="ProcessingTime")

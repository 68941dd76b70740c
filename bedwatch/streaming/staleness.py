"""Silence alerts from timers.

The periodic check asks every time who was silent for too long, which reads the windows of all patients. Here every
patient has the time of the first check at which they can be overdue; new windows move it. The state of a patient is a few
values however much they send. Patients are kept in buckets by their id, with one timer for the next check that is due in
the bucket: each call of the state store takes longer than the work on a patient, so there are few calls for a batch.

Alerts are those of the periodic check at the instants of the settings' clock: opened at the first check that finds the
patient silent, resolved at the first one that finds windows again, never opened twice.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from bedwatch.config import ALERT_TYPE_STALE, DEFAULTS, Settings, TEXT_STALE
from bedwatch.session import timers_store
from bedwatch.sinks.tables import latest_rows, write_changes

# The processor, and what it uses, goes to the Python workers whole: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALERT_KEYS = ("patient_id", "triggered_at")
COMPACT_EVERY = 100
#: of patients; fixed for a checkpoint
BUCKETS = 256
#: stands for the clock among the patients; their own ids are never empty
CLOCK = ""
INPUT = "patient_id string, window_end timestamp, on_roster boolean, event_time timestamp"
OUTPUT = "patient_id string, triggered_at timestamp, resolved_at timestamp, acknowledged boolean"


class Checks(NamedTuple):
    """The instants of the checks: ``first`` (UTC) and every ``every_seconds`` after it, in milliseconds."""

    first: datetime
    every_seconds: int

    def at_or_after(self, ms: int) -> int:
        start = round(self.first.replace(tzinfo=timezone.utc).timestamp() * 1000)
        step = self.every_seconds * 1000
        return start + max(0, -(-(ms - start) // step)) * step


class Silence(NamedTuple):
    """A patient's state; times in milliseconds, -1 for none."""

    seen: int = -1  # end of the newest window known at the last check
    ahead: tuple[int, ...] = ()  # ends of windows that a later check will know of
    opened: int = -1  # check at which the open alert was raised
    listed: bool = False  # on the roster; others raise no alerts
    handled: int = -1  # last check that was dealt with

    def next_check(self, checks: Checks, limit: int) -> int | None:
        """When this patient has to be looked at again; None if only new windows can change anything."""
        if not self.listed:
            return None
        earliest = checks.at_or_after(max(self.handled + 1, 0))
        if self.opened >= 0:  # resolved by the first check that knows of a window
            return max(earliest, checks.at_or_after(self.ahead[0])) if self.ahead else None
        due = earliest
        if self.seen >= 0:
            due = max(due, checks.at_or_after(self.seen + limit + 1))
        for end in self.ahead:  # ascending; a window known by then puts the check off
            if end > due:
                break
            due = max(due, checks.at_or_after(end + limit + 1))
        return due

    def after_check(self, at: int, limit: int) -> tuple["Silence", tuple[int, int] | None]:
        """The state after the check at ``at``, and (opened, resolved or -1) if it changed the alert."""
        seen = max([self.seen, *(e for e in self.ahead if e <= at)])
        now = self._replace(seen=seen, ahead=tuple(e for e in self.ahead if e > at), handled=at)
        stale = seen < at - limit if seen >= 0 else True
        if stale and self.opened < 0:
            return now._replace(opened=at), (at, -1)
        if not stale and self.opened >= 0:
            return now._replace(opened=-1), (self.opened, at)
        return now, None


def silence_processor(checks: Checks, limit_ms: int) -> StatefulProcessor:
    """One event-time timer per bucket of patients, set to the next check of any of them."""

    class Processor(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("silences", "patients string, timer bigint")

        def _load(self) -> tuple[dict[str, tuple[Silence, int]], int]:
            """(each patient's silence and next check, the timer); -1 for none."""
            stored = self.state.get()
            if stored is None:
                return {}, -1
            patients, timer = stored
            return {name: (Silence(seen, tuple(ahead), opened, listed, handled), due)
                    for name, (seen, ahead, opened, listed, handled, due) in json.loads(patients).items()}, timer

        def _store(self, patients: dict[str, tuple[Silence, int]], timer: int) -> None:
            due = min((due for _, due in patients.values() if due >= 0), default=-1)
            if due != timer:
                if timer >= 0:
                    self.handle.deleteTimer(timer)
                if due >= 0:
                    self.handle.registerTimer(due)
            self.state.update((json.dumps({name: (*silence, due) for name, (silence, due) in patients.items()}), due))

        def _due(self, silence: Silence) -> int:
            due = silence.next_check(checks, limit_ms)
            return -1 if due is None else due

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            patients, timer = self._load()
            windows: dict[str, set[int]] = {}
            listed: set[str] = set()
            for some in rows:
                some = some[some["patient_id"] != CLOCK]
                for name in some["patient_id"].tolist():
                    windows.setdefault(name, set())
                listed.update(some["patient_id"][some["on_roster"].astype(bool)].tolist())
                known = some[some["window_end"].notna()]
                ends = (known["window_end"].astype("datetime64[us]").astype("int64") // 1000).tolist()
                for name, end in zip(known["patient_id"].tolist(), ends):
                    windows[name].add(end)
            for name, new in windows.items():
                silence, _ = patients.get(name, (Silence(), -1))
                ends = sorted(e for e in new.union(silence.ahead) if e > silence.seen)
                # what the last check already knew about counts at once
                seen = max([silence.seen, *(e for e in ends if e <= silence.handled)])
                silence = silence._replace(seen=seen, ahead=tuple(e for e in ends if e > seen),
                                           listed=silence.listed or name in listed)
                patients[name] = silence, self._due(silence)
            if windows:
                self._store(patients, timer)
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            at = expiredTimerInfo.getExpiryTimeInMs()
            patients, timer = self._load()
            if at != timer:
                return
            now, changes = max(at, timerValues.getCurrentWatermarkInMs()), []
            for name, (silence, due) in patients.items():
                while 0 <= due <= now:
                    silence, change = silence.after_check(due, limit_ms)
                    due = self._due(silence)
                    if change:
                        changes.append((name, *change))
                patients[name] = silence, due
            self._store(patients, -1)
            if changes:
                names, opened, resolved = zip(*changes)
                yield pd.DataFrame({
                    "patient_id": names, "triggered_at": pd.to_datetime(opened, unit="ms"),
                    "resolved_at": pd.to_datetime([r if r >= 0 else None for r in resolved], unit="ms"),
                    "acknowledged": [r >= 0 for r in resolved]})

        def close(self) -> None:
            pass

    return Processor()


def _once_per_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each patient and window once per batch of rows, so that a patient who sends a lot is few rows to the timer."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["patient_id", "window_end", "on_roster"]).aggregate([("event_time", "max")])
        yield from table.rename_columns(["patient_id", "window_end", "on_roster", "event_time"]).to_batches()


def signs_of_life(readings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The windows that a stream of readings fills."""
    return readings.select(
        F.col("patient_id").cast("string").alias("patient_id"), F.window("event_time", cfg.window)["end"].alias("window_end"),
        F.lit(False).alias("on_roster"), "event_time")


def roster(patients: DataFrame, since: Column) -> DataFrame:
    """Patients to be watched from ``since`` on; one who never sends is silent from the first check."""
    return patients.select(
        F.col("patient_id").cast("string").alias("patient_id"), F.lit(None).cast("timestamp").alias("window_end"),
        F.lit(True).alias("on_roster"), since.cast("timestamp").alias("event_time"))


def clock(ticks: DataFrame, at: str = "at") -> DataFrame:
    """Instants that move the clock on when nobody sends."""
    return ticks.select(F.lit(CLOCK).alias("patient_id"), F.lit(None).cast("timestamp").alias("window_end"),
                        F.lit(False).alias("on_roster"), F.col(at).cast("timestamp").alias("event_time"))


def start_staleness(signs: DataFrame, path: str, checkpoint: str, checks: Checks, cfg: Settings = DEFAULTS,
                    trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Maintain the silence alerts under ``path`` from the union of ``signs_of_life``, ``roster`` and ``clock``.

    ``buckets`` says how many patients share a timer and is fixed for a checkpoint.
    """
    marked = signs.select("patient_id", "window_end", "on_roster", "event_time").filter(
        F.col("patient_id").isNotNull() & F.col("event_time").isNotNull()).mapInArrow(_once_per_window, INPUT)
    dealt = marked.withColumn("bucket", F.pmod(F.xxhash64("patient_id"), F.lit(buckets)))
    changes = dealt.withWatermark("event_time", cfg.watermark).groupBy("bucket").transformWithStateInPandas(
        silence_processor(checks, cfg.stale_after_seconds * 1000), OUTPUT, "Update", "EventTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy(*ALERT_KEYS).agg(F.max("resolved_at").alias("resolved_at"), F.bool_or("acknowledged").alias("acknowledged"))
        write_changes(last, path, batch_id, ALERT_KEYS, COMPACT_EVERY)

    with timers_store(signs.sparkSession):
        return (
            changes.writeStream.queryName("silences").outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": cfg.archive_trigger})).start()
        )


def read_silences(spark: SparkSession, path: str, patients: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The alerts raised so far in the form of the alert table."""
    named = patients.select(F.col("patient_id").cast("string").alias("patient_id"), "name")
    return latest_rows(spark, path, ALERT_KEYS).join(named, "patient_id").select(
        F.xxhash64("patient_id", F.lit(ALERT_TYPE_STALE), "triggered_at").alias("alert_id"), "patient_id",
        F.lit(ALERT_TYPE_STALE).alias("alert_type"), F.lit("WARNING").alias("severity"),
        F.format_string(TEXT_STALE, F.col("patient_id"), F.col("name"), F.lit(cfg.stale_after_seconds)).alias("message"),
        "triggered_at", "acknowledged")

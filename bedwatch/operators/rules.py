"""Alarm rules with hold times: a condition has to last before its alarm fires."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from bedwatch.config import DEFAULTS, Settings
from bedwatch.operators.neighbours import PART, with_neighbours

RULE_KEYS = ("rule", "subject")
WARD = "ward"


def _seconds(n) -> Column:
    return F.make_dt_interval(secs=n if isinstance(n, Column) else F.lit(n))


class Grid(NamedTuple):
    """The instants at which conditions are looked at: from ``first`` to ``last``, UTC datetimes, in equal steps."""

    first: datetime
    last: datetime
    every_seconds: int

    def _number(self, ts: Column) -> Column:
        """How many steps after the first instant ``ts`` lies, with fractions."""
        start = int(self.first.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000
        return (F.unix_micros(ts) - F.lit(start)) / F.lit(self.every_seconds * 1_000_000)

    def at_or_after(self, ts: Column) -> Column:
        return F.when(ts.isNotNull(), F.greatest(F.ceil(self._number(ts)), F.lit(0))).cast("long")

    def after(self, ts: Column) -> Column:
        return F.when(ts.isNotNull(), F.greatest(F.floor(self._number(ts)) + 1, F.lit(0))).cast("long")

    def time(self, tick: Column) -> Column:
        start = int(self.first.replace(tzinfo=timezone.utc).timestamp())
        return F.timestamp_seconds(F.lit(start) + tick * self.every_seconds)

    @property
    def size(self) -> int:
        return int((self.last - self.first).total_seconds()) // self.every_seconds + 1


def covered(intervals: DataFrame, subjects: list[str], grid: Grid, chunk: int = 4096) -> DataFrame:
    """(subject, at, n): how many of the intervals (subject, begin, end) hold at each tick, ``begin`` and ``end`` as numbers of ticks.

    ``end`` is not included, null is open. Intervals become steps up and down, which add up per tick before the shuffle; the
    running sum is taken inside chunks of ticks, and what the chunks before add up to is carried in.
    """
    spark = intervals.sparkSession
    step = F.struct(F.col("begin").alias("tick"), F.lit(1).cast("long").alias("step"))
    back = F.struct(F.col("end").alias("tick"), F.lit(-1).cast("long").alias("step"))
    steps = intervals.filter("end IS NULL OR end > begin").select("subject", F.inline(F.array(step, back))).filter(
        F.col("tick") < grid.size)
    zero = spark.range(grid.size).select(
        F.explode(F.array(*[F.lit(s) for s in subjects])).alias("subject"), F.col("id").alias("tick"), F.lit(0).cast("long").alias("step"))
    per_tick = steps.unionByName(zero).groupBy("subject", "tick").agg(F.sum("step").alias("step")).withColumn(
        "chunk", F.floor(F.col("tick") / chunk))
    totals = per_tick.groupBy("subject", "chunk").agg(F.sum("step").alias("step"))
    before = totals.select("subject", "chunk", (F.sum("step").over(Window.partitionBy("subject").orderBy("chunk"))
                                                - F.col("step")).alias("carried"))
    inside = F.sum("step").over(Window.partitionBy("subject", "chunk").orderBy("tick"))
    running = per_tick.withColumn("inside", inside).join(before, ["subject", "chunk"])
    return running.select("subject", grid.time(F.col("tick")).alias("at"), (F.col("inside") + F.col("carried")).alias("n"))


def _samples(rule: str, counted: DataFrame, active: Column) -> DataFrame:
    return counted.select(F.lit(rule).alias("rule"), "subject", "at", active.alias("active"))


def freshness_samples(heartbeats: DataFrame, grid: Grid, cfg: Settings = DEFAULTS) -> DataFrame:
    """At every tick: is a component's last sign of life older than its limit. One never heard of is silent."""
    limit = F.coalesce(*[F.when(F.col("component") == c, F.lit(n)) for c, n, _ in cfg.freshness_limits])
    fresh = heartbeats.withColumn("limit", limit).filter(F.col("limit").isNotNull() & F.col("recorded_at").isNotNull()).select(
        F.col("component").alias("subject"), grid.at_or_after(F.col("recorded_at")).alias("begin"),
        grid.after(F.col("recorded_at") + _seconds(F.col("limit"))).alias("end"))
    return _samples("stale", covered(fresh, [c for c, _, _ in cfg.freshness_limits], grid), F.col("n") == 0)


def patient_age_samples(windows: DataFrame, grid: Grid, cfg: Settings = DEFAULTS) -> DataFrame:
    """At every tick: has any patient seen so far been silent for longer than the limit."""
    order = Window.partitionBy("patient_id").orderBy("window_end")
    old = F.col("window_end") + _seconds(cfg.patient_age_limit_seconds)
    silent = windows.select("patient_id", "window_end", F.lead("window_end").over(order).alias("next")).filter(
        F.col("next").isNull() | (F.col("next") > old)).select(
        F.lit(WARD).alias("subject"), grid.after(old).alias("begin"), grid.at_or_after(F.col("next")).alias("end"))
    return _samples("patient_data_age", covered(silent, [WARD], grid), F.col("n") > 0)


def open_alert_samples(alerts: DataFrame, grid: Grid, severity: str = "CRITICAL", closed: str = "acked_at") -> DataFrame:
    """At every tick: is an alert of this severity open; ``closed`` is null for those that still are."""
    held = alerts.filter(F.col("severity") == severity).select(
        F.lit(WARD).alias("subject"), grid.at_or_after(F.col("triggered_at")).alias("begin"),
        grid.at_or_after(F.col(closed)).alias("end"))
    return _samples("open_critical_alerts", covered(held, [WARD], grid), F.col("n") > 0)


def rate_samples(rates: DataFrame, window_seconds: int) -> DataFrame:
    """The alarm form of a windowed error rate, known when its window has ended; a window without traffic gives no sample."""
    return rates.select(
        F.lit("error_rate").alias("rule"), F.lit("vitals_producer").alias("subject"),
        (F.col("window_start") + _seconds(window_seconds)).alias("at"), F.col("exceeded").alias("active"))


def _activated(near: DataFrame, gap: Column) -> DataFrame:
    """Active samples with ``active_at``, the first sample of the island they belong to.

    Inside a partition that is a running minimum of islands' starts. An island that reaches in from the partition
    before has its start carried in: over the edges, which are few, the last start at which a partition was not one single
    island joined to the one before it.
    """
    joined = F.col("before.active") & (F.col("before.at") >= F.col("at") - gap)
    rows = near.filter("active").withColumn("_starts", ~F.coalesce(joined, F.lit(False)))
    inside = Window.partitionBy(*RULE_KEYS, PART).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.last(F.when(F.col("_starts"), F.col("at")), ignorenulls=True).over(inside))
    # per partition: the start of its last island (null if that one came in from before)
    tails = rows.groupBy(*RULE_KEYS, PART).agg(F.max("_own").alias("_tail"))
    across = Window.partitionBy(*RULE_KEYS).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("_carried", F.last("_tail", ignorenulls=True).over(across)).select(
        *[F.col(k).alias(f"_tail_{k}") for k in RULE_KEYS], F.col(PART).alias("_tail_part"), "_carried")
    same = (F.col(PART) == F.col("_tail_part"))
    for k in RULE_KEYS:
        same = same & (F.col(k) == F.col(f"_tail_{k}"))
    return rows.join(carried, same).withColumn("active_at", F.coalesce("_own", "_carried"))


def rule_states(samples: DataFrame, holds: DataFrame, as_of: Column, gap_seconds: int) -> DataFrame:
    """One row per time a condition held: when it became active, fired and ended, and its state as of ``as_of``.

    ``samples`` are (rule, subject, at, active), ``holds`` (rule, subject, hold_seconds, severity), one row each;
    samples without a hold are not alarmed. Samples after ``as_of`` are not known yet; of samples of one
    instant an active one counts; a null condition counts as not active.

    Consecutive active samples no more than ``gap_seconds`` apart are one island, so missing samples are tolerated for that
    long. It is *pending* at first and *firing* from the first sample that is ``hold_seconds`` or more after it began (at once
    for 0). It ends with the first sample that is not active, or ``gap_seconds`` after its last sample if none follows
    by then; an ended one is *resolved* if it had fired, else it was *dropped* and never alarmed.

    A rule may have any number of samples: they are range-partitioned by rule, subject and time, and islands are stitched over
    the borders.
    """
    now, gap = as_of.cast("timestamp"), _seconds(gap_seconds)
    known = samples.filter((F.col("at") <= now) & F.col("rule").isNotNull() & F.col("subject").isNotNull()).groupBy(
        *RULE_KEYS, "at").agg(F.coalesce(F.bool_or("active"), F.lit(False)).alias("active"))
    near = with_neighbours(known, RULE_KEYS, ["at"], ["active"], "rule-samples")
    rows = _activated(near, gap).join(holds, list(RULE_KEYS))
    held = F.col("at") >= F.col("active_at") + _seconds(F.col("hold_seconds"))
    islands = rows.groupBy(*RULE_KEYS, "severity", "active_at").agg(
        F.min(F.when(held, F.col("at"))).alias("fired_at"), F.max("at").alias("last_active_at"),
        F.max_by("after", "at").alias("_after"), F.count("*").alias("samples"))
    over = F.col("last_active_at") + gap
    ended = F.when(F.col("_after.at") <= over, F.col("_after.at")).when(over < now, over)
    state = (F.when(ended.isNull() & F.col("fired_at").isNull(), F.lit("pending")).when(ended.isNull(), F.lit("firing"))
             .when(F.col("fired_at").isNull(), F.lit("dropped")).otherwise(F.lit("resolved")))
    return islands.select(*RULE_KEYS, "severity", "active_at", "fired_at", "last_active_at", ended.alias("ended_at"),
                          "samples", state.alias("state"))


def rule_transitions(states: DataFrame) -> DataFrame:
    """(rule, subject, severity, at, state): every change of an alarm's state, in the order in which they are told.

    A condition that became active is pending; it changes to firing and resolved, or is dropped.
    """
    steps = F.array(
        F.struct(F.col("active_at").alias("at"), F.lit(0).alias("step"), F.lit("pending").alias("state")),
        F.struct(F.col("fired_at").alias("at"), F.lit(1).alias("step"), F.lit("firing").alias("state")),
        F.struct(F.col("ended_at").alias("at"), F.lit(2).alias("step"),
                 F.when(F.col("fired_at").isNull(), F.lit("dropped")).otherwise(F.lit("resolved")).alias("state")))
    return states.select(*RULE_KEYS, "severity", F.inline(F.filter(steps, lambda s: s["at"].isNotNull())))


def holds_of(spark, cfg: Settings = DEFAULTS) -> DataFrame:
    """The hold times of the settings beside the severities of their rules."""
    severity = {("stale", c): s for c, _, s in cfg.freshness_limits}
    return spark.createDataFrame(
        [(rule, subject, hold, severity.get((rule, subject), "critical")) for rule, subject, hold in cfg.rule_holds],
        "rule string, subject string, hold_seconds int, severity string")

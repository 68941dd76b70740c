"""Alert episodes: breaches of one vital of one patient merged while gaps stay short.

An episode is a run of breaches whose gaps do not exceed the cooldown, not
interrupted by an acknowledgement. It opens as WARNING and is CRITICAL once
confirmed: enough repeats, or any reading after the first at a critical level.

The work is done in two steps so that no task ever sees all breaches of a hot
patient. Breaches in one time bucket of cooldown length are at most one
cooldown apart, so they always belong together: plain aggregation, combined
before the shuffle, shrinks each bucket to one summary. Only the summaries, at
most one per cooldown of wall time and key, are then ordered and chained.
Buckets that contain an acknowledgement are summarised per timestamp instead,
so that the acknowledgement can cut between any two breaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bedwatch.config import ALERT_TYPE_VITAL, DEFAULTS, Settings
from bedwatch.functions.vitals import breach_candidates, breach_message, breaches_any

BREACH_KEYS = ("patient_id", "vital_name")

ACK_COLUMNS = ("alert_id", "patient_id", "vital_name", "triggered_at", "acked_at")


def breach_events(readings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per reading and breached rule; event time at millisecond precision.

    Clean readings are dropped by a plain filter at the scan. The fixed slots
    are exploded in their outer form and filtered, which stays in generated
    code; filtering the array with a lambda would not.
    """
    return (
        readings.filter(breaches_any(cfg))
        .select("patient_id", "event_id", F.date_trunc("millisecond", "event_time").alias("event_time"),
                F.explode_outer(breach_candidates(cfg)).alias("b"))
        .filter(F.col("b").isNotNull())
        .select("patient_id", "event_id", "event_time", "b.*")
    )


def with_message(breaches: DataFrame) -> DataFrame:
    return breaches.withColumn("message", breach_message(
        F.col("vital_name"), F.col("vital_value"), F.col("threshold_value"), F.col("above")))


def collapse_breaches(breaches: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per patient and vital: count, any critical, and a representative reading.

    The representative is the last critical reading, or the first reading when
    none is critical.
    """
    order = F.struct("event_time", "event_id")
    row = F.struct("event_time", "event_id", "vital_value", "threshold_value", "above", "severity")
    critical = F.col("severity") == "CRITICAL"
    return (
        breaches.groupBy(*BREACH_KEYS)
        .agg(
            F.count("*").alias("occurrences"),
            F.bool_or(critical).alias("any_critical"),
            F.coalesce(F.max_by(row, F.when(critical, order)), F.min_by(row, order)).alias("r"),
        )
        .select(*BREACH_KEYS, "occurrences", "any_critical", "r.*")
    )


# ---- step 1: summaries ---------------------------------------------------

def _bucket(ts, cfg: Settings):
    return F.floor(F.unix_micros(ts) / F.lit(cfg.cooldown_seconds * 1_000_000))


def _summarise(breaches: DataFrame, *slots: str) -> DataFrame:
    critical = (F.col("severity") == "CRITICAL").cast("int")
    return (
        breaches.groupBy(*BREACH_KEYS, *slots)
        .agg(
            F.min(F.struct("event_time", "event_id", "threshold_value", critical.alias("critical"))).alias("first"),
            F.max(F.struct("event_time", "event_id", "vital_value", "threshold_value", "above")).alias("last"),
            F.count("*").alias("n"),
            F.sum(critical).alias("n_critical"),
        )
        .drop(*slots)
    )


def breach_summaries(breaches: DataFrame, acks: DataFrame | None = None,
                     cfg: Settings = DEFAULTS) -> DataFrame:
    """Mergeable summaries of breaches that are certain to belong together."""
    bucketed = breaches.withColumn("_bucket", _bucket(F.col("event_time"), cfg))
    if acks is None:
        return _summarise(bucketed, "_bucket")
    keys = [*BREACH_KEYS, "_bucket"]
    cut = acks.select(*BREACH_KEYS, _bucket(F.col("acked_at"), cfg).alias("_bucket")).distinct()
    # Acknowledgements are made by people, so this side is small and AQE sees its size before it picks the join;
    # should it be large, the join shuffles and AQE splits hot keys.
    slot = F.when(F.col("_cut"), F.unix_micros("event_time"))
    marked = bucketed.join(cut.withColumn("_cut", F.lit(True)), keys, "left").withColumn("_slot", slot)
    return _summarise(marked, "_bucket", "_slot")


# ---- step 2: chaining ----------------------------------------------------

def chain_summaries(summaries: DataFrame, acks: DataFrame | None = None,
                    cfg: Settings = DEFAULTS) -> DataFrame:
    """Adds ``_run`` and ``_acked``: the episode number of each summary within its key.

    An acknowledgement only closes the episode it names: it counts when no new
    run has started between that episode's first breach and itself.
    """
    gap = cfg.cooldown_seconds * 1_000_000
    rows = summaries.withColumns({
        "_time": F.col("first.event_time"), "_until": F.col("last.event_time"),
        "_is_ack": F.lit(False), "_names": F.lit(None).cast("timestamp"), "_new_ack": F.lit(False),
    })
    if acks is not None:
        first_acks = acks.groupBy(*BREACH_KEYS, "triggered_at").agg(
            F.min("acked_at").alias("_time"), F.bool_and(F.col("alert_id").isNotNull()).alias("_new_ack"))
        marks = first_acks.select(*BREACH_KEYS, "_time", F.col("triggered_at").alias("_names"),
                                  F.lit(True).alias("_is_ack"), "_new_ack")
        rows = rows.unionByName(marks, allowMissingColumns=True)
    # A breach at the same instant as an acknowledgement comes first.
    ordered = Window.partitionBy(*BREACH_KEYS).orderBy("_time", "_is_ack", "first.event_id", "_until")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max("_until").over(before)
    starts = ~F.col("_is_ack") & (
        F.col("_reach").isNull() | (F.unix_micros("_time") - F.unix_micros("_reach") > gap))
    return (
        rows.withColumn("_reach", reach)
        .withColumn("_starts", starts)
        .withColumns({
            "_run_start": F.max(F.when(F.col("_starts"), F.col("_time"))).over(upto),
            "_gap_no": F.sum(F.col("_starts").cast("long")).over(upto),
        })
        .withColumn("_cuts", F.coalesce(F.col("_is_ack") & (F.col("_run_start") <= F.col("_names")), F.lit(False)))
        .withColumn("_cut_no", F.sum(F.col("_cuts").cast("long")).over(upto))
        # An acknowledgement belongs to the episode it closes, later breaches to the next.
        .withColumn("_run", F.struct("_gap_no", (F.col("_cut_no") - F.col("_cuts").cast("long")).alias("_cut_no")))
    )


def _alert_id(triggered_at):
    return F.xxhash64(F.col("patient_id").cast("string"), F.lit(ALERT_TYPE_VITAL), "vital_name", triggered_at)


def merge_summaries(summaries: DataFrame, acks: DataFrame | None = None,
                    cfg: Settings = DEFAULTS) -> DataFrame:
    """Episodes in mergeable form: the same columns as a summary, one row per episode.

    The aggregation runs on the partitioning of the ordering window, so this
    is one shuffle in total.
    """
    chained = chain_summaries(summaries, acks, cfg)
    return (
        chained.filter(~F.col("_is_ack")).groupBy(*BREACH_KEYS, "_run")
        .agg(
            F.min("first").alias("first"), F.max("last").alias("last"),
            F.sum("n").alias("n"), F.sum("n_critical").alias("n_critical"),
        )
        .drop("_run")
    )


def episode_rows(merged: DataFrame, cfg: Settings = DEFAULTS, *carried: str) -> DataFrame:
    """Merged summaries as alert rows."""
    repeats_critical = F.col("n_critical") - F.col("first.critical") > 0
    confirmed = (F.col("n") >= cfg.escalate_after) | repeats_critical
    return merged.select(
        _alert_id(F.col("first.event_time")).alias("alert_id"),
        "patient_id",
        F.lit(ALERT_TYPE_VITAL).alias("alert_type"),
        F.when(confirmed, F.lit("CRITICAL")).otherwise(F.lit("WARNING")).alias("severity"),
        breach_message(F.col("vital_name"), F.col("last.vital_value"), F.col("last.threshold_value"),
                       F.col("last.above")).alias("message"),
        "vital_name",
        F.col("last.vital_value").alias("vital_value"),
        F.col("first.threshold_value").alias("threshold_value"),
        F.col("first.event_time").alias("triggered_at"),
        F.col("last.event_time").alias("last_seen_at"),
        F.col("n").alias("occurrences"),
        F.col("last.event_id").cast("string").alias("event_id"),
        *carried,
    )


def alert_episodes(breaches: DataFrame, acks: DataFrame | None = None,
                   cfg: Settings = DEFAULTS) -> DataFrame:
    """All alert episodes of a set of breaches, optionally cut by acknowledgements."""
    return episode_rows(merge_summaries(breach_summaries(breaches, acks, cfg), acks, cfg), cfg)

"""Streaming alerts: the batch episode merge applied to each micro-batch and the open episodes.

Per-key Python state would bring all breaches of a patient's vital through one
task. Episodes are mergeable instead: a micro-batch is reduced to summaries
inside the JVM before any shuffle, chained with the episodes that can still
grow, and written back. Results do not depend on how the input was cut into
micro-batches or on the order of rows, as long as a reading is not later than
the watermark.

Open episodes are a change log with one row per patient and vital, in buckets by key:
batch N reads the buckets of the keys it touches as they were before N and stores those
keys anew, other keys stay as they are and other buckets are not read. A replayed batch therefore sees the same
state again, and its change folders are rewritten, not appended to.

An episode leaves the state by its own key's clock: after ``IDLE_BATCHES`` batches
in a row in which even the oldest breach of the key was too late to reach it. What
other patients send has no influence, and a single reading dated ahead neither.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from bedwatch.config import DEFAULTS, Settings
from bedwatch.operators.alerts import with_acknowledged
from bedwatch.operators.episodes import (
    ACK_COLUMNS, BREACH_KEYS, breach_events, breach_summaries, chain_summaries, episode_rows,
)
from bedwatch.sinks.buckets import BucketLog
from bedwatch.sinks.tables import has_changes, latest_rows, write_changes

_SUMMARY = ("first", "last", "n", "n_critical")

ALERT_KEYS = ("alert_id",)
IDLE_BATCHES = 3
COMPACT_EVERY = 100


def alert_inputs(readings: DataFrame, acks: DataFrame | None = None, cfg: Settings = DEFAULTS) -> DataFrame:
    """One stream carrying breaches and, if given, acknowledgements."""
    breaches = breach_events(readings, cfg).withColumn("kind", F.lit("breach"))
    if acks is None:
        return breaches
    marks = acks.select(*ACK_COLUMNS, F.lit("ack").alias("kind"))
    return breaches.unionByName(marks, allowMissingColumns=True)


def _delay(cfg: Settings):
    return F.expr(f"INTERVAL {cfg.watermark}") + F.make_dt_interval(secs=F.lit(cfg.cooldown_seconds))


def _state_log(path: str, cfg: Settings) -> BucketLog:
    return BucketLog(f"{path}/state", BREACH_KEYS, cfg.state_buckets, COMPACT_EVERY)


def _state_schema(summaries: DataFrame) -> T.StructType:
    """Keys, and the episodes that can still grow."""
    episode = [*(summaries.schema[c] for c in _SUMMARY), T.StructField("acked_at", T.TimestampType()),
               T.StructField("idle", T.IntegerType())]
    return T.StructType([*(summaries.schema[k] for k in BREACH_KEYS),
                         T.StructField("episodes", T.ArrayType(T.StructType(episode)))])


def _state_before(log: BucketLog, rows: DataFrame, batch_id: int, schema: T.StructType) -> DataFrame | None:
    """The stored episodes of the keys in ``rows`` as of the batch before; only the buckets of these keys are read."""
    spark = rows.sparkSession
    touched = sorted(r["bucket"] for r in rows.select(log.bucket().alias("bucket")).distinct().collect())  # the buckets at most
    known = log.read(spark, schema, touched, batch_id) if touched else None
    if known is None:
        return None
    return known.join(rows.select(*BREACH_KEYS), list(BREACH_KEYS), "left_semi").select(*BREACH_KEYS, F.inline("episodes"))


def _kept(merged: DataFrame, cfg: Settings) -> DataFrame:
    """State rows of the touched keys: what can still grow, and how long it has not been in reach."""
    oldest = F.min("_oldest").over(Window.partitionBy(*BREACH_KEYS))
    beyond = oldest > F.col("last.event_time") + _delay(cfg)
    idle = F.when(F.col("_oldest").isNotNull(), 0).when(oldest.isNull(), F.coalesce("_idle", F.lit(0))).when(
        beyond, F.coalesce("_idle", F.lit(0)) + 1).otherwise(0)
    alive = merged.withColumn("idle", idle).filter(F.col("idle") < IDLE_BATCHES)
    return alive.groupBy(*BREACH_KEYS).agg(
        F.collect_list(F.struct(*_SUMMARY, "acked_at", "idle")).alias("episodes"))


def _merge(summaries: DataFrame, state: DataFrame | None, acks: DataFrame | None, cfg: Settings) -> DataFrame:
    """Episodes after this batch, with the starts they were known by before."""
    rows = summaries.withColumns({"_known": F.lit(None).cast("timestamp"), "_idle": F.lit(None).cast("int")})
    if state is not None:
        rows = rows.unionByName(state.select(
            *BREACH_KEYS, *_SUMMARY, F.col("first.event_time").alias("_known"), F.col("idle").alias("_idle")))
    new = ~F.col("_is_ack") & F.col("_known").isNull()
    return (
        chain_summaries(rows, acks, cfg).groupBy(*BREACH_KEYS, "_run")
        .agg(
            F.min("first").alias("first"), F.max("last").alias("last"),
            F.sum("n").alias("n"), F.sum("n_critical").alias("n_critical"),
            F.min(F.when(F.col("_cuts"), F.col("_time"))).alias("acked_at"),
            F.bool_or(new).alias("_grown"),
            F.min(F.when(new, F.col("_time"))).alias("_oldest"),  # null if this batch adds nothing
            F.max("_idle").alias("_idle"),
            F.bool_or(F.col("_cuts") & F.col("_new_ack")).alias("_closed"),
            # Episodes still kept for a key lie more than a cooldown apart, so few can merge.
            F.collect_set("_known").alias("_knowns"),
        )
        .filter(F.col("n").isNotNull())
        .withColumn("_changed", F.col("_grown") | F.coalesce("_closed", F.lit(False)))
        .drop("_run", "_grown", "_closed")
    )


def alert_writer(path: str, cfg: Settings = DEFAULTS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function maintaining the alerts under ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Without acknowledgements the state has no say in the summaries: they are made in one pass over the
        # batch, and kept in its place.
        acked = "acked_at" in batch.columns
        rows = batch if acked else breach_summaries(batch.filter("kind = 'breach'"), None, cfg)
        rows = rows.persist(StorageLevel.DISK_ONLY)
        try:
            _write_batch(rows, acked, batch_id)
        finally:
            rows.unpersist()

    def _write_batch(rows: DataFrame, acked: bool, batch_id: int) -> None:
        """``rows`` are the batch if it has acknowledgements, else its summaries."""
        log, spark = _state_log(path, cfg), rows.sparkSession
        plain = breach_summaries(rows.filter("kind = 'breach'"), None, cfg) if acked else rows
        state = _state_before(log, rows, batch_id, _state_schema(plain))
        acks = None
        if acked:
            acks = rows.filter("kind = 'ack'").select(*ACK_COLUMNS)
            write_changes(acks, f"{path}/acks", batch_id, (*ALERT_KEYS, "acked_at"), COMPACT_EVERY)
            if state is not None:
                kept = state.filter(F.col("acked_at").isNotNull()).select(
                    *BREACH_KEYS, F.col("first.event_time").alias("triggered_at"), "acked_at")
                acks = acks.unionByName(kept, allowMissingColumns=True)
        summaries = breach_summaries(rows.filter("kind = 'breach'"), acks, cfg) if acked else rows
        merged = _merge(summaries, state, acks, cfg).persist(StorageLevel.DISK_ONLY)
        gone = merged.select("*", F.explode("_knowns").alias("_old")).filter(
            F.col("_old") != F.col("first.event_time"))
        changes = episode_rows(merged.filter("_changed"), cfg, "acked_at").withColumn("deleted", F.lit(False))
        removed = episode_rows(
            gone.withColumn("first", F.col("first").withField("event_time", F.col("_old"))), cfg, "acked_at",
        ).withColumn("deleted", F.lit(True))
        write_changes(changes.unionByName(removed), path, batch_id, ALERT_KEYS, COMPACT_EVERY)
        log.write(_kept(merged, cfg), batch_id)
        merged.unpersist()

    return write


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Current alerts with their acknowledged flag.

    An acknowledgement of an alert that could no longer grow is only in the
    acknowledgement log; the others are on the alert itself.
    """
    acks = None
    if has_changes(spark, f"{path}/acks", 1 << 62):
        acks = latest_rows(spark, f"{path}/acks", (*ALERT_KEYS, "acked_at"))
    alerts = with_acknowledged(latest_rows(spark, path, ALERT_KEYS), acks)
    return alerts.withColumn(
        "acknowledged", F.col("acknowledged") | F.col("acked_at").isNotNull()).drop("acked_at")

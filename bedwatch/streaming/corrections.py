"""Late readings put right.

The window query drops a reading whose window the watermark has closed; the archive keeps it. A query over the archive finds
such readings, keeps them in a log of their own, and computes their windows, and the daily features of their patient, anew
from the archive. Only the windows and days touched are read: their dates prune the archive's partitions.

What counts as closed is decided by the newest reading archived so far, the present batch included. The window query had
seen no newer reading when it dropped one, however differently it cuts its batches, so no dropped reading is missed; a
window that was complete is at most computed once more, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from bedwatch.config import DEFAULTS, Settings
from bedwatch.operators.features import assign_aligned_day, daily_features
from bedwatch.operators.windows import window_aggregates
from bedwatch.session import stage, temporary_stages
from bedwatch.sinks.tables import has_changes, latest_rows, write_changes
from bedwatch.sources.readings import dedupe_readings

WINDOW_KEYS = ("patient_id", "window_start")
DAY_KEYS = ("patient_id", "simulated_day")
COMPACT_EVERY = 100


def _clock(spark: SparkSession, path: str, batch: DataFrame, batch_id: int):
    """The newest event time archived so far; kept per batch, so that a batch run again finds the same."""
    newest = batch.agg(F.max("event_time").alias("newest"))
    if has_changes(spark, path, batch_id):
        newest = newest.unionByName(latest_rows(spark, path, ["clock"], batch_id).select("newest")).agg(F.max("newest").alias("newest"))
    write_changes(newest.select(F.lit(0).alias("clock"), "newest").coalesce(1), path, batch_id, ["clock"], COMPACT_EVERY)
    return newest.first()["newest"]


def _of_patients(archive: DataFrame, touched: DataFrame, first: str, last: str) -> DataFrame:
    """Archived readings of the touched patients on the touched dates: two scalars and the dates prune partitions."""
    dates = touched.select("patient_id", F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("event_date")).distinct()
    low, high = dates.agg(F.min("event_date"), F.max("event_date")).first()
    return archive.filter(F.col("event_date").between(F.lit(low), F.lit(high))).join(
        dates, ["patient_id", "event_date"], "left_semi")


def correction_writer(folders, cfg: Settings = DEFAULTS, unique: bool = False,
                      origin: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over the archive that maintains the logs under ``folders.corrections``."""
    path = folders.corrections

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            with temporary_stages(batch.sparkSession):
                _correct(batch.sparkSession, batch, batch_id)
        finally:
            batch.unpersist()

    def _correct(spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        newest = _clock(spark, f"{path}/clock", batch, batch_id)
        if newest is None:
            return
        closed = F.lit(newest) - F.expr(f"INTERVAL {cfg.watermark}")
        late = batch.withColumn("_w", F.window("event_time", cfg.window)).filter(F.col("_w.end") <= closed)
        late = late.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        late = spark.read.schema(late.schema).parquet(f"{path}/late/batch_id={batch_id}")
        if late.isEmpty():
            return
        archive = spark.read.schema(batch.schema).parquet(folders.archive)
        touched = stage(late.select(*WINDOW_KEYS, "window_end").distinct(), "touched-windows")
        rows = _of_patients(archive, touched, "window_start", "window_end")
        rows = rows.withColumn("window_start", F.window("event_time", cfg.window)["start"]).join(
            touched, list(WINDOW_KEYS), "left_semi").drop("window_start")
        write_changes(window_aggregates(dedupe_readings(rows) if unique else rows, cfg),
                      f"{path}/windows", batch_id, WINDOW_KEYS, COMPACT_EVERY)
        if origin is not None:
            days = assign_aligned_day(late, origin, cfg).select(*DAY_KEYS, "period_start").distinct()
            days = stage(days.withColumn("period_end", F.col("period_start") + F.make_dt_interval(
                secs=F.lit(cfg.period_seconds))), "touched-days")
            rows = assign_aligned_day(dedupe_readings(_of_patients(archive, days, "period_start", "period_end")), origin, cfg)
            write_changes(daily_features(rows.join(days.select(*DAY_KEYS), list(DAY_KEYS), "left_semi"), cfg),
                          f"{path}/features", batch_id, DAY_KEYS, COMPACT_EVERY)

    return write


def _current(spark: SparkSession, path: str, keys) -> DataFrame | None:
    return latest_rows(spark, path, keys) if has_changes(spark, path, 1 << 62) else None


def corrected_windows(spark: SparkSession, folders) -> DataFrame | None:
    """Windows computed anew since they closed; None if there are none."""
    return _current(spark, f"{folders.corrections}/windows", WINDOW_KEYS)


def corrected_features(spark: SparkSession, folders, features: DataFrame) -> DataFrame:
    """Daily features with those of corrected patients and days in place of the ones computed before."""
    corrected = _current(spark, f"{folders.corrections}/features", DAY_KEYS)
    if corrected is None:
        return features
    return features.join(corrected.select(*DAY_KEYS), list(DAY_KEYS), "left_anti").unionByName(
        corrected.select(*features.columns))


def late_readings(spark: SparkSession, folders) -> DataFrame:
    """Every reading that arrived when its window may have been closed, with the batch it came in."""
    return spark.read.parquet(f"{folders.corrections}/late")

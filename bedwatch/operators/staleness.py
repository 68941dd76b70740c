"""Patients without recent data, and the alerts that follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bedwatch.config import ALERT_TYPE_STALE, DEFAULTS, Settings, TEXT_STALE
from bedwatch.functions.numeric import age_seconds


def last_seen(windows: DataFrame) -> DataFrame:
    return windows.groupBy("patient_id").agg(F.max("window_end").alias("last_seen"))


def stale_patients(patients: DataFrame, windows: DataFrame, as_of: Column,
                   cfg: Settings = DEFAULTS) -> DataFrame:
    """Patients never seen, or last seen strictly longer ago than the limit."""
    limit = as_of.cast("timestamp") - F.make_dt_interval(secs=F.lit(cfg.stale_after_seconds))
    return (
        patients.select("patient_id", "name")
        .join(last_seen(windows), "patient_id", "left")
        .filter(F.col("last_seen").isNull() | (F.col("last_seen") < limit))
    )


def _open_stale(alerts: DataFrame) -> DataFrame:
    return alerts.filter((F.col("alert_type") == ALERT_TYPE_STALE) & ~F.col("acknowledged"))


def _by_text(stale: DataFrame) -> DataFrame:
    """Alert tables key patients by text, since system alerts share the column."""
    return stale.withColumn("patient_id", F.col("patient_id").cast("string"))


def new_staleness_alerts(stale: DataFrame, alerts: DataFrame, as_of: Column,
                         cfg: Settings = DEFAULTS) -> DataFrame:
    """One alert per stale patient that has none open."""
    fresh = _by_text(stale).join(
        _open_stale(alerts).select("patient_id").distinct(), "patient_id", "left_anti")
    return fresh.select(
        F.xxhash64("patient_id", F.lit(ALERT_TYPE_STALE), as_of.cast("timestamp")).alias("alert_id"),
        "patient_id",
        F.lit(ALERT_TYPE_STALE).alias("alert_type"),
        F.lit("WARNING").alias("severity"),
        F.format_string(TEXT_STALE, F.col("patient_id"), F.col("name"),
                        F.lit(cfg.stale_after_seconds)).alias("message"),
        as_of.cast("timestamp").alias("triggered_at"),
        F.lit(False).alias("acknowledged"),
    )


def resolved_staleness(alerts: DataFrame, stale: DataFrame) -> DataFrame:
    """Open staleness alerts whose patient sends data again."""
    return _open_stale(alerts).join(_by_text(stale).select("patient_id"), "patient_id", "left_anti")


def after_check(alerts: DataFrame, stale: DataFrame, as_of: Column,
                cfg: Settings = DEFAULTS) -> DataFrame:
    """The alert table after one staleness check: resolved ones closed, new ones opened."""
    resolved = resolved_staleness(alerts, stale).select("alert_id", F.lit(True).alias("_resolved"))
    closed = alerts.join(resolved, "alert_id", "left").withColumn(
        "acknowledged", F.col("acknowledged") | F.coalesce("_resolved", F.lit(False))).drop("_resolved")
    return closed.unionByName(new_staleness_alerts(stale, alerts, as_of, cfg), allowMissingColumns=True)


def stalest_age(windows: DataFrame, as_of: Column) -> DataFrame:
    """Age in seconds of the patient seen longest ago; -1 when nobody was ever seen."""
    oldest = last_seen(windows).agg(F.min("last_seen").alias("oldest"))
    return oldest.select(
        F.coalesce(age_seconds(F.col("oldest"), as_of.cast("timestamp")), F.lit(-1)).alias("age_seconds"))

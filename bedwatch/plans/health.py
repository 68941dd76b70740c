"""Health summary: every check in one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bedwatch.config import DEFAULTS, Settings
from bedwatch.operators.health import error_rate, error_rate_alert
from bedwatch.operators.staleness import new_staleness_alerts, stale_patients


def all_checks(patients: DataFrame, windows: DataFrame, metrics: DataFrame, alerts: DataFrame,
               as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """New alerts of every check, ready to append to the alert table."""
    stale = new_staleness_alerts(stale_patients(patients, windows, as_of, cfg), alerts, as_of, cfg)
    errors = error_rate_alert(error_rate(metrics), alerts, as_of, cfg)
    return stale.unionByName(errors)


def health_summary(patients: DataFrame, windows: DataFrame, metrics: DataFrame, as_of: Column,
                   cfg: Settings = DEFAULTS) -> DataFrame:
    """Condition per check, degraded while it lasts (not only when it starts)."""
    stale = stale_patients(patients, windows, as_of, cfg).agg(
        F.count("*").cast("double").alias("value")).select(
        F.lit("stale_patients").alias("check"), "value", F.lit(0.0).alias("limit"))
    errors = error_rate(metrics).select(
        F.lit("error_rate").alias("check"), F.col("error_rate").alias("value"),
        F.lit(cfg.error_rate_limit).alias("limit"))
    return stale.unionByName(errors).withColumn(
        "status", F.when(F.col("value") > F.col("limit"), F.lit("degraded")).otherwise(F.lit("healthy")))


def metric_snapshot(metrics: DataFrame) -> DataFrame:
    """Latest value of every metric."""
    return metrics.groupBy("component", "metric_name").agg(
        F.max(F.struct("recorded_at", "metric_value")).alias("p")
    ).select("component", "metric_name", "p.metric_value", "p.recorded_at")

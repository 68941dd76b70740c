"""Rates, freshness and totals of the data flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bedwatch.config import (
    ALERT_TYPE_ERRORS, DEFAULTS, RISK_LEVELS, SYSTEM_PATIENT, Settings, TEXT_ERRORS,
)
from bedwatch.functions.numeric import age_seconds, round_to, seconds_between
from bedwatch.operators.counters import COUNTER_KEYS, per_window


def error_rate(metrics: DataFrame, errors: str = "send_errors", total: str = "records_sent") -> DataFrame:
    """Errors, total and their ratio over a metric table; no total gives a null rate."""
    value, name = F.col("metric_value"), F.col("metric_name")
    return metrics.agg(
        F.coalesce(F.sum(F.when(name == errors, value)), F.lit(0.0)).alias("errors"),
        F.coalesce(F.sum(F.when(name == total, value)), F.lit(0.0)).alias("total"),
    ).withColumn("error_rate", F.try_divide("errors", "total"))


def windowed_error_rate(metrics: DataFrame, window_seconds: int, cfg: Settings = DEFAULTS,
                        errors: str = "send_errors", total: str = "records_sent") -> DataFrame:
    """The ratio per time window, and whether the alarm form of it is above the limit.

    The alarm divides the two rates per second and never divides by less than
    ``min_records_per_second``, so that a trickle of records raises no alarm.
    """
    value, name = F.col("metric_value"), F.col("metric_name")
    per_second = F.lit(float(window_seconds))
    return (
        metrics.groupBy(F.window("recorded_at", f"{window_seconds} seconds").alias("w"))
        .agg(
            F.coalesce(F.sum(F.when(name == errors, value)), F.lit(0.0)).alias("errors"),
            F.coalesce(F.sum(F.when(name == total, value)), F.lit(0.0)).alias("total"),
        )
        .select(
            F.col("w.start").alias("window_start"), "errors", "total",
            F.try_divide("errors", "total").alias("error_rate"),
            ((F.col("errors") / per_second)
             / F.greatest(F.col("total") / per_second, F.lit(cfg.min_records_per_second))).alias("alarm_rate"),
        )
        .withColumn("exceeded", F.col("alarm_rate") > cfg.error_rate_limit)
    )


def error_rate_alert(rate: DataFrame, alerts: DataFrame, as_of: Column,
                     cfg: Settings = DEFAULTS) -> DataFrame:
    """One CRITICAL system alert if the rate is above the limit and none is open.

    The single rate row and the number of open alerts are folded into one row
    by an aggregation, so there is no join without a key.
    """
    already = alerts.filter((F.col("alert_type") == ALERT_TYPE_ERRORS) & ~F.col("acknowledged")).agg(
        F.count("*").alias("open"))
    facts = rate.unionByName(already, allowMissingColumns=True).agg(*[
        F.max(c).alias(c) for c in ("errors", "total", "error_rate", "open")])
    return facts.filter((F.col("error_rate") > cfg.error_rate_limit) & (F.col("open") == 0)).select(
        F.lit(SYSTEM_PATIENT).alias("patient_id"),
        F.lit(ALERT_TYPE_ERRORS).alias("alert_type"),
        F.lit("CRITICAL").alias("severity"),
        F.format_string(TEXT_ERRORS, F.col("error_rate") * 100, F.col("errors").cast("long"),
                        F.col("total").cast("long"),
                        F.lit(cfg.error_rate_limit * 100)).alias("message"),
        as_of.cast("timestamp").alias("triggered_at"),
        F.lit(False).alias("acknowledged"),
    ).withColumn("alert_id", F.xxhash64("patient_id", "alert_type", "triggered_at"))


def throughput(metrics: DataFrame, window: str) -> DataFrame:
    """Increase per second of each counter, window by window.

    The increase is the sum of the steps since the last snapshot before the window, so restarts inside a
    window count as well; the first window of a counter has none.
    """
    rows = per_window(metrics, window)
    increase = F.when(F.col("before_at").isNotNull(), F.col("increase"))
    elapsed = seconds_between(F.col("before_at"), F.col("last.recorded_at"))
    return rows.select(
        *COUNTER_KEYS, "window_start", F.col("last.metric_value").alias("metric_value"), increase.alias("increase"),
        F.try_divide(increase, elapsed).alias("rate_per_second"))


def component_freshness(heartbeats: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """Age of each component's last heartbeat against its limit; a silent component is stale.

    Both sides have one row per component when they meet.
    """
    limits = heartbeats.sparkSession.createDataFrame(
        list(cfg.freshness_limits), "component string, limit_seconds int, severity string")
    seen = heartbeats.groupBy("component").agg(F.max("recorded_at").alias("last_seen"))
    age = age_seconds(F.col("last_seen"), as_of.cast("timestamp"))
    return (
        limits.join(seen, "component", "left")
        .withColumn("age_seconds", age)
        .withColumn("stale", F.coalesce(F.col("age_seconds") > F.col("limit_seconds"), F.lit(True)))
    )


def condition_checks(stalest: DataFrame, severities: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The two data conditions next to the heartbeats: an old patient and open critical alerts."""
    old = stalest.select(
        F.lit("patient_data_age").alias("check"), F.col("age_seconds").cast("double").alias("value"),
        F.lit(float(cfg.patient_age_limit_seconds)).alias("limit"))
    critical = severities.filter(F.col("severity") == "CRITICAL").select(
        F.lit("open_critical_alerts").alias("check"), F.col("open_alerts").cast("double").alias("value"),
        F.lit(0.0).alias("limit"))
    return old.unionByName(critical).withColumn("firing", F.col("value") > F.col("limit"))


def active_patients(patients: DataFrame) -> DataFrame:
    return patients.agg(F.count("*").alias("active_patients"))


def level_distribution(risk: DataFrame) -> DataFrame:
    """Patients per level on the latest day, zero-filled, and the day's mean score (0 if none).

    The latest day's rows are picked inside one aggregation keyed by day, so
    the table is read once.
    """
    per_day = risk.groupBy("simulated_day").agg(
        F.avg("combined_risk_score").alias("mean"),
        *[F.count_if(F.col("risk_level") == level).alias(level) for level in RISK_LEVELS],
    )
    latest = per_day.agg(F.max_by(F.struct("*"), "simulated_day").alias("d"))
    levels = F.array(*[
        F.struct(F.lit(level).alias("risk_level"),
                 F.coalesce(F.col(f"d.{level}"), F.lit(0)).alias("patients"))
        for level in RISK_LEVELS
    ])
    return latest.select(
        F.explode(levels).alias("l"),
        F.coalesce(round_to(F.col("d.mean"), 2), F.lit(0.0)).alias("avg_combined_risk"),
    ).select("l.*", "avg_combined_risk")


def run_totals(labs: DataFrame, risk: DataFrame) -> DataFrame:
    """Totals of a run as metric rows: readings analysed, lab rows, reports, last scored day."""
    def as_rows(totals: DataFrame, *names: str) -> DataFrame:
        pairs = [part for n in names for part in (F.lit(n), F.col(n).cast("double"))]
        return totals.select(
            F.lit("batch_layer").alias("component"),
            F.explode(F.create_map(*pairs)).alias("metric_name", "metric_value"))

    scored = risk.agg(
        F.sum("readings_analyzed").alias("raw_readings_processed"),
        F.count("*").alias("risk_reports_written"),
        F.max("simulated_day").alias("last_simulated_day"),
    )
    ingested = labs.agg(F.count("*").alias("lab_records_ingested"))
    return as_rows(scored, *scored.columns).unionByName(as_rows(ingested, *ingested.columns))

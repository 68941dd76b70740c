"""Reading and acknowledging alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bedwatch.config import SEVERITIES

UNITED = ("alert_id", "patient_id", "alert_type", "severity", "message", "vital_name", "vital_value",
          "threshold_value", "triggered_at", "last_seen_at", "occurrences", "event_id", "acknowledged")


def unite_alerts(*tables: DataFrame) -> DataFrame:
    """Vital, staleness and error-rate alerts in one table with a text patient key.

    Columns a kind of alert does not have are null; alerts without the flag are open.
    """
    out = None
    for rows in tables:
        rows = rows.withColumn("patient_id", F.col("patient_id").cast("string"))
        if "acknowledged" not in rows.columns:
            rows = rows.withColumn("acknowledged", F.lit(False))
        rows = rows.select(*[c for c in UNITED if c in rows.columns])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def acknowledge(alerts: DataFrame, requests: DataFrame) -> DataFrame:
    """Acknowledgement rows for ``requests`` (alert_id, acked_at); unknown ids drop out (``acknowledge_answers`` tells of them).

    Alerts that are not about a vital have no vital name.
    """
    named = alerts if "vital_name" in alerts.columns else alerts.withColumn("vital_name", F.lit(None).cast("string"))
    return requests.join(
        named.select("alert_id", "patient_id", "vital_name", "triggered_at"), "alert_id"
    ).select("alert_id", "patient_id", "vital_name", "triggered_at", "acked_at")


def acknowledge_answers(alerts: DataFrame, requests: DataFrame) -> DataFrame:
    """An answer to every request (alert_id, acked_at): ``acknowledged``, or ``not found`` for an id no alert has.

    Acknowledging an alert again is accepted again. A request without an id is answered as not found. One row per
    request; alerts are reduced to their ids, so several rows of one alert answer once.
    """
    known = alerts.select("alert_id").distinct().withColumn("_known", F.lit(True))
    return requests.join(known, "alert_id", "left").withColumn(
        "status", F.when(F.col("_known"), F.lit("acknowledged")).otherwise(F.lit("not found"))).drop("_known")


def with_acknowledged(alerts: DataFrame, acks: DataFrame | None) -> DataFrame:
    """Adds the ``acknowledged`` flag; several acknowledgements of one alert count once.

    A flag that is there already stays: acknowledging others does not reopen a resolved alert.
    """
    already = F.coalesce("acknowledged", F.lit(False)) if "acknowledged" in alerts.columns else F.lit(False)
    if acks is None:
        return alerts.withColumn("acknowledged", already)
    done = acks.select("alert_id").distinct().withColumn("_acked", F.lit(True))
    return alerts.join(done, "alert_id", "left").withColumn(
        "acknowledged", already | F.coalesce("_acked", F.lit(False))).drop("_acked")


def open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(~F.col("acknowledged"))


def alert_order() -> list:
    """CRITICAL first, then the most recently seen; patient and vital break ties."""
    return [
        (F.col("severity") == "CRITICAL").desc(),
        F.coalesce("last_seen_at", "triggered_at").desc(),
        F.col("patient_id"), F.col("vital_name"), F.col("triggered_at"),
    ]


def active_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    return open_alerts(alerts).orderBy(*alert_order()).limit(limit)


def critical_alerts(alerts: DataFrame, limit: int = 5) -> DataFrame:
    return open_alerts(alerts).filter(F.col("severity") == "CRITICAL").orderBy(*alert_order()).limit(limit)


def warning_alerts(alerts: DataFrame) -> DataFrame:
    return open_alerts(alerts).filter(F.col("severity") == "WARNING")


def severity_counts(alerts: DataFrame) -> DataFrame:
    """Open alerts per severity, zero where there are none.

    Counted in one pass over the alerts; the fixed severities become rows afterwards.
    """
    counts = open_alerts(alerts).agg(*[
        F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("severity"), F.col(s).alias("open_alerts")) for s in SEVERITIES
    ])).alias("c")).select("c.*")


def open_alerts_per_patient(alerts: DataFrame) -> DataFrame:
    return open_alerts(alerts).groupBy("patient_id").agg(F.count("*").alias("open_alerts"))

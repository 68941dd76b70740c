"""Reports and histories over the risk table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bedwatch.config import DEFAULTS, REPORT_COLUMNS, Settings
from bedwatch.functions.numeric import round_to
from bedwatch.functions.scoring import direction
from bedwatch.operators.risk import rounded_change, with_previous_day
from bedwatch.operators.windows import newest_per_key
from bedwatch.session import stage

LEVEL_COUNTS = (("critical", "CRITICAL"), ("high", "HIGH"), ("moderate", "MODERATE"), ("low", "LOW"))


def daily_report(risk: DataFrame, patients: DataFrame, days: list[int] | None = None) -> DataFrame:
    """Consolidated report rows of the given days (every day if None).

    Only those days and the ones before them are read. Patients missing from
    the dimension vanish. No broadcast is forced: the dimension grows with the
    ward, so its size decides.
    """
    if days is not None:
        risk = risk.filter(F.col("simulated_day").isin(sorted({d for n in days for d in (n - 1, n)})))
    rows = with_previous_day(risk)
    if days is not None:
        rows = rows.filter(F.col("simulated_day").isin(days))
    named = rows.join(patients.select("patient_id", "name", "ward", "bed_number"), "patient_id")
    return named.select(
        "simulated_day", "patient_id", "name", "ward", F.col("bed_number").alias("bed"), "risk_level",
        F.col("combined_risk_score").alias("combined_risk"),
        rounded_change(F.col("risk_change")).alias("risk_change"),
        F.col("vitals_risk_score").alias("vitals_risk"),
        F.col("lab_risk_score").alias("lab_risk"),
        F.col("abnormal_vitals_count").alias("abnormal_vitals"),
        F.col("abnormal_labs_count").alias("abnormal_labs"),
        "readings_analyzed", "heart_rate_trend", "spo2_trend", "risk_factors",
        *(["report_date"] if "report_date" in risk.columns else []),
    )


def in_report_order(report: DataFrame) -> DataFrame:
    return report.orderBy("simulated_day", F.col("combined_risk").desc(), "patient_id")


def _level_counts(level) -> list:
    return [F.count_if(level == value).alias(name) for name, value in LEVEL_COUNTS]


def report_summary(report: DataFrame) -> DataFrame:
    dated = [F.max("report_date").alias("report_date")] if "report_date" in report.columns else []
    return report.groupBy("simulated_day").agg(
        *dated,
        F.count("*").alias("total_patients"),
        *[F.count_if(F.col("risk_level") == v).alias(f"{n}_count") for n, v in LEVEL_COUNTS],
    )


def report_documents(report: DataFrame) -> DataFrame:
    """A day's document as lines: one summary and one line per patient, whatever the size of the ward.

    ``position`` 0 is the summary; patients follow from 1 by falling risk, then id. Lines of
    one shape need no page size, and no task holds a whole day: positions come from
    range partitions of the wanted order and the days' counts in the partitions before.
    """
    columns = [c for c in REPORT_COLUMNS if c != "simulated_day"]
    order = ("simulated_day", "_order", "patient_id")
    ordered = report.withColumn("_order", -F.col("combined_risk")).select(
        *order, F.struct(*columns).alias("patient")).repartitionByRange(*[F.col(c) for c in order])
    ordered = stage(ordered.withColumn("_part", F.spark_partition_id()), "report-order")
    counts = ordered.groupBy("simulated_day", "_part").agg(F.count("*").alias("n"))
    before = counts.withColumn("_before", F.sum("n").over(
        Window.partitionBy("simulated_day").orderBy("_part")) - F.col("n")).drop("n")
    number = F.row_number().over(Window.partitionBy("simulated_day", "_part").orderBy("_order", "patient_id"))
    lines = ordered.join(before, ["simulated_day", "_part"]).select(
        "simulated_day", (F.col("_before") + number).alias("position"), "patient")
    summary = report_summary(report)
    heads = summary.select("simulated_day", F.lit(0).cast("long").alias("position"),
                           F.struct(*[c for c in summary.columns if c != "simulated_day"]).alias("summary"))
    return heads.unionByName(lines, allowMissingColumns=True)


# ---- days ----------------------------------------------------------------

def report_days(risk: DataFrame) -> DataFrame:
    return risk.select("simulated_day", "report_date").distinct().orderBy(F.col("simulated_day").desc())


def latest_report_day(risk: DataFrame) -> DataFrame:
    return risk.agg(F.max("simulated_day").alias("day"))


def report_day_on(risk: DataFrame, report_date) -> DataFrame:
    """The last day reported on a calendar date, null if there is none."""
    return risk.filter(F.col("report_date") == F.lit(report_date).cast("date")).agg(
        F.max("simulated_day").alias("day"))


def latest_report(risk: DataFrame, patients: DataFrame) -> DataFrame:
    """Report of the newest day; a single number picks the partitions to read."""
    day = latest_report_day(risk).first()[0]
    return daily_report(risk, patients, [] if day is None else [day])


def report_on_date(risk: DataFrame, patients: DataFrame, report_date) -> DataFrame:
    day = report_day_on(risk, report_date).first()[0]
    return daily_report(risk, patients, [] if day is None else [day])


# ---- history -------------------------------------------------------------

def recent_days(risk: DataFrame, days: int) -> DataFrame:
    """Risk rows of the last ``days`` distinct days of the ward.

    The day list has at most ``days`` rows (the limit itself bounds the broadcast).
    """
    newest = risk.select("simulated_day").distinct().orderBy(F.col("simulated_day").desc()).limit(days)
    return risk.join(F.broadcast(newest), "simulated_day", "left_semi")


def ward_history(risk: DataFrame, patients: DataFrame, days: int = 10) -> DataFrame:
    """Scores per known patient and day for the last ward days."""
    recent = recent_days(risk, days)
    return recent.join(patients.select("patient_id", "name"), "patient_id").select(
        "patient_id", "name", "simulated_day",
        F.col("combined_risk_score").alias("combined_risk"),
        F.col("vitals_risk_score").alias("vitals_risk"),
        F.col("lab_risk_score").alias("lab_risk"),
        "risk_level",
    )


def patient_histories(history: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Score array per patient, latest change against the previous available day, direction.

    The array holds at most one entry per day of the history, which the caller
    limited. The change is compared unrounded and shown rounded.
    """
    point = F.struct("simulated_day", "combined_risk", "vitals_risk", "lab_risk", "risk_level")
    scores = F.col("scores")
    change = F.when(F.size(scores) >= 2, scores[F.size(scores) - 1]["combined_risk"]
                    - scores[F.size(scores) - 2]["combined_risk"])
    return (
        history.groupBy("patient_id", "name").agg(F.sort_array(F.collect_list(point)).alias("scores"))
        .withColumn("_change", change)
        .select("patient_id", "name", "scores", round_to(F.col("_change"), 2).alias("latest_change"),
                direction(F.col("_change"), cfg).alias("direction"))
    )


def ward_day_summary(history: DataFrame) -> DataFrame:
    return history.groupBy("simulated_day").agg(
        round_to(F.avg("combined_risk"), 2).alias("avg_risk"), *_level_counts(F.col("risk_level")))


def direction_counts(histories: DataFrame) -> DataFrame:
    return histories.groupBy("direction").agg(F.count("*").alias("patients"))


def risk_heatmap(history: DataFrame, days: list[int] | None = None) -> DataFrame:
    """One row per patient, one column per day; a missing report is null.

    Without ``days`` they are the days of the history, which the caller limited.
    """
    if days is None:
        days = sorted(r[0] for r in history.select("simulated_day").distinct().collect())
    return history.groupBy("patient_id", "name").pivot("simulated_day", days).agg(
        F.first("combined_risk"))


def patient_risk_history(risk: DataFrame, days: int = 14, patient_id=None) -> DataFrame:
    """The last ``days`` reports, oldest first, of one patient or of every patient."""
    if patient_id is not None:
        risk = risk.filter(F.col("patient_id") == F.lit(patient_id))
    last = newest_per_key(risk, ["patient_id"], [F.col("simulated_day").desc()], days)
    return last.orderBy("patient_id", "simulated_day")

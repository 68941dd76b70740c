"""Ward views: the live and the daily picture side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bedwatch.config import DEFAULTS, RISK_LEVELS, Settings
from bedwatch.functions.numeric import age_seconds, rank_of
from bedwatch.functions.scoring import (
    concern_codes, concern_texts, ews_components, ews_level, ews_score, outlook, split_factors,
)
from bedwatch.functions.vitals import risk_status, vital_status, worst_status
from bedwatch.operators.alerts import open_alerts_per_patient
from bedwatch.operators.risk import latest_risk
from bedwatch.operators.windows import latest_window, live_features

CARD_VITALS = ("heart_rate", "spo2", "systolic_bp", "temperature")


def early_warning(live: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Adds the early-warning components, score and level to current values."""
    scored = live.withColumn("ews_components", ews_components(**{v: F.col(v) for v in CARD_VITALS}))
    return scored.withColumns({
        "early_warning_score": ews_score(F.col("ews_components")),
        "early_warning_level": ews_level(F.col("ews_components"), cfg),
    })


def ward_risk(windows: DataFrame, risk: DataFrame, patients: DataFrame,
              cfg: Settings = DEFAULTS, ordered: bool = True) -> DataFrame:
    """Per patient: early warning now, trend, latest daily risk, concerns and the worse outlook.

    Starts from the dimension, so patients without data appear with score 0.
    All three inputs meet on the patient with one row per patient each.
    """
    daily = latest_risk(risk).select(
        "patient_id", "simulated_day", "risk_level", "combined_risk_score", "lab_risk_score",
        "vitals_risk_score", "abnormal_labs_count", "risk_change", "risk_factors")
    joined = (
        patients.select("patient_id", "name", "ward", F.col("bed_number").alias("bed"))
        .join(live_features(windows, cfg), "patient_id", "left")
        .join(daily, "patient_id", "left")
    )
    level, labs = F.col("early_warning_level"), F.col("abnormal_labs_count")
    hr, spo2 = F.col("hr_trend"), F.col("spo2_trend")
    merged = early_warning(joined, cfg).withColumns({
        "outlook": outlook(level, F.col("risk_level")),
        "concern_codes": concern_codes(level, hr, spo2, labs, cfg),
        "concerns": concern_texts(level, F.col("early_warning_score"), hr, spo2, labs,
                                  F.col("simulated_day"), cfg),
    })
    return by_outlook(merged) if ordered else merged


def by_outlook(view: DataFrame) -> DataFrame:
    return view.orderBy(
        rank_of(F.col("outlook"), RISK_LEVELS).desc(), F.col("early_warning_score").desc(), "patient_id")


def needs_attention(view: DataFrame) -> DataFrame:
    return view.filter(F.col("outlook").isin("HIGH", "CRITICAL"))


def attention_count(view: DataFrame) -> DataFrame:
    return needs_attention(view).agg(F.count("*").alias("patients"))


def patient_status(risk: DataFrame) -> DataFrame:
    """Newest risk row of each patient with its status and the factors as a list."""
    return latest_risk(risk).withColumns({
        "overall_status": worst_status(risk_status(F.col("risk_level"))),
        "factors": split_factors(F.col("risk_factors")),
    })


def ward_status(patients: DataFrame, windows: DataFrame) -> DataFrame:
    """Every patient with the values of the latest window, if any."""
    latest = latest_window(windows).select(
        "patient_id",
        F.col("avg_heart_rate").alias("heart_rate"),
        F.col("avg_spo2").alias("spo2"),
        F.col("avg_systolic_bp").alias("systolic_bp"),
        F.col("avg_diastolic_bp").alias("diastolic_bp"),
        F.col("avg_temperature").alias("temperature"),
        F.col("window_end").alias("last_reading"),
    )
    return patients.select("patient_id", "name", "ward", F.col("bed_number").alias("bed")).join(
        latest, "patient_id", "left")


def ward_totals(patients: DataFrame, alerts: DataFrame) -> DataFrame:
    """Patient and open-alert counts of the ward header, as two labelled rows."""
    return patients.agg(F.count("*").alias("value")).select(
        F.lit("total_patients").alias("name"), "value"
    ).unionByName(alerts.filter(~F.col("acknowledged")).agg(F.count("*").alias("value")).select(
        F.lit("active_alerts").alias("name"), "value"))


def ward_overview(status: DataFrame, alerts: DataFrame, latest_day_risk: DataFrame, as_of: Column,
                  cfg: Settings = DEFAULTS, ordered: bool = True) -> DataFrame:
    """Ward cards: vital statuses, open alerts, daily risk status, the worst of all, triage order."""
    counts = open_alerts_per_patient(alerts).withColumns(
        {"_alerted": F.col("patient_id").cast("string")}).drop("patient_id")  # alert tables key patients by text
    daily = latest_day_risk.select("patient_id", risk_status(F.col("risk_level")).alias("risk_status"))
    joined = (
        status.join(counts, F.col("patient_id").cast("string") == F.col("_alerted"), "left").drop("_alerted")
        .join(daily, "patient_id", "left")
        .withColumns({
            "open_alerts": F.coalesce("open_alerts", F.lit(0)),
            "risk_status": F.coalesce("risk_status", F.lit("normal")),
            **{f"{v}_status": vital_status(v, F.col(v), cfg) for v in CARD_VITALS},
        })
    )
    alert_status = F.when(F.col("open_alerts") > 0, F.lit("critical")).otherwise(F.lit("normal"))
    points = F.when(F.col("risk_status") == "critical", 5).when(F.col("risk_status") == "watch", 2).otherwise(0)
    cards = joined.withColumns({
        "overall_status": worst_status(
            *[F.col(f"{v}_status") for v in CARD_VITALS], F.col("risk_status"), alert_status),
        "triage_score": F.col("open_alerts") * 10 + points,
        "age_seconds": age_seconds(F.col("last_reading"), as_of.cast("timestamp")),
    })
    return cards.orderBy(F.col("triage_score").desc(), "patient_id") if ordered else cards

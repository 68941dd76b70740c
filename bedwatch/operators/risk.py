"""Patient risk rows: vitals joined with labs, scored, and compared across days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bedwatch.config import DEFAULTS, Settings
from bedwatch.functions.numeric import round_to
from bedwatch.functions.scoring import (
    combined_risk, factors_text, risk_level, vitals_factors, vitals_risk,
)
from bedwatch.operators.windows import newest_per_key

RISK_KEYS = ("patient_id", "simulated_day")


def score_patients(features: DataFrame, panels: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One risk row per patient and day that has vitals or labs; the missing half scores 0.

    Both inputs are unique on the join key and already hash-partitioned by it
    from their aggregations, so the full outer join adds no shuffle.
    """
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<string>")
    joined = features.join(panels, list(RISK_KEYS), "full_outer")
    total, abnormal = F.coalesce("total", zero), F.coalesce("abnormal", zero)
    hr, spo2 = F.col("hr_trend"), F.col("spo2_trend")
    scored = joined.select(
        *RISK_KEYS,
        vitals_risk(total, abnormal, hr, spo2, cfg).alias("vitals_risk_score"),
        F.coalesce("lab_risk_score", F.lit(0.0)).alias("lab_risk_score"),
        abnormal.alias("abnormal_vitals_count"),
        F.coalesce("abnormal_labs_count", zero).alias("abnormal_labs_count"),
        F.concat(vitals_factors(total, abnormal, hr, spo2, cfg),
                 F.coalesce("lab_factors", none)).alias("factors"),
        total.alias("readings_analyzed"),
        round_to(hr, 4).alias("heart_rate_trend"),
        round_to(spo2, 4).alias("spo2_trend"),
    )
    combined = scored.withColumn(
        "combined_risk_score", combined_risk(F.col("vitals_risk_score"), F.col("lab_risk_score"), cfg))
    return combined.withColumns({
        "risk_level": risk_level(F.col("combined_risk_score")),
        "risk_factors": factors_text(F.col("factors")),
    })


def with_previous_day(risk: DataFrame) -> DataFrame:
    """Adds the score of exactly the day before and the (unrounded) change.

    A patient has one row per day, so looking back one row and checking its day
    replaces a self join: one shuffle and one pass over the risk table.
    """
    w = Window.partitionBy("patient_id").orderBy("simulated_day")
    day, score = F.lag("simulated_day").over(w), F.lag("combined_risk_score").over(w)
    return (
        risk.withColumns({"_day": day, "_score": score})
        .withColumn("previous_score", F.when(F.col("_day") == F.col("simulated_day") - 1, F.col("_score")))
        .withColumn("risk_change", F.col("combined_risk_score") - F.col("previous_score"))
        .drop("_day", "_score")
    )


def latest_risk(risk: DataFrame) -> DataFrame:
    """Newest risk row per patient with the change against exactly the day before.

    Only the two newest days of a patient can matter; the group limit drops
    the rest before the shuffle.
    """
    newest_first = [F.col("simulated_day").desc()]
    two = newest_per_key(risk, ["patient_id"], newest_first, 2)
    w = Window.partitionBy("patient_id").orderBy(*newest_first)
    return (
        two.withColumns({
            "_rn": F.row_number().over(w),
            "_day": F.lead("simulated_day").over(w),
            "_score": F.lead("combined_risk_score").over(w),
        })
        .filter("_rn = 1")
        .withColumn("risk_change", F.when(
            F.col("_day") == F.col("simulated_day") - 1, F.col("combined_risk_score") - F.col("_score")))
        .drop("_rn", "_day", "_score")
    )


def rounded_change(change):
    return round_to(change, 2)

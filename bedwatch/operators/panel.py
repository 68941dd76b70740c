"""Lab panel: latest result per test, severity, panel score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from bedwatch.config import DEFAULTS, Settings
from bedwatch.functions.scoring import lab_factor, lab_severity, panel_risk
from bedwatch.operators.windows import newest_per_key

LAB_KEYS = ("patient_id", "test_type", "simulated_day")


def latest_labs(labs: DataFrame, latest: Sequence[str] = ("report_seq", "test_pos")) -> DataFrame:
    """One row per patient, test and day: the last one in the given order wins."""
    return newest_per_key(labs, LAB_KEYS, [F.col(c).desc() for c in latest])


def score_tests(labs: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return labs.withColumn("severity", lab_severity(
        F.col("result_value"), F.col("reference_min"), F.col("reference_max"), cfg))


def panel_scores(labs: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Panel score per patient and day from the latest results.

    Severity is recomputed from the range while the abnormal count trusts the
    supplied flag. The factor list holds at most one text per test type of the
    panel; it is pruned from the plan when nobody selects it.
    """
    out = F.col("severity") > 0
    factor = F.when(out, F.struct(
        "test_type",
        lab_factor(F.col("test_type"), F.col("result_value"), F.col("reference_min"),
                   F.col("reference_max")).alias("text"),
    ))
    return (
        score_tests(labs, cfg)
        .groupBy("patient_id", "simulated_day")
        .agg(
            F.max("severity").alias("max_severity"),
            F.count_if(out).alias("labs_out_of_range"),
            F.count_if("is_abnormal").alias("abnormal_labs_count"),
            F.sort_array(F.collect_list(factor)).alias("_factors"),
        )
        .withColumns({
            "lab_risk_score": panel_risk(F.col("max_severity"), F.col("labs_out_of_range"), cfg),
            "lab_factors": F.transform("_factors", lambda f: f["text"]),
        })
        .drop("_factors")
    )


def recent_labs(labs: DataFrame, n: int = 20, patient_id=None) -> DataFrame:
    """The newest ``n`` results of one patient, or of every patient; ties in day and test order."""
    order = [F.col("collected_at").desc(), F.col("simulated_day").desc(), F.col("test_type")]
    if patient_id is not None:
        return labs.filter(F.col("patient_id") == F.lit(patient_id)).orderBy(*order).limit(n)
    return newest_per_key(labs, ["patient_id"], order, n)

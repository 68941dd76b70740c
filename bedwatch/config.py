"""Settings: every limit, weight and duration an operator uses.

The defaults reproduce the clinical model exactly; a deployment (or a test
table whose readings are hours apart) overrides fields with ``Settings.with_``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import NamedTuple


class AlertRule(NamedTuple):
    vital: str
    direction: str  # "above" | "below"
    limit: float
    critical_limit: float


# --------------------------------------------------------------------------
# Fixed values. Results only agree with the clinical model if these are kept.
# --------------------------------------------------------------------------

VITALS = ("heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature")

# Range a healthy value lies in, both ends included.
NORMAL_RANGES = {
    "heart_rate": (60.0, 100.0),
    "spo2": (95.0, 100.0),
    "systolic_bp": (90.0, 140.0),
    "diastolic_bp": (60.0, 90.0),
    "temperature": (36.1, 37.2),
}

# A reading strictly past `limit` breaches; strictly past `critical_limit` it is critical.
# For SpO2 both are the same: any breach is critical. Diastolic pressure has no rule.
ALERT_RULES = (
    AlertRule("heart_rate", "above", 120.0, 150.0),
    AlertRule("heart_rate", "below", 50.0, 40.0),
    AlertRule("spo2", "below", 90.0, 90.0),
    AlertRule("systolic_bp", "above", 180.0, 200.0),
    AlertRule("systolic_bp", "below", 80.0, 70.0),
    AlertRule("temperature", "above", 38.5, 39.5),
    AlertRule("temperature", "below", 35.0, 34.5),
)

# Early-warning bands: (upper bound included, points) in order, then the points above the last bound.
EWS_BANDS = {
    "heart_rate": (((40.0, 3), (50.0, 1), (90.0, 0), (110.0, 1), (130.0, 2)), 3),
    "spo2": (((91.0, 3), (93.0, 2), (95.0, 1)), 0),
    "systolic_bp": (((90.0, 3), (100.0, 2), (110.0, 1), (219.0, 0)), 3),
    "temperature": (((35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)), 2),
}

RISK_LEVELS = ("LOW", "MODERATE", "HIGH", "CRITICAL")  # ascending
SEVERITIES = ("WARNING", "CRITICAL")  # ascending
STATUSES = ("normal", "watch", "critical")  # ascending
EWS_AS_RISK = {"LOW": "LOW", "MEDIUM": "HIGH", "HIGH": "CRITICAL"}

# Lowest combined score of each level above LOW.
RISK_CUTOFFS = {"CRITICAL": 75.0, "HIGH": 50.0, "MODERATE": 25.0}

# Lab panel: test, reference minimum, reference maximum.
LAB_PANEL = (
    ("WBC", 4.0, 11.0),
    ("Hemoglobin", 12.0, 17.5),
    ("Glucose", 70.0, 100.0),
    ("Creatinine", 0.6, 1.2),
    ("CRP", 0.0, 5.0),
)

# Longest silence allowed per component, in seconds, and the severity of exceeding it.
FRESHNESS_LIMITS = (
    ("vitals_producer", 60, "critical"),
    ("lab_generator", 600, "warning"),
    ("speed_layer", 90, "critical"),
    ("batch_layer", 900, "warning"),
)

# How long a condition has to last before its alarm fires, in seconds: rule, what it is about, hold.
RULE_HOLDS = (
    ("stale", "vitals_producer", 30),
    ("stale", "lab_generator", 30),
    ("stale", "speed_layer", 30),
    ("stale", "batch_layer", 60),
    ("error_rate", "vitals_producer", 60),
    ("patient_data_age", "ward", 30),
    ("open_critical_alerts", "ward", 0),
)

ALERT_TYPE_VITAL = "VITAL_THRESHOLD"
ALERT_TYPE_STALE = "DATA_STALENESS"
ALERT_TYPE_ERRORS = "HIGH_ERROR_RATE"
SYSTEM_PATIENT = "SYSTEM"

# Report columns in export order; the day comes first.
REPORT_COLUMNS = (
    "simulated_day",
    "patient_id", "name", "ward", "bed", "risk_level", "combined_risk", "risk_change",
    "vitals_risk", "lab_risk", "abnormal_vitals", "abnormal_labs", "readings_analyzed",
    "heart_rate_trend", "spo2_trend", "risk_factors",
)

# Message and factor texts.
TEXT_BREACH = "%s is %s threshold: value="
TEXT_BREACH_LIMIT = ", threshold=%s"
TEXT_BREACH_COUNT = "%d/%d vital readings breached alert thresholds"
TEXT_HR_RISING = "Heart rate rising (%+.2f bpm/{unit})"
TEXT_SPO2_FALLING = "SpO2 falling (%+.2f %%/{unit})"
TEXT_LAB = "%s %s (%.2f, ref: %s-%s)"
TEXT_EWS = "Early warning score %d (%s)"
TEXT_LIVE_HR = "Heart rate rising %+.1f bpm/{unit} over last {span}"
TEXT_LIVE_SPO2 = "SpO2 falling %+.2f %%/{unit} over last {span}"
TEXT_LIVE_LABS = "%d abnormal lab result(s) on day %d"
TEXT_STALE = "No vitals data received for patient %s (%s) in the last %d seconds."
TEXT_ERRORS = "Vitals ingestion error rate is %.1f%% (%d/%d), exceeding threshold of %.0f%%."
TEXT_NO_FACTORS = "None"
FACTOR_SEPARATOR = "; "

LAB_FILE_FORMAT = "lab_results_day_%03d.json"
LAB_NAME_PATTERN = r"lab_results_day_(\d+)\.jsonl?"
LAB_PATH_PATTERN = r"lab_results_day_(\d+)\.json(?:l/[^/]+)?$"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


_UNITS = {1.0: "s", 60.0: "min", 3600.0: "hour", 86400.0: "day"}
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


@dataclass(frozen=True)
class Settings:
    # daily model
    vitals_weight: float = 0.6
    lab_weight: float = 0.4
    hr_rise_limit: float = 1.5
    spo2_fall_limit: float = -0.3
    trend_penalty: float = 15.0
    extra_lab_points: float = 10.0
    lab_base_points: float = 50.0
    slope_unit_seconds: float = 60.0
    period_seconds: int = 300
    # live view
    window: str = "30 seconds"
    watermark: str = "10 seconds"
    trend_windows: int = 10
    live_hr_rise_limit: float = 3.0
    live_spo2_fall_limit: float = -0.5
    ews_medium: int = 5
    ews_high: int = 7
    ews_single: int = 3
    # alerts
    alert_rules: tuple[AlertRule, ...] = ALERT_RULES
    cooldown_seconds: int = 300
    escalate_after: int = 3
    state_buckets: int = 32
    # reports
    direction_step: float = 5.0
    # health
    stale_after_seconds: int = 60
    patient_age_limit_seconds: int = 90
    error_rate_limit: float = 0.05
    min_records_per_second: float = 1.0
    freshness_limits: tuple[tuple[str, int, str], ...] = FRESHNESS_LIMITS
    rule_holds: tuple[tuple[str, str, int], ...] = RULE_HOLDS
    # batch runs
    max_days_per_run: int = 3
    # stream triggers
    archive_trigger: str = "30 seconds"
    window_trigger: str = "10 seconds"
    alert_trigger: str = "5 seconds"

    @property
    def slope_unit(self) -> str:
        """The time in which trends are given: min at the default."""
        return _UNITS.get(self.slope_unit_seconds, f"{self.slope_unit_seconds:g} s")

    @property
    def trend_span(self) -> str:
        """What the windows of a live trend cover: 5 min at the default."""
        number, kind = self.window.split()
        seconds = float(number) * _SECONDS[kind.rstrip("s")] * self.trend_windows
        unit = next(u for u in (86400.0, 3600.0, 60.0, 1.0) if seconds % u == 0)
        return f"{seconds / unit:g} {_UNITS[unit]}"

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)


DEFAULTS = Settings()

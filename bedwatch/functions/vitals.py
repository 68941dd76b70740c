"""Column expressions over single readings: breaches, severities, statuses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bedwatch.config import (
    DEFAULTS, NORMAL_RANGES, STATUSES, TEXT_BREACH, TEXT_BREACH_LIMIT, AlertRule, Settings,
)
from bedwatch.functions.numeric import worst_of


def _past(value: Column, direction: str, limit: float) -> Column:
    return value > F.lit(limit) if direction == "above" else value < F.lit(limit)


def breaches_any(cfg: Settings = DEFAULTS) -> Column:
    """True if the reading is past any alert limit. Missing vitals never breach."""
    flag = F.lit(False)
    for rule in cfg.alert_rules:
        flag = flag | F.coalesce(_past(F.col(rule.vital), rule.direction, rule.limit), F.lit(False))
    return flag


def breach_message(vital: Column, value: Column, limit: Column, above: Column) -> Column:
    side = F.when(above, F.lit("above")).otherwise(F.lit("below"))
    return F.concat(
        F.format_string(TEXT_BREACH, vital, side),
        F.format_number(value, 1),
        F.format_string(TEXT_BREACH_LIMIT, F.format_string("%.1f", limit)),
    )


def _candidate(rule: AlertRule) -> Column:
    value = F.col(rule.vital)
    critical = _past(value, rule.direction, rule.critical_limit)
    return F.when(
        _past(value, rule.direction, rule.limit),
        F.struct(
            F.lit(rule.vital).alias("vital_name"),
            value.cast("double").alias("vital_value"),
            F.lit(rule.limit).alias("threshold_value"),
            F.lit(rule.direction == "above").alias("above"),
            F.when(critical, F.lit("CRITICAL")).otherwise(F.lit("WARNING")).alias("severity"),
        ),
    )


def breach_candidates(cfg: Settings = DEFAULTS) -> Column:
    """Array with one slot per rule: the breach, or null where the reading is within the limit."""
    return F.array(*[_candidate(r) for r in cfg.alert_rules])


def vital_status(name: str, value: Column, cfg: Settings = DEFAULTS) -> Column:
    """critical past an alert limit; watch outside the normal range or missing; else normal."""
    breached = F.lit(False)
    for rule in cfg.alert_rules:
        if rule.vital == name:
            breached = breached | _past(value, rule.direction, rule.limit)
    low, high = NORMAL_RANGES[name]
    return (
        F.when(value.isNull() | F.isnan(value), F.lit("watch"))
        .when(breached, F.lit("critical"))
        .when((value < low) | (value > high), F.lit("watch"))
        .otherwise(F.lit("normal"))
    )


def risk_status(level: Column) -> Column:
    return (
        F.when(level == "CRITICAL", F.lit("critical"))
        .when(level == "HIGH", F.lit("watch"))
        .otherwise(F.lit("normal"))
    )


def worst_status(*statuses: Column) -> Column:
    return worst_of(STATUSES, *statuses)

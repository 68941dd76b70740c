"""The scoring model as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bedwatch.config import (
    DEFAULTS, EWS_AS_RISK, EWS_BANDS, FACTOR_SEPARATOR, RISK_CUTOFFS, RISK_LEVELS, Settings,
    TEXT_BREACH_COUNT, TEXT_EWS, TEXT_HR_RISING, TEXT_LAB, TEXT_LIVE_HR, TEXT_LIVE_LABS,
    TEXT_LIVE_SPO2, TEXT_NO_FACTORS, TEXT_SPO2_FALLING,
)
from bedwatch.functions.numeric import lookup, round_to, worst_of


# ---- early warning -------------------------------------------------------

def band_points(value: Column, bands, top: int) -> Column:
    """Points of the first band whose upper bound is not below the value; missing scores 0."""
    chain = F.when(value.isNull(), F.lit(0))
    for upper, points in bands:
        chain = chain.when(value <= F.lit(upper), F.lit(points))
    return chain.otherwise(F.lit(top))


def ews_components(**vitals: Column) -> Column:
    return F.struct(*[
        band_points(vitals[name], *EWS_BANDS[name]).alias(name) for name in EWS_BANDS
    ])


def ews_score(components: Column) -> Column:
    total = F.lit(0)
    for name in EWS_BANDS:
        total = total + components[name]
    return total


def ews_level(components: Column, cfg: Settings = DEFAULTS) -> Column:
    score = ews_score(components)
    single = F.greatest(*[components[name] for name in EWS_BANDS]) >= cfg.ews_single
    return (
        F.when(score >= cfg.ews_high, F.lit("HIGH"))
        .when((score >= cfg.ews_medium) | single, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


# ---- daily model ---------------------------------------------------------

def vitals_risk(total: Column, abnormal: Column, hr_slope: Column, spo2_slope: Column,
                cfg: Settings = DEFAULTS) -> Column:
    base = F.try_divide(F.lit(100.0) * abnormal, total)
    score = (
        base
        + F.when(hr_slope > cfg.hr_rise_limit, F.lit(cfg.trend_penalty)).otherwise(0.0)
        + F.when(spo2_slope < cfg.spo2_fall_limit, F.lit(cfg.trend_penalty)).otherwise(0.0)
    )
    return F.when(total > 0, round_to(F.least(score, F.lit(100.0)), 2)).otherwise(F.lit(0.0))


def lab_severity(value: Column, low: Column, high: Column, cfg: Settings = DEFAULTS) -> Column:
    """0 inside the range (ends included) or without a usable range; else by distance outside."""
    width = F.greatest(high - low, F.lit(1e-9))
    outside = F.when(value < low, low - value).otherwise(value - high)
    base = F.lit(cfg.lab_base_points)
    return (
        F.when(value.isNull() | low.isNull() | high.isNull(), F.lit(0.0))
        .when((low <= value) & (value <= high), F.lit(0.0))
        .otherwise(round_to(F.least(F.lit(100.0), base + base * outside / width), 2))
    )


def panel_risk(max_severity: Column, n_out_of_range: Column, cfg: Settings = DEFAULTS) -> Column:
    extra = F.lit(cfg.extra_lab_points) * (n_out_of_range - 1)
    return F.when(
        n_out_of_range > 0, round_to(F.least(max_severity + extra, F.lit(100.0)), 2)
    ).otherwise(F.lit(0.0))


def combined_risk(vitals: Column, labs: Column, cfg: Settings = DEFAULTS) -> Column:
    return round_to(F.lit(cfg.vitals_weight) * vitals + F.lit(cfg.lab_weight) * labs, 2)


def risk_level(score: Column) -> Column:
    """Level of an already rounded score."""
    chain = None
    for level, cutoff in RISK_CUTOFFS.items():
        condition = score >= F.lit(cutoff)
        chain = F.when(condition, F.lit(level)) if chain is None else chain.when(condition, F.lit(level))
    return chain.otherwise(F.lit(RISK_LEVELS[0]))


def outlook(ews: Column, daily_level: Column) -> Column:
    """The worse of the live warning and the daily level, on the daily scale."""
    return worst_of(RISK_LEVELS, lookup(ews, EWS_AS_RISK), daily_level)


def direction(change: Column, cfg: Settings = DEFAULTS) -> Column:
    return (
        F.when(change.isNull(), F.lit("new"))
        .when(change >= cfg.direction_step, F.lit("worsening"))
        .when(change <= -cfg.direction_step, F.lit("improving"))
        .otherwise(F.lit("stable"))
    )


# ---- explanations --------------------------------------------------------

def _present(*items: Column) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def vitals_factors(total: Column, abnormal: Column, hr_slope: Column, spo2_slope: Column,
                   cfg: Settings = DEFAULTS) -> Column:
    return F.when(total > 0, _present(
        F.when(abnormal > 0, F.format_string(TEXT_BREACH_COUNT, abnormal, total)),
        F.when(hr_slope > cfg.hr_rise_limit, F.format_string(TEXT_HR_RISING.format(unit=cfg.slope_unit), hr_slope)),
        F.when(spo2_slope < cfg.spo2_fall_limit, F.format_string(TEXT_SPO2_FALLING.format(unit=cfg.slope_unit), spo2_slope)),
    )).otherwise(F.array().cast("array<string>"))


def lab_factor(test_type: Column, value: Column, low: Column, high: Column) -> Column:
    side = F.when(value > high, F.lit("high")).otherwise(F.lit("low"))
    return F.format_string(TEXT_LAB, test_type, side, value, low.cast("string"), high.cast("string"))


def factors_text(factors: Column) -> Column:
    return F.when(F.size(factors) > 0, F.concat_ws(FACTOR_SEPARATOR, factors)).otherwise(
        F.lit(TEXT_NO_FACTORS))


def split_factors(text: Column) -> Column:
    """Back from text to list; missing and the no-factor word give an empty list."""
    return F.when(
        text.isNull() | (text == "") | (text == TEXT_NO_FACTORS), F.array().cast("array<string>")
    ).otherwise(F.transform(F.split(text, FACTOR_SEPARATOR.strip()), lambda s: F.trim(s)))


def concern_codes(ews: Column, hr_slope: Column, spo2_slope: Column, abnormal_labs: Column,
                  cfg: Settings = DEFAULTS) -> Column:
    return _present(
        F.when(ews != "LOW", F.lit("early_warning")),
        F.when(hr_slope > cfg.live_hr_rise_limit, F.lit("heart_rate_rising")),
        F.when(spo2_slope < cfg.live_spo2_fall_limit, F.lit("spo2_falling")),
        F.when(abnormal_labs > 0, F.lit("abnormal_labs")),
    )


def concern_texts(ews: Column, score: Column, hr_slope: Column, spo2_slope: Column,
                  abnormal_labs: Column, day: Column, cfg: Settings = DEFAULTS) -> Column:
    trend = {"unit": cfg.slope_unit, "span": cfg.trend_span}
    return _present(
        F.when(ews != "LOW", F.format_string(TEXT_EWS, score, ews)),
        F.when(hr_slope > cfg.live_hr_rise_limit, F.format_string(TEXT_LIVE_HR.format(**trend), hr_slope)),
        F.when(spo2_slope < cfg.live_spo2_fall_limit, F.format_string(TEXT_LIVE_SPO2.format(**trend), spo2_slope)),
        F.when(abnormal_labs > 0, F.format_string(TEXT_LIVE_LABS, abnormal_labs, day)),
    )


def risk_breakdown(vitals: Column, labs: Column, combined: Column, level: Column,
                   cfg: Settings = DEFAULTS) -> Column:
    """Worked calculation of a combined score."""
    return F.struct(
        vitals.alias("vitals_risk"),
        round_to(vitals * cfg.vitals_weight, 1).alias("vitals_part"),
        labs.alias("lab_risk"),
        round_to(labs * cfg.lab_weight, 1).alias("lab_part"),
        round_to(combined, 1).alias("combined_risk"),
        level.alias("risk_level"),
    )

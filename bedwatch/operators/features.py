"""Daily vitals features recomputed from raw readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bedwatch.config import DEFAULTS, Settings
from bedwatch.functions.numeric import whole_units_since
from bedwatch.functions.vitals import breaches_any


def assign_aligned_day(readings: DataFrame, origin: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """Day number and period start for periods laid end to end from ``origin``. No join."""
    start = F.lit(origin).cast("timestamp")
    length = cfg.period_seconds * 1_000_000
    number = F.floor((F.unix_micros("event_time") - F.unix_micros(start)) / F.lit(length))
    return readings.withColumns({
        "simulated_day": (number + 1).cast("int"),
        "period_start": F.timestamp_micros(F.unix_micros(start) + number * F.lit(length)),
    })


def _within_periods(periods: DataFrame, dated: bool) -> Column:
    low, high = periods.agg(F.min("period_start"), F.max("period_end")).first()
    if low is None:
        return F.lit(False)
    inside = (F.col("event_time") >= F.lit(low)) & (F.col("event_time") < F.lit(high))
    if dated:
        inside = inside & F.col("event_date").between(F.to_date(F.lit(low)), F.to_date(F.lit(high)))
    return inside


def assign_period(readings: DataFrame, periods: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Each reading with every period ``[period_start, period_end)`` it lies in.

    Periods may overlap or leave gaps. A period of length P touches at most two
    time buckets of length P, so the range join becomes an equi join on the
    bucket with an exact filter. First and last bound, two scalars, prune the
    archive's date partitions. The period table has a row or two per day; AQE
    broadcasts it by its size, or splits the buckets, in which whole days of
    readings meet.
    """
    length = cfg.period_seconds * 1_000_000
    ends = periods.select("simulated_day", *[c for c in periods.columns if c in ("period_start", "period_end", "report_date")])
    readings = readings.filter(_within_periods(ends, "event_date" in readings.columns))

    def bucket(ts):
        return F.floor(F.unix_micros(ts) / F.lit(length))

    buckets = ends.withColumn(
        "_bucket", F.explode(F.sequence(bucket(F.col("period_start")), bucket(F.col("period_end")))))
    left = readings.withColumn("_bucket", bucket(F.col("event_time")))
    return left.join(buckets, "_bucket").filter(
        (F.col("event_time") >= F.col("period_start")) & (F.col("event_time") < F.col("period_end"))
    ).drop("_bucket")


def daily_features(readings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Count, breaches, extremes and trends per patient and day.

    Input: de-duplicated readings with ``simulated_day`` and ``period_start``.
    The slope is null when all readings share one second. Every measure,
    the slopes included, combines before the shuffle.
    """
    t = F.col("_t")
    return (
        readings
        .withColumns({
            "_abnormal": breaches_any(cfg).cast("int"),
            "_t": whole_units_since(F.col("period_start"), F.col("event_time"), cfg.slope_unit_seconds),
        })
        .groupBy("patient_id", "simulated_day")
        .agg(
            F.count("*").alias("total"),
            F.sum("_abnormal").alias("abnormal"),
            F.regr_slope("heart_rate", t).alias("hr_trend"),
            F.regr_slope("spo2", t).alias("spo2_trend"),
            F.avg("heart_rate").alias("avg_heart_rate"),
            F.min("spo2").alias("min_spo2"),
            F.max("temperature").alias("max_temperature"),
        )
    )

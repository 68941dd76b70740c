"""Counters that only grow, but start from zero when their process is restarted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bedwatch.functions.numeric import seconds_between
from bedwatch.operators.neighbours import with_neighbours

COUNTER_KEYS = ("component", "metric_name")
#: A gap at a window's end is filled up to this many times the usual distance of samples, else by half of that distance.
USUAL_GAPS = 1.1


def counter_steps(metrics: DataFrame) -> DataFrame:
    """Every sample with ``before``, the one before it, and ``step``, what the counter grew by since then.

    A value below the one before means a restart from zero in between, so the step is the value itself. The first sample of
    a counter has no step. A counter may have any number of samples: they are range-partitioned by time, and steps
    over the borders are stitched. Samples without a time or a number are left out.
    """
    known = metrics.filter(F.col("recorded_at").isNotNull() & ~F.coalesce(F.isnan("metric_value"), F.lit(True))).select(
        *[F.coalesce(F.col(k), F.lit("")).alias(k) for k in COUNTER_KEYS], "recorded_at", F.col("metric_value").cast("double"))
    value, before = F.col("metric_value"), F.col("before.metric_value")
    return with_neighbours(known, COUNTER_KEYS, ["recorded_at"], ["metric_value"], "counter-samples").withColumns({
        "restarted": value < before,
        "step": F.when(value >= before, value - before).when(before.isNotNull(), value),
    })


def per_window(metrics: DataFrame, window: str) -> DataFrame:
    """What the samples of each counter and window add up to; combined before the shuffle.

    ``increase`` counts every step whose later sample lies in the window, ``inside`` only those between two samples of it.
    """
    start = F.col("w.start")
    within = F.col("before.recorded_at") >= start
    at = F.struct("recorded_at", "metric_value")
    return counter_steps(metrics).withColumn("w", F.window("recorded_at", window)).groupBy(*COUNTER_KEYS, "w").agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("samples"),
        F.min(F.when(~within, F.col("before.recorded_at"))).alias("before_at"),
        F.sum("step").alias("increase"), F.sum(F.when(within, F.col("step"))).alias("inside"),
        F.count_if("restarted").alias("restarts"),
    ).select(*COUNTER_KEYS, start.alias("window_start"), F.col("w.end").alias("window_end"), "first", "last", "samples",
             "before_at", "increase", "inside", "restarts")


def counter_rates(metrics: DataFrame, window: str) -> DataFrame:
    """Growth of each counter per window, restarts included, and its rate stretched to the whole window.

    ``increase`` is the sum of all steps that end in the window: over all windows they add up to what was ever counted behind
    the first sample. ``rate_per_second`` takes the steps between the window's own samples and stretches them to its
    ends, by as much as the first and last sample are away from them; if that is more than the usual distance of samples, by
    half of one only, and never to before the counter can have been zero. It is null below two samples.
    """
    rows = per_window(metrics, window)
    sampled = seconds_between(F.col("first.recorded_at"), F.col("last.recorded_at"))
    usual = sampled / (F.col("samples") - 1)

    def reach(gap):
        return F.when(gap >= usual * USUAL_GAPS, usual / 2).otherwise(gap)

    to_zero = F.when(F.col("inside") > 0, sampled * F.col("first.metric_value") / F.col("inside"))
    to_start = F.least(reach(seconds_between(F.col("window_start"), F.col("first.recorded_at"))),
                       F.when(F.col("first.metric_value") >= 0, to_zero))  # a null one does not count
    to_end = reach(seconds_between(F.col("last.recorded_at"), F.col("window_end")))
    grown = F.try_divide(F.col("inside") * (sampled + to_start + to_end), sampled)
    length = seconds_between(F.col("window_start"), F.col("window_end"))
    return rows.select(
        *COUNTER_KEYS, "window_start", "samples", "restarts", F.coalesce("increase", F.lit(0.0)).alias("increase"),
        F.when(F.col("samples") > 1, grown / length).alias("rate_per_second"))

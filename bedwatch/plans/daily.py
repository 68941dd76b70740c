"""The daily risk job: pending days, scoring of all requested days in one pass, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bedwatch.config import DEFAULTS, Settings
from bedwatch.operators.features import assign_period, daily_features
from bedwatch.operators.panel import LAB_KEYS, latest_labs, panel_scores
from bedwatch.operators.risk import RISK_KEYS, score_patients
from bedwatch.plans.reports import daily_report, report_documents
from bedwatch.sinks.tables import (
    append_rows, export_documents_json, export_report_csv, read_if_exists, replace_days, upsert_days,
)
from bedwatch.operators.health import run_totals
from bedwatch.session import stage, temporary_stages
from bedwatch.sources.labs import (
    available_days, flatten_reports, lab_periods, read_lab_files, rejected_reports, with_time, without_bounds,
)
from bedwatch.sources.readings import dedupe_readings, scan_archive


def pending_days(available: DataFrame, scored: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` available days that no run has finished yet."""
    days = available.select("simulated_day").distinct()
    return (
        days.join(scored.select("simulated_day").distinct(), "simulated_day", "left_anti")
        .orderBy("simulated_day").limit(limit)
    )


def score_days(readings: DataFrame, labs: DataFrame, periods: DataFrame,
               cfg: Settings = DEFAULTS) -> DataFrame:
    """Risk rows of every day in ``periods``; the days are a column, not a loop.

    ``labs`` holds the latest result per test. Periods are assigned first, so
    that readings outside of them are pruned at the scan and never shuffled;
    copies are then dropped within each day, as periods may overlap. The bounds
    of the days, at most ``max_days_per_run`` rows, become literals: a join on the day
    would deal all rows to that many tasks.
    """
    in_period = dedupe_readings(assign_period(readings, periods, cfg), "simulated_day")
    risk = score_patients(daily_features(in_period, cfg), panel_scores(labs, cfg), cfg)
    rows = periods.select("simulated_day", "period_start", "period_end", F.to_date("period_end").alias("report_date")).collect()

    def of_day(column: str, kind: str):
        """One constant map, however many days there are."""
        pairs = [F.lit(x) for r in rows for x in (r["simulated_day"], r[column])]
        return F.try_element_at(F.create_map(*pairs), F.col("simulated_day")).cast(kind) if rows else F.lit(None).cast(kind)

    return risk.withColumns({"period_start": of_day("period_start", "timestamp"),
                             "period_end": of_day("period_end", "timestamp"),
                             "report_date": of_day("report_date", "date")})


def run_days(spark: SparkSession, days: list[int], lab_folder: str, archive: str,
             lab_table: str, risk_table: str, cfg: Settings = DEFAULTS,
             metrics_table: str | None = None, reject_table: str | None = None) -> DataFrame:
    """Ingest, score and store the given days; running a day again gives the same rows.

    Unusable reports and tests go to ``reject_table``; a day that no longer has any loses those of its run before.
    Staged tables are removed at the end.
    """
    with temporary_stages(spark):
        reports = stage(with_time(read_lab_files(spark, lab_folder, days)), "lab-reports")
        rejects = stage(rejected_reports(reports), "lab-rejects")
        labs = stage(latest_labs(flatten_reports(reports)).select(
            "patient_id", "test_type", "result_value", "reference_min", "reference_max",
            "is_abnormal", "collected_at", "simulated_day"), "labs")
        upsert_days(labs, lab_table, LAB_KEYS, staged=True)
        if reject_table:
            replace_days(rejects, reject_table, days=days)
        periods = stage(lab_periods(reports, cfg), "periods")
        first, last = periods.agg(F.min("period_start"), F.max("period_end")).first()
        readings = scan_archive(spark, archive, first, last)
        # a day is few files, and scoring is the work: it is done behind the shuffle that grouping needs anyhow
        stored = spark.read.schema(labs.schema).parquet(lab_table).filter(
            F.col("simulated_day").isin(days)).repartition(*RISK_KEYS)
        risk = stage(score_days(readings, stored, periods, cfg), "risk")
        upsert_days(risk, risk_table, RISK_KEYS, staged=True)
        if metrics_table:
            totals = run_totals(labs, risk)
            for name, counted in (("records_rejected", rejects), ("labs_without_bounds", without_bounds(labs))):
                totals = totals.unionByName(counted.agg(
                    F.lit("batch_layer").alias("component"), F.lit(name).alias("metric_name"),
                    F.count("*").cast("double").alias("metric_value")))
            append_rows(totals.withColumn("recorded_at", F.current_timestamp()), metrics_table)
        schema = risk.schema
    return spark.read.schema(schema).parquet(risk_table).filter(F.col("simulated_day").isin(days))


def catch_up(spark: SparkSession, lab_folder: str, archive: str, lab_table: str, risk_table: str,
             patients: DataFrame, report_folder: str, cfg: Settings = DEFAULTS,
             reject_table: str | None = None, finished_table: str | None = None,
             metrics_table: str | None = None) -> list[int]:
    """Score the pending days and add their reports to those already there; returns the days done.

    The totals of every run are appended to ``metrics_table``. Tables that are not named lie in the report folder.

    Days are finished when a run has dealt with them, whether or not they gave a row:
    a day whose reports are all unusable does not come up again.
    """
    finished_table = finished_table or f"{report_folder}/finished"
    available = available_days(spark, lab_folder)
    done = read_if_exists(spark, finished_table)
    done = available.limit(0) if done is None else done
    todo = [r[0] for r in pending_days(available, done, cfg.max_days_per_run).collect()]
    if not todo:
        return []
    risk = run_days(spark, todo, lab_folder, archive, lab_table, risk_table, cfg,
                    metrics_table or f"{report_folder}/metrics", reject_table or f"{report_folder}/rejects")
    stored = spark.read.schema(risk.schema).parquet(risk_table)
    with temporary_stages(spark):
        report = stage(daily_report(stored, patients, todo), "report")
        export_report_csv(report, f"{report_folder}/csv", todo)
        export_documents_json(report_documents(report), f"{report_folder}/json", todo, report)
    # last, so that a run that broke off is done again
    replace_days(spark.createDataFrame([(d,) for d in todo], "simulated_day int").withColumn(
        "finished_at", F.current_timestamp()), finished_table)
    return todo

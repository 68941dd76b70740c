"""One registered query per operator, each over the whole given tables.

Results are shaped for comparison: times as text, averages and slopes rounded
through DECIMAL, counts as long.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from bedwatch.config import VITALS
from bedwatch.functions import scoring
from bedwatch.functions.numeric import render_time, round_to
from bedwatch.functions.vitals import breaches_any, vital_status
from bedwatch.operators import alerts as al, changes, counters, episodes, features as fe, health, panel, risk as rk
from bedwatch.operators import rules, staleness as st, windows as wn
from bedwatch.plans import daily, health as hp, reports as rp, ward
from bedwatch.session import move_folder, new_folder, numbered_folders, stage
from bedwatch.sinks import tables as tb
from bedwatch.sources import labs as lb, patients as pt, readings as rd
from bedwatch.streaming import speed_layer as sl, staleness as sst
from bedwatch.streaming.alerts import read_alerts
from bedwatch.streaming.corrections import corrected_features, late_readings
from bedwatch.streaming.metrics import BatchMetrics
from contract import inputs as inp
from contract.inputs import CFG, as_of

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf)

    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


def txt(column: str):
    return render_time(F.col(column)).alias(column)


def num(column: str, digits: int = 6):
    return round_to(F.col(column), digits).alias(column)


def big(column: str):
    return F.col(column).cast("long").alias(column)


def words(column: str):
    return F.concat_ws("|", F.col(column)).alias(column)


def day_text(column: str):
    return F.col(column).cast("string").alias(column)


# ---- readings ------------------------------------------------------------

def _parsed(spark, sf):
    payload = inp.as_payload(inp.table(spark, sf, "events"))
    return rd.parse_payload(payload.unionByName(payload))  # everything delivered twice


@query
def readings_clean(spark, sf):
    clean = rd.dedupe_readings(rd.valid_readings(_parsed(spark, sf)))
    return clean.select("event_id", "patient_id", "condition", txt("event_time"), *[num(v) for v in VITALS])


@query
def readings_quarantine(spark, sf):
    bad = rd.quarantined_readings(_parsed(spark, sf))
    return bad.groupBy("reject_reason").agg(F.count("*").alias("records"))


@query
def breach_flags(spark, sf):
    return inp.readings(spark, sf).select(
        "event_id", "patient_id", breaches_any(CFG).alias("abnormal"),
        *[vital_status(v, F.col(v), CFG).alias(f"{v}_status") for v in VITALS])


@query
def breach_events(spark, sf):
    return episodes.with_message(episodes.breach_events(inp.readings(spark, sf), CFG)).select(
        "event_id", "patient_id", "vital_name", num("vital_value"), "threshold_value", "severity",
        txt("event_time"), "message")


@query
def breach_collapse(spark, sf):
    collapsed = episodes.collapse_breaches(episodes.breach_events(inp.readings(spark, sf), CFG), CFG)
    return collapsed.select("patient_id", "vital_name", "occurrences", "any_critical", "event_id",
                            num("vital_value"), "threshold_value", "severity", txt("event_time"))


@query
def state_changes(spark, sf):
    return changes.state_changes(inp.readings(spark, sf)).select(
        "patient_id", "event_id", txt("event_time"), "previous", "condition")


# ---- windows -------------------------------------------------------------

def _window_columns():
    return [txt("window_start"), txt("window_end"), num("avg_heart_rate"), num("avg_spo2"),
            num("avg_systolic_bp"), num("avg_diastolic_bp"), num("avg_temperature"), num("min_spo2"),
            num("max_heart_rate"), big("reading_count")]


@query
def vitals_windows(spark, sf):
    return inp.windows(spark, sf).select("patient_id", *_window_columns())


def _stream(spark, sf):
    return rd.valid_readings(rd.parse_payload(inp.as_payload(inp.stream_of(spark, sf))))


@query
def stream_vitals_windows(spark, sf):
    folders = sl.Folders.under(new_folder(spark, "stream-windows"))
    sl.start_windows(_stream(spark, sf), folders, CFG, drain=True).awaitTermination()
    return sl.read_windows(spark, folders).select("patient_id", *_window_columns())


@query
def stream_windows_deduped(spark, sf):
    """Windows of a stream in which every reading with an id arrives twice, in different batches."""
    folders = sl.Folders.under(new_folder(spark, "stream-deduped"))
    sl.start_windows(inp.repeated_stream(spark, sf), folders, inp.UNIQUE_CFG, drain=True, unique=True).awaitTermination()
    return sl.read_windows(spark, folders).select("patient_id", *_window_columns())


def _late_run(spark, sf):
    """Readings of the first days arriving last: archive and windows drained, then what they missed put right."""
    folders = sl.Folders.under(new_folder(spark, "stream-late"))
    readings = inp.late_stream(spark, sf)
    sl.start_archive(readings, folders, CFG, drain=True).awaitTermination()
    watcher = BatchMetrics(folders.metrics)
    spark.streams.addListener(watcher)
    windows = watcher.watch(sl.start_windows(readings, folders, CFG, drain=True))
    windows.awaitTermination()
    watcher.settle(windows)
    spark.streams.removeListener(watcher)
    sl.start_corrections(sl.archived_stream(spark, folders), folders, CFG, drain=True, origin=inp.ORIGIN).awaitTermination()
    return folders


@query
def stream_late_corrections(spark, sf):
    return sl.read_windows(spark, _late_run(spark, sf)).select("patient_id", *_window_columns())


@query
def stream_corrected_features(spark, sf):
    """Daily features as computed before the late readings came, with what the corrections put in their place."""
    before = inp.readings(spark, sf).filter(~inp.held_back(spark, sf))
    before = fe.daily_features(fe.assign_aligned_day(rd.dedupe_readings(before), inp.ORIGIN, CFG), CFG)
    return corrected_features(spark, _late_run(spark, sf), before).select(*_feature_columns())


@query
def stream_late_rows(spark, sf):
    """Patient windows the window query was too late for, and the readings held back that the late log has."""
    folders = _late_run(spark, sf)
    dropped = sl.read_metrics(spark, folders).filter("metric_name = 'rows_late'").agg(
        F.lit("windows dropped as late").alias("what"), F.sum("metric_value").cast("long").alias("n"))
    kept = late_readings(spark, folders).filter(inp.held_back(spark, sf)).agg(
        F.lit("late readings kept").alias("what"), F.countDistinct("event_id").alias("n"))
    return dropped.unionByName(kept)


@query
def stream_raw_archive(spark, sf):
    folders = sl.Folders.under(new_folder(spark, "stream-archive"))
    sl.start_archive(_stream(spark, sf), folders, CFG, drain=True).awaitTermination()
    return rd.scan_archive(spark, folders.archive).groupBy("event_date").agg(
        F.count("*").alias("readings"), F.count("event_id").alias("with_id"),
    ).select(day_text("event_date"), "readings", "with_id")


@query
def patient_vitals(spark, sf):
    return wn.recent_windows(inp.windows(spark, sf), 20).select("patient_id", *_window_columns())


@query
def ews_latest(spark, sf):
    latest = wn.latest_window(inp.windows(spark, sf)).select(
        "patient_id", "window_end",
        *[round_to(F.col(f"avg_{v}"), 6).alias(v) for v in ward.CARD_VITALS])
    return ward.early_warning(latest, CFG).select(
        "patient_id", txt("window_end"), *ward.CARD_VITALS,
        *[F.col(f"ews_components.{v}").cast("long").alias(f"{v}_points") for v in ward.CARD_VITALS],
        big("early_warning_score"), "early_warning_level")


@query
def live_trend(spark, sf):
    return wn.live_features(inp.windows(spark, sf), CFG).select(
        "patient_id", txt("last_window_end"), num("heart_rate"), num("spo2"), num("systolic_bp"),
        num("temperature"), num("hr_trend", 5), num("spo2_trend", 5))


# ---- daily job -----------------------------------------------------------

def _feature_columns():
    return ["patient_id", big("simulated_day"), big("total"), big("abnormal"), num("hr_trend", 5),
            num("spo2_trend", 5), num("avg_heart_rate"), num("min_spo2"), num("max_temperature")]


@query
def daily_features(spark, sf):
    return inp.features(spark, sf).select(*_feature_columns())


def _end_of_day_periods(readings):
    """Two-day periods that end with the last reading of each date, so they overlap."""
    return (
        readings.groupBy(F.to_date("event_time").alias("d")).agg(F.max("event_time").alias("period_end"))
        .select(F.dayofyear("d").alias("simulated_day"), "period_end",
                (F.col("period_end") - F.expr("INTERVAL 2 DAYS")).alias("period_start"))
    )


@query
def period_features(spark, sf):
    cfg = CFG.with_(period_seconds=2 * inp.DAY)
    readings = inp.readings(spark, sf)
    joined = fe.assign_period(rd.dedupe_readings(readings), _end_of_day_periods(readings), cfg)
    return fe.daily_features(joined, cfg).select(*_feature_columns())


@query
def lab_flatten(spark, sf):
    return lb.flatten_reports(inp.lab_reports(spark, sf)).select(
        "report_id", "patient_id", big("simulated_day"), big("test_pos"), "test_type", num("result_value", 2),
        "reference_min", "reference_max", "is_abnormal", txt("collected_at"), num("l_extendedprice", 2))


@query
def lab_rejects(spark, sf):
    return lb.rejected_reports(inp.lab_reports(spark, sf)).groupBy(
        big("simulated_day"), "reject_reason").agg(F.count("*").alias("rejected"))


@query
def lab_periods(spark, sf):
    return lb.lab_periods(inp.lab_reports(spark, sf), CFG).select(
        big("simulated_day"), txt("period_start"), txt("period_end"), day_text("report_date"), "reports")


def _lab_columns():
    return ["patient_id", "test_type", big("simulated_day"), num("result_value", 2), "reference_min",
            "reference_max", "is_abnormal", txt("collected_at")]


@query
def lab_latest(spark, sf):
    return inp.labs(spark, sf).select(*_lab_columns())


@query
def lab_flag_audit(spark, sf):
    audited = lb.audit_flags(lb.flatten_reports(inp.lab_reports(spark, sf)))
    return audited.groupBy("test_type", "reference_range", "is_abnormal", "derived_abnormal", "flag_matches").agg(
        F.count("*").alias("tests"))


@query
def lab_score(spark, sf):
    return panel.panel_scores(inp.labs(spark, sf), CFG).select(
        "patient_id", big("simulated_day"), num("max_severity", 2), big("labs_out_of_range"),
        big("abnormal_labs_count"), "lab_risk_score")


@query
def lab_severities(spark, sf):
    return panel.score_tests(inp.labs(spark, sf), CFG).select(
        "patient_id", "test_type", big("simulated_day"), "severity")


@query
def patient_labs(spark, sf):
    return panel.recent_labs(inp.labs(spark, sf), 20).select(*_lab_columns())


def _risk_columns():
    return ["patient_id", big("simulated_day"), day_text("report_date"), "vitals_risk_score", "lab_risk_score",
            "combined_risk_score", "risk_level", big("abnormal_vitals_count"), big("abnormal_labs_count"),
            big("readings_analyzed"), "heart_rate_trend", "spo2_trend"]


@query
def daily_risk(spark, sf):
    """Flagship: each patient's risk per day from raw readings and nested lab reports."""
    return inp.risk(spark, sf).select(*_risk_columns())


@query
def risk_factors(spark, sf):
    return inp.risk(spark, sf).select(
        "patient_id", big("simulated_day"), "risk_factors",
        F.size(scoring.split_factors(F.col("risk_factors"))).cast("long").alias("n_factors"))


@query
def risk_change(spark, sf):
    return rk.with_previous_day(inp.risk(spark, sf)).select(
        "patient_id", big("simulated_day"), "combined_risk_score", "previous_score", num("risk_change", 4))


@query
def latest_risk(spark, sf):
    return rk.latest_risk(inp.risk(spark, sf)).select(
        "patient_id", big("simulated_day"), "combined_risk_score", "risk_level", num("risk_change", 4))


@query
def risk_breakdown(spark, sf):
    parts = scoring.risk_breakdown(F.col("vitals_risk_score"), F.col("lab_risk_score"),
                                   F.col("combined_risk_score"), F.col("risk_level"), CFG)
    return inp.risk(spark, sf).select("patient_id", big("simulated_day"), parts.alias("b")).select(
        "patient_id", "simulated_day", "b.*")


@query
def pending_days(spark, sf):
    """Days with labs, against days whose readings up to the tenth were already scored."""
    done = fe.assign_aligned_day(inp.readings(spark, sf), inp.ORIGIN, CFG).filter(
        F.col("event_time") < F.lit("2024-01-11").cast("timestamp"))
    return daily.pending_days(inp.lab_reports(spark, sf), done, CFG.max_days_per_run).select(big("simulated_day"))


@query
def run_totals(spark, sf):
    return health.run_totals(inp.labs(spark, sf), inp.risk(spark, sf))


def _daily_job(spark, sf):
    """Lab files and an archive for the job: day 4 has reports nobody can be given, days 5 and 6 come as lines."""
    root, reports = _daily_inputs(spark, sf)
    _deliver(reports.withColumn("patient_id", F.when(F.col("simulated_day") != 4, F.col("patient_id"))), root)
    patients = inp.patients(spark, sf).withColumn("patient_id", F.col("patient_id").cast("string"))
    steps = []
    while done := daily.catch_up(spark, f"{root}/labs", f"{root}/archive", f"{root}/lab_table", f"{root}/risk_table",
                                 patients, f"{root}/reports", CFG):
        steps.append(done)
    return root, steps


def _deliver(reports, root):
    """The lab files of all days of ``reports``, in place of those already there; the rows are computed and written once."""
    drop = new_folder(reports.sparkSession, "lab-drop")
    reports.withColumn("day", F.col("simulated_day")).write.partitionBy("day").json(drop)
    for day in numbered_folders(reports.sparkSession, drop, "day"):
        move_folder(reports.sparkSession, f"{drop}/day={day}", lb.lab_lines_path(f"{root}/labs", day))


def _daily_inputs(spark, sf):
    """The archive the job reads, and the reports of its lab files."""
    root = new_folder(spark, "daily-job")
    labs = inp.labs(spark, sf)
    test = F.struct("test_type", "result_value", F.lit("u").alias("unit"), "reference_min", "reference_max",
                    F.lit("").alias("reference_range"), "is_abnormal")
    taken = F.date_format(F.lit(inp.ORIGIN).cast("timestamp") + F.make_dt_interval(F.col("simulated_day") * 5),
                          "yyyy-MM-dd'T'HH:mm:ssXXX")
    reports = labs.select(
        F.concat_ws("-", "patient_id", "test_type", "simulated_day").alias("report_id"),
        F.col("patient_id").cast("string").alias("patient_id"),
        "simulated_day", taken.alias("collected_at"), F.array(test).alias("tests"))
    readings = inp.readings(spark, sf).withColumns({
        "event_id": F.col("event_id").cast("string"), "patient_id": F.col("patient_id").cast("string"),
        "timestamp": F.lit(None).cast("string"), "is_abnormal": F.lit(None).cast("boolean"),
        "event_date": F.to_date("event_time")})
    readings.write.partitionBy("event_date").parquet(f"{root}/archive")
    return root, reports


@query
def run_days_risk(spark, sf):
    """Three days, of which the second has wrong values and reports of nobody at first; then it is corrected and run again."""
    root, reports = _daily_inputs(spark, sf)
    reports = stage(reports.filter("simulated_day <= 3"), "reports", "simulated_day")
    wrong = F.transform("tests", lambda t: t.withField("result_value", t["result_value"] * 3 + 1))
    second = reports.filter("simulated_day = 2")

    def run(days):
        return daily.run_days(spark, days, f"{root}/labs", f"{root}/archive", f"{root}/lab_table", f"{root}/risk_table",
                              CFG, reject_table=f"{root}/rejects")

    _deliver(reports.filter("simulated_day <> 2").unionByName(second.withColumn("tests", wrong)).unionByName(
        second.withColumn("patient_id", F.lit(None).cast("string"))), root)
    run([1, 2, 3])
    _deliver(second, root)
    run([2])
    run([2])
    rejects = spark.read.schema("report_id string, simulated_day int").parquet(f"{root}/rejects").filter("simulated_day = 2")
    risk = spark.read.parquet(f"{root}/risk_table").withColumn("patient_id", F.col("patient_id").cast("long"))
    return risk.select(*_risk_columns()).withColumn("rejects_left", F.lit(rejects.count()).cast("long"))


@query
def catch_up_totals(spark, sf):
    """What the runs of the daily job counted, added up over the runs."""
    root, _ = _daily_job(spark, sf)
    totals = spark.read.parquet(f"{root}/reports/metrics")
    return totals.groupBy("component", "metric_name").agg(
        F.when(F.col("metric_name") == "last_simulated_day", F.max("metric_value")).otherwise(F.sum("metric_value"))
        .alias("metric_value"), F.countDistinct("recorded_at").alias("runs"))


@query
def catch_up_days(spark, sf):
    """The daily job until nothing is pending, three days a run, one of them without a usable report."""
    root, steps = _daily_job(spark, sf)
    risk = spark.read.parquet(f"{root}/risk_table").withColumn("patient_id", F.col("patient_id").cast("long"))
    return risk.select(*_risk_columns(), F.lit(len(steps)).cast("long").alias("runs"))


@query
def catch_up_reports(spark, sf):
    """The CSV reports of all days after those runs, and the rejected reports."""
    root, _ = _daily_job(spark, sf)
    csv = spark.read.option("header", True).csv(f"{root}/reports/csv").groupBy("simulated_day").agg(
        F.count("*").alias("rows"), F.lit("report").alias("kind"))
    rejects = spark.read.parquet(f"{root}/reports/rejects").groupBy("simulated_day", "reject_reason").agg(
        F.count("*").alias("rows"))
    return csv.select(big("simulated_day"), "kind", "rows").unionByName(
        rejects.select(big("simulated_day"), F.col("reject_reason").alias("kind"), "rows"))


# ---- keyed writes --------------------------------------------------------

@query
def lab_upsert(spark, sf):
    """Raw results stored first, then the latest ones upserted by key: only the latest remain per key."""
    path = new_folder(spark, "lab-table")
    columns = ["patient_id", "test_type", "result_value", "reference_min", "reference_max", "is_abnormal",
               "collected_at", "simulated_day"]
    flat = lb.flatten_reports(inp.lab_reports(spark, sf))
    early = panel.latest_labs(flat.filter(F.col("collected_at") < F.lit("1998-01-01").cast("timestamp")), inp.LATEST)
    late = panel.latest_labs(flat.filter(F.col("collected_at") >= F.lit("1998-01-01").cast("timestamp")), inp.LATEST)
    tb.upsert_days(early.select(*columns), path, panel.LAB_KEYS)
    tb.upsert_days(late.select(*columns), path, panel.LAB_KEYS)
    return spark.read.parquet(path).select(*_lab_columns())


@query
def risk_upsert(spark, sf):
    """The same risk rows stored twice: a replay changes nothing."""
    path = new_folder(spark, "risk-table")
    risk = stage(inp.risk(spark, sf), "risk")
    tb.upsert_days(risk, path, rk.RISK_KEYS)
    tb.upsert_days(risk, path, rk.RISK_KEYS)
    return spark.read.parquet(path).select(*_risk_columns())


@query
def window_changelog(spark, sf):
    """Partial windows, then final ones, then compaction: the last emission counts."""
    path = new_folder(spark, "window-log")
    readings = inp.readings(spark, sf)
    half = readings.filter(F.hour("event_time") < 12)
    tb.write_changes(wn.window_aggregates(half, CFG), path, 0)
    tb.compact_changes(spark, path, sl.WINDOW_KEYS)
    tb.write_changes(wn.window_aggregates(readings, CFG), path, 1)
    return tb.latest_rows(spark, path, sl.WINDOW_KEYS).select("patient_id", *_window_columns())


@query
def patients_insert_absent(spark, sf):
    """Suppliers as newcomers, and customers of record once more, added to the customers of record."""
    known = inp.patients(spark, sf)
    seen = inp.table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + F.lit(1_000_000)).alias("patient_id"), F.col("s_name").alias("name"),
        F.lit("General").alias("ward"), F.lit(None).cast("string").alias("bed_number"))
    again = known.withColumn("name", F.lit("must not overwrite"))
    return pt.insert_absent(known, seen.unionByName(again).unionByName(seen)).select(
        "patient_id", "name", "ward", "bed_number")


# ---- reports -------------------------------------------------------------

def _report(spark, sf):
    return rp.daily_report(inp.risk(spark, sf), inp.patients(spark, sf))


def _report_columns():
    return [big("simulated_day"), "patient_id", "name", "ward", "bed", "risk_level", "combined_risk", "risk_change",
            "vitals_risk", "lab_risk", big("abnormal_vitals"), big("abnormal_labs"), big("readings_analyzed"),
            "heart_rate_trend", "spo2_trend", "risk_factors"]


@query
def daily_report(spark, sf):
    return rp.in_report_order(_report(spark, sf)).select(*_report_columns())


@query
def latest_report(spark, sf):
    risk = stage(inp.risk(spark, sf), "risk", "simulated_day")
    return rp.latest_report(risk, inp.patients(spark, sf)).select(*_report_columns())


@query
def report_on_date(spark, sf):
    risk = stage(inp.risk(spark, sf), "risk", "simulated_day")
    return rp.report_on_date(risk, inp.patients(spark, sf), "2024-01-16").select(*_report_columns())


@query
def report_summary(spark, sf):
    return rp.report_summary(_report(spark, sf)).select(
        big("simulated_day"), day_text("report_date"), "total_patients", "critical_count", "high_count",
        "moderate_count", "low_count")


def _document_lines(lines):
    return lines.select(
        big("simulated_day"), big("position"), F.col("patient.patient_id").alias("patient_id"), "patient.combined_risk",
        "patient.risk_level", F.col("summary.total_patients").alias("total_patients"),
        F.col("summary.critical_count").alias("critical_count"))


@query
def report_documents(spark, sf):
    """A summary line and the patients' lines per day, with their positions."""
    return _document_lines(rp.report_documents(stage(_report(spark, sf), "report")))


@query
def report_json(spark, sf):
    """Documents exported as JSON in two runs of three days each, and read back."""
    path = new_folder(spark, "report-json")
    report = stage(_report(spark, sf), "report")
    lines = rp.report_documents(report)
    tb.export_documents_json(rp.report_documents(report.filter("simulated_day <= 3")), path)
    tb.export_documents_json(rp.report_documents(report.filter("simulated_day > 3")), path)
    return _document_lines(spark.read.schema(lines.schema).json(path))


@query
def report_csv(spark, sf):
    """Report exported as CSV and read back."""
    path = new_folder(spark, "report-csv")
    tb.export_report_csv(_report(spark, sf), path)
    schema = ("simulated_day long, patient_id long, name string, ward string, bed string, risk_level string, "
              "combined_risk double, risk_change double, vitals_risk double, lab_risk double, abnormal_vitals long, "
              "abnormal_labs long, readings_analyzed long, heart_rate_trend double, spo2_trend double, "
              "risk_factors string")
    return spark.read.schema(schema).option("header", True).csv(path).drop("day")


@query
def report_days(spark, sf):
    return rp.report_days(inp.risk(spark, sf)).select(big("simulated_day"), day_text("report_date"))


@query
def latest_report_day(spark, sf):
    return rp.latest_report_day(inp.risk(spark, sf)).select(big("day"))


HISTORY_DAYS = 4


def _history(spark, sf):
    return rp.ward_history(stage(inp.risk(spark, sf), "risk"), inp.patients(spark, sf), HISTORY_DAYS)


@query
def ward_history(spark, sf):
    return _history(spark, sf).select("patient_id", "name", big("simulated_day"), "combined_risk", "vitals_risk",
                                      "lab_risk", "risk_level")


@query
def ward_day_summary(spark, sf):
    return rp.ward_day_summary(_history(spark, sf)).select(
        big("simulated_day"), "avg_risk", "critical", "high", "moderate", "low")


@query
def patient_direction(spark, sf):
    return rp.patient_histories(_history(spark, sf), CFG).select(
        "patient_id", "name", "latest_change", "direction", F.size("scores").cast("long").alias("days"),
        F.concat_ws("|", F.transform("scores", lambda s: s["combined_risk"].cast("string"))).alias("scores"))


@query
def direction_counts(spark, sf):
    return rp.direction_counts(rp.patient_histories(_history(spark, sf), CFG))


@query
def risk_heatmap(spark, sf):
    wide = rp.risk_heatmap(rp.ward_history(stage(inp.risk(spark, sf), "risk"), inp.patients(spark, sf), 6))
    days = [c for c in wide.columns if c not in ("patient_id", "name")]
    return wide.select("patient_id", "name", *[F.col(d).alias(f"day_{d}") for d in days])


@query
def patient_risk_history(spark, sf):
    return rp.patient_risk_history(inp.risk(spark, sf), 3).select(*_risk_columns())


# ---- ward ----------------------------------------------------------------

def _ward_risk(spark, sf):
    return ward.ward_risk(inp.windows(spark, sf), inp.risk(spark, sf), inp.patients(spark, sf), CFG)


@query
def ward_risk(spark, sf):
    return _ward_risk(spark, sf).select(
        "patient_id", "name", "ward", "bed", "outlook", words("concern_codes"), big("early_warning_score"),
        "early_warning_level", num("heart_rate"), num("spo2"), num("systolic_bp"), num("temperature"),
        num("hr_trend", 5), num("spo2_trend", 5), txt("last_window_end"), big("simulated_day"), "risk_level",
        "combined_risk_score", "lab_risk_score", "vitals_risk_score", num("risk_change", 4))


@query
def ward_concerns(spark, sf):
    return _ward_risk(spark, sf).select("patient_id", F.posexplode("concerns").alias("position", "concern")).select(
        "patient_id", big("position"), "concern")


@query
def ward_attention(spark, sf):
    return ward.needs_attention(_ward_risk(spark, sf)).select("patient_id", "outlook", big("early_warning_score"))


def _status(spark, sf):
    return ward.ward_status(inp.patients(spark, sf), inp.windows(spark, sf))


@query
def ward_status(spark, sf):
    return _status(spark, sf).select(
        "patient_id", "name", "ward", "bed", num("heart_rate"), num("spo2"), num("systolic_bp"),
        num("diastolic_bp"), num("temperature"), txt("last_reading"))


@query
def ward_totals(spark, sf):
    return ward.ward_totals(inp.patients(spark, sf), _alerts(spark, sf))


@query
def ward_overview(spark, sf):
    risk = stage(inp.risk(spark, sf).select("patient_id", "simulated_day", "risk_level"), "risk", "simulated_day")
    day = rp.latest_report_day(risk).first()[0]
    cards = ward.ward_overview(_status(spark, sf), _all_alerts(spark, sf),
                               risk.filter(F.col("simulated_day") == day), as_of(), CFG)
    return cards.select(
        "patient_id", "name", *[f"{v}_status" for v in ward.CARD_VITALS], "risk_status", "overall_status",
        big("open_alerts"), big("triage_score"), big("age_seconds"))


@query
def attention_count(spark, sf):
    return ward.attention_count(_ward_risk(spark, sf))


@query
def patient_status(spark, sf):
    return ward.patient_status(inp.risk(spark, sf)).select(
        "patient_id", big("simulated_day"), "risk_level", "overall_status", words("factors"))


# ---- alerts --------------------------------------------------------------

def _breaches(spark, sf):
    return episodes.breach_events(inp.readings(spark, sf), CFG)


def _episodes(spark, sf):
    return episodes.alert_episodes(_breaches(spark, sf), None, CFG)


def _alerts(spark, sf):
    """All episodes; those of temperature are acknowledged an hour after they were last seen."""
    alerts = stage(_episodes(spark, sf), "episodes")
    requests = alerts.filter("vital_name = 'temperature'").select(
        "alert_id", (F.col("last_seen_at") + F.expr("INTERVAL 1 HOUR")).alias("acked_at"))
    return al.with_acknowledged(alerts, requests)


def _all_alerts(spark, sf):
    """Vital, staleness and error-rate alerts in one table."""
    errors = health.error_rate_alert(health.error_rate(inp.counters(spark, sf)), _no_alerts(spark), as_of(), CFG)
    return al.unite_alerts(_alerts(spark, sf), _staleness(spark, sf), errors)


def _alert_columns():
    return ["patient_id", "severity", "vital_name", num("vital_value"), "threshold_value", txt("triggered_at"),
            txt("last_seen_at"), big("occurrences"), "event_id"]


@query
def alert_episodes(spark, sf):
    return _episodes(spark, sf).select(*_alert_columns(), "message")


@query
def acknowledge_answers(spark, sf):
    """Requests for every alert, one in three with an id that no alert has, and how they were answered."""
    found = stage(_episodes(spark, sf), "episodes")
    requests = found.select(
        "patient_id", "vital_name", txt("triggered_at"),
        F.when(F.col("patient_id") % 3 == 0, F.xxhash64("alert_id", F.lit("unknown"))).otherwise(F.col("alert_id")).alias("alert_id"))
    return al.acknowledge_answers(found, requests).select("patient_id", "vital_name", "triggered_at", "status")


@query
def alert_episodes_acked(spark, sf):
    """Every SpO2 and heart-rate alert acknowledged 30 hours after it opened, in the middle of longer runs."""
    breaches = _breaches(spark, sf)
    return episodes.alert_episodes(breaches, _acks(spark, sf), CFG).select(*_alert_columns())


def _acks(spark, sf):
    found = _episodes(spark, sf)
    requests = found.filter(F.col("vital_name").isin("spo2", "heart_rate")).select(
        "alert_id", (F.col("triggered_at") + F.expr("INTERVAL 30 HOURS")).alias("acked_at"))
    return stage(al.acknowledge(found, requests), "acks")

@query
def stream_alert_episodes(spark, sf):
    folders = sl.Folders.under(new_folder(spark, "stream-alerts"))
    sl.start_alerts(_stream(spark, sf), folders, CFG, drain=True).awaitTermination()
    return read_alerts(spark, folders.alerts).select(*_alert_columns())


@query
def stream_alerts_deduped(spark, sf):
    """Alerts of readings that arrive twice: a copy neither opens nor escalates one."""
    folders = sl.Folders.under(new_folder(spark, "stream-alerts-deduped"))
    sl.start_alerts(inp.repeated_stream(spark, sf), folders, inp.UNIQUE_CFG, drain=True, unique=True).awaitTermination()
    return read_alerts(spark, folders.alerts).select(*_alert_columns()).drop("event_id")


@query
def stream_alerts_acked(spark, sf):
    """The acknowledgements of ``alert_episodes_acked`` arriving in the stream, in step with the readings."""
    folders = sl.Folders.under(new_folder(spark, "stream-acks"))
    events = inp.events_in_time(spark, sf)
    bounds = inp.bounds_of(events, "ts")
    acks = _acks(spark, sf)
    readings = inp.streamed(inp.as_readings(events), inp.slice_of("event_time", bounds), "stream-readings")
    acked = inp.streamed(acks, inp.slice_of("acked_at", bounds), "stream-acks-input")
    sl.start_alerts(readings, folders, CFG, acked, drain=True).awaitTermination()
    return read_alerts(spark, folders.alerts).select(*_alert_columns())


@query
def stream_metrics(spark, sf):
    """What the queries of the speed layer counted, batch by batch, and how many batches that were."""
    root = new_folder(spark, "speed-layer")
    parsed = rd.parse_payload(inp.as_payload(inp.stream_of(spark, sf)))
    sl.start_speed_layer(rd.valid_readings(parsed), root, CFG, drain=True, parsed=parsed)
    metrics = sl.read_metrics(spark, sl.Folders.under(root))
    wanted = ["rows_read", "rows_late", "raw_records_archived", "breaches_seen", "records_rejected"]
    return metrics.filter(F.col("metric_name").isin(wanted)).groupBy("component", "metric_name").agg(
        F.sum("metric_value").alias("metric_value"),
        F.countDistinct(F.when(F.col("metric_value") > 0, F.col("batch"))).alias("batches"))


@query
def all_active_alerts(spark, sf):
    """The open alerts of every kind, without a limit."""
    return al.open_alerts(_all_alerts(spark, sf)).select(
        "patient_id", "alert_type", "severity", "message", "vital_name", txt("triggered_at"))


@query
def all_alert_counts(spark, sf):
    return al.severity_counts(_all_alerts(spark, sf)).select("severity", big("open_alerts"))


@query
def active_alerts(spark, sf):
    return al.active_alerts(_alerts(spark, sf), 50).select(*_alert_columns())


@query
def critical_alerts(spark, sf):
    return al.critical_alerts(_alerts(spark, sf), 5).select(*_alert_columns())


@query
def warning_alerts(spark, sf):
    return al.warning_alerts(_alerts(spark, sf)).select(*_alert_columns())


@query
def alert_counts(spark, sf):
    return al.severity_counts(_alerts(spark, sf)).select("severity", big("open_alerts"))


@query
def open_alerts_per_patient(spark, sf):
    return al.open_alerts_per_patient(_alerts(spark, sf))


# ---- health --------------------------------------------------------------

def _stale(spark, sf, when):
    return st.stale_patients(inp.patients(spark, sf), inp.windows(spark, sf), when, CFG)


@query
def stale_patients(spark, sf):
    return _stale(spark, sf, as_of()).select("patient_id", "name", txt("last_seen"))


@query
def stalest_age(spark, sf):
    return st.stalest_age(inp.windows(spark, sf), as_of()).select(big("age_seconds"))


@query
def staleness_alerts(spark, sf):
    """A check on the 20th over the windows known then, followed by one on the 31st."""
    return _staleness(spark, sf).select(
        "patient_id", "alert_type", "severity", "message", txt("triggered_at"), "acknowledged")


def _staleness(spark, sf):
    first_at = F.lit("2024-01-20 00:00:00").cast("timestamp")
    patients, windows = inp.patients(spark, sf), inp.windows(spark, sf)
    early = windows.filter(F.col("window_end") <= first_at)
    opened = st.after_check(_no_alerts(spark), st.stale_patients(patients, early, first_at, CFG), first_at, CFG)
    opened = stage(opened, "staleness")
    return st.after_check(opened, _stale(spark, sf, as_of()), as_of(), CFG)


def _no_alerts(spark):
    return spark.createDataFrame([], "alert_id long, patient_id string, alert_type string, severity string, "
                                     "message string, triggered_at timestamp, acknowledged boolean")


@query
def stream_staleness(spark, sf):
    """The same two checks by timers, over the readings as a stream; the clock goes on to the second one."""
    path = new_folder(spark, "silences")
    cfg = CFG.with_(watermark="0 seconds")
    signs = sst.signs_of_life(inp.as_readings(inp.stream_of(spark, sf)), cfg)
    people = sst.roster(inp.patients(spark, sf), F.lit(inp.ORIGIN))
    ends = sst.clock(spark.createDataFrame([(inp.AS_OF,), ("2024-02-01 00:00:00",)], "at string"))

    def once(df, slice_number, label):
        return inp.streamed(df, F.lit(slice_number), label)

    sources = signs.unionByName(once(people, 0, "stream-roster")).unionByName(once(ends, inp.SLICES - 1, "stream-clock"))
    checks = sst.Checks(datetime(2024, 1, 20), 11 * inp.DAY)
    sst.start_staleness(sources, f"{path}/alerts", f"{path}/checkpoint", checks, cfg, {"availableNow": True}).awaitTermination()
    return sst.read_silences(spark, f"{path}/alerts", inp.patients(spark, sf), cfg).select(
        "patient_id", "alert_type", "severity", "message", txt("triggered_at"), "acknowledged")


@query
def risk_level_distribution(spark, sf):
    return health.level_distribution(inp.risk(spark, sf)).select("risk_level", big("patients"), "avg_combined_risk")


@query
def active_patients(spark, sf):
    return health.active_patients(inp.patients(spark, sf))


@query
def error_rate(spark, sf):
    return health.error_rate(inp.counters(spark, sf)).select("errors", "total", num("error_rate"))


@query
def error_rate_by_day(spark, sf):
    return health.windowed_error_rate(inp.counters(spark, sf), inp.DAY, CFG).select(
        txt("window_start"), "errors", "total", num("error_rate"), num("alarm_rate"), "exceeded")


@query
def throughput(spark, sf):
    return health.throughput(inp.snapshots(spark, sf), "6 hours").select(
        "component", "metric_name", txt("window_start"), "metric_value", "increase", num("rate_per_second", 9))


@query
def counter_rates(spark, sf):
    """Counters that restart twice a day, per day."""
    return counters.counter_rates(inp.restarting_snapshots(spark, sf), "1 day").select(
        "component", "metric_name", txt("window_start"), big("samples"), big("restarts"), "increase",
        num("rate_per_second", 9))


@query
def metric_snapshot(spark, sf):
    return hp.metric_snapshot(inp.snapshots(spark, sf)).select(
        "component", "metric_name", "metric_value", txt("recorded_at"))


@query
def freshness(spark, sf):
    return health.component_freshness(inp.heartbeats(spark, sf), as_of(), CFG).select(
        "component", big("limit_seconds"), "severity", big("age_seconds"), "stale")


@query
def condition_checks(spark, sf):
    return health.condition_checks(
        st.stalest_age(inp.windows(spark, sf), as_of()), al.severity_counts(_alerts(spark, sf)), CFG)


@query
def health_alerts(spark, sf):
    return hp.all_checks(inp.patients(spark, sf), inp.windows(spark, sf), inp.counters(spark, sf),
                         _no_alerts(spark), as_of(), CFG).select("patient_id", "alert_type", "severity", "message")


@query
def health_summary(spark, sf):
    return hp.health_summary(inp.patients(spark, sf), inp.windows(spark, sf), inp.counters(spark, sf), as_of(),
                             CFG).select("check", num("value"), "limit", "status")


def _rule_states(spark, sf):
    """Heartbeats, error rates, patients' data and open critical alerts, looked at every hour."""
    cfg, grid = inp.RULES_CFG, inp.GRID
    hourly = health.windowed_error_rate(inp.counters(spark, sf), inp.HOUR, cfg)
    alerts = _episodes(spark, sf).withColumn(
        "acked_at", F.when(F.col("vital_name") == "temperature", F.col("last_seen_at") + F.expr("INTERVAL 1 HOUR")))
    alerts = alerts.filter(F.col("vital_name") == "temperature")
    samples = rules.freshness_samples(inp.heartbeats(spark, sf), grid, cfg).unionByName(
        rules.rate_samples(hourly, inp.HOUR)).unionByName(
        rules.patient_age_samples(inp.windows(spark, sf), grid, cfg)).unionByName(
        rules.open_alert_samples(alerts, grid))
    return rules.rule_states(samples, rules.holds_of(spark, cfg), as_of(), 3 * inp.HOUR)


@query
def rule_states(spark, sf):
    return _rule_states(spark, sf).select(
        "rule", "subject", "severity", txt("active_at"), txt("fired_at"), txt("last_active_at"), txt("ended_at"),
        big("samples"), "state")


@query
def rule_transitions(spark, sf):
    return rules.rule_transitions(_rule_states(spark, sf)).select(
        "rule", "subject", "severity", txt("at"), big("step"), "state")

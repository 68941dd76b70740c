import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS
from bedwatch.operators import features as fe, panel
from bedwatch.plans import daily
from bedwatch.sinks import tables as tb
from bedwatch.sources.labs import lab_file_path, lab_lines_path
from bedwatch.sources.readings import dedupe_readings

T0 = datetime(2026, 9, 30, 12, 0, 0)
READING = ("event_id string, patient_id string, heart_rate double, spo2 double, systolic_bp double, "
           "diastolic_bp double, temperature double, event_time timestamp")


def reading(eid, pid, seconds, hr=80.0, spo2=97.0):
    return (eid, pid, hr, spo2, 120.0, 80.0, 36.8, T0 + timedelta(seconds=seconds))


def with_date(df):
    return df.withColumn("event_date", F.to_date("event_time"))


def test_periods_are_half_open_and_may_overlap(spark):
    rows = [reading(str(i), "P", s) for i, s in enumerate((-301, -300, -1, 0, 100, 299, 300))]
    periods = spark.createDataFrame(
        [(1, T0 - timedelta(seconds=300), T0), (2, T0 - timedelta(seconds=100), T0 + timedelta(seconds=200)),
         (4, T0 + timedelta(seconds=299), T0 + timedelta(seconds=599))],
        "simulated_day int, period_start timestamp, period_end timestamp")
    df = with_date(spark.createDataFrame(rows, READING))
    got = sorted((r.simulated_day, r.event_id) for r in fe.assign_period(df, periods, DEFAULTS).collect())
    assert got == [(1, "1"), (1, "2"), (2, "2"), (2, "3"), (2, "4"), (4, "5"), (4, "6")]


def test_no_periods_gives_no_rows(spark):
    periods = spark.createDataFrame([], "simulated_day int, period_start timestamp, period_end timestamp")
    assert fe.assign_period(spark.createDataFrame([reading("1", "P", 0)], READING), periods).count() == 0


def test_features_slope(spark):
    rows = [reading(str(i), "P", 60 * i, hr=80.0 + 2 * i, spo2=97.0 - 0.5 * i) for i in range(5)]
    rows += [reading("x", "one", 0), reading("y", "same", 0, hr=1.0), reading("z", "same", 0.4, hr=2.0)]
    df = fe.assign_aligned_day(spark.createDataFrame(rows, READING), "2026-09-30 12:00:00", DEFAULTS)
    got = {r.patient_id: r for r in fe.daily_features(df).collect()}
    assert got["P"].simulated_day == 1 and got["P"].total == 5 and got["P"].abnormal == 0
    assert abs(got["P"].hr_trend - 2.0) < 1e-9 and abs(got["P"].spo2_trend + 0.5) < 1e-9
    assert got["one"].hr_trend is None
    assert got["same"].hr_trend is None and got["same"].abnormal == 2  # same second: no variance, no failure


def test_missing_half_scores_zero(spark):
    readings = fe.assign_aligned_day(
        spark.createDataFrame([reading("1", "vitals_only", 0, hr=130.0)], READING), "2026-09-30 12:00:00", DEFAULTS)
    labs = spark.createDataFrame([("lab_only", 1, "Glucose", 144.0, 70.0, 100.0, True)],
                                 "patient_id string, simulated_day int, test_type string, result_value double, "
                                 "reference_min double, reference_max double, is_abnormal boolean")
    from bedwatch.operators.risk import score_patients
    got = {r.patient_id: r for r in score_patients(fe.daily_features(readings), panel.panel_scores(labs)).collect()}
    assert (got["vitals_only"].vitals_risk_score, got["vitals_only"].lab_risk_score) == (100.0, 0.0)
    assert (got["vitals_only"].combined_risk_score, got["vitals_only"].risk_level) == (60.0, "HIGH")
    assert (got["lab_only"].vitals_risk_score, got["lab_only"].combined_risk_score) == (0.0, 40.0)
    assert got["lab_only"].risk_factors == "Glucose high (144.00, ref: 70.0-100.0)"
    assert got["lab_only"].readings_analyzed == 0


def make_day(spark, folder, day, patients=("P1", "P2")):
    end = T0 + timedelta(seconds=300 * day)
    test = {"test_type": "Glucose", "result_value": 70.0 + 20 * day, "unit": "u", "reference_min": 70,
            "reference_max": 100, "is_abnormal": day > 1}
    with open(lab_file_path(folder, day), "w") as f:
        json.dump([{"report_id": f"{day}{p}", "patient_id": p, "simulated_day": day,
                    "collected_at": end.isoformat() + "+00:00", "tests": [test]} for p in patients], f)


def test_run_replay_and_catch_up(spark, folder):
    labs, archive = folder + "/labs", folder + "/archive"
    import os
    os.makedirs(labs)
    rnd = random.Random(3)
    rows = [reading(f"{p}{s}", p, s, hr=rnd.choice([80.0, 130.0])) for p in ("P1", "P2") for s in range(0, 1500, 30)]
    with_date(spark.createDataFrame(rows + rows[:20], READING)).withColumns({
        "timestamp": F.lit(None).cast("string"), "is_abnormal": F.lit(None).cast("boolean"),
        "condition": F.lit(None).cast("string")}).write.partitionBy("event_date").parquet(archive)
    for day in (1, 2, 3, 4, 5):
        make_day(spark, labs, day)
    patients = spark.createDataFrame([("P1", "A", "W", "B1")], "patient_id string, name string, ward string, bed_number string")
    args = (labs, archive, folder + "/lab_table", folder + "/risk_table")
    assert daily.catch_up(spark, *args, patients, folder + "/reports") == [1, 2, 3]
    first = sorted(map(tuple, spark.read.parquet(folder + "/risk_table").collect()), key=str)
    assert len(first) == 6 and all(r[-1] in (1, 2, 3) for r in first)
    daily.run_days(spark, [2], *args, metrics_table=folder + "/metrics")
    assert sorted(map(tuple, spark.read.parquet(folder + "/risk_table").collect()), key=str) == first
    totals = {r.metric_name: r.metric_value for r in spark.read.parquet(folder + "/metrics").collect()}
    assert totals == {"raw_readings_processed": 20.0, "lab_records_ingested": 2.0, "risk_reports_written": 2.0,
                      "last_simulated_day": 2.0, "records_rejected": 0.0, "labs_without_bounds": 0.0}
    assert daily.catch_up(spark, *args, patients, folder + "/reports") == [4, 5]
    assert daily.catch_up(spark, *args, patients, folder + "/reports") == []
    csv = spark.read.option("header", True).csv(folder + "/reports/csv").collect()
    assert {(r.simulated_day, r.patient_id) for r in csv} == {(str(d), "P1") for d in range(1, 6)}
    lines = spark.read.json(folder + "/reports/json").filter("simulated_day = 5").orderBy("position").collect()
    assert lines[0].summary.total_patients == 1 and lines[0].summary.report_date == "2026-09-30"
    assert len(lines) == 2 and lines[1].patient.name == "A"
    assert spark.read.json(folder + "/reports/json").select("simulated_day").distinct().count() == 5
    row = spark.read.parquet(folder + "/risk_table").filter("simulated_day = 1 and patient_id = 'P1'").first()
    want = sum(1 for r in rows if r[1] == "P1" and T0 <= r[7] < T0 + timedelta(seconds=300))
    assert row.readings_analyzed == want == 10  # copies in the archive count once


def test_a_day_without_usable_reports_does_not_come_up_again(spark, folder):
    import os
    labs, archive = folder + "/labs", folder + "/archive"
    os.makedirs(labs)
    with_date(spark.createDataFrame([reading("1", "P1", 0), reading("2", "P1", 700)], READING)).withColumns({
        "timestamp": F.lit(None).cast("string"), "is_abnormal": F.lit(None).cast("boolean"),
        "condition": F.lit(None).cast("string")}).write.partitionBy("event_date").parquet(archive)
    make_day(spark, labs, 1, patients=(None,))
    make_day(spark, labs, 2)
    make_day(spark, labs, 3)
    with open(lab_file_path(labs, 3)) as f:  # the same day as lines instead
        reports = json.load(f)
    os.remove(lab_file_path(labs, 3))
    spark.createDataFrame([(json.dumps(r),) for r in reports], "value string").write.text(lab_lines_path(labs, 3))
    patients = spark.createDataFrame([("P1", "A", "W", "B1")], "patient_id string, name string, ward string, bed_number string")
    args = (labs, archive, folder + "/lab_table", folder + "/risk_table", patients, folder + "/reports")
    cfg = DEFAULTS.with_(max_days_per_run=1)
    assert [daily.catch_up(spark, *args, cfg) for _ in range(4)] == [[1], [2], [3], []]
    rejects = spark.read.parquet(folder + "/reports/rejects").collect()
    assert [(r.simulated_day, r.reject_reason) for r in rejects] == [(1, "missing_patient")]
    assert sorted(r[0] for r in spark.read.parquet(folder + "/risk_table").select("simulated_day").distinct().collect()) == [2, 3]


def test_the_job_removes_what_it_staged(spark, folder):
    from bedwatch.session import matching_names, shared_folder, stage, temporary_stages

    before = matching_names(spark, shared_folder(spark) + "/bedwatch", "kept-*")
    with temporary_stages(spark):
        assert stage(spark.range(3), "kept").count() == 3
        assert len(matching_names(spark, shared_folder(spark) + "/bedwatch", "kept-*")) == len(before) + 1
    assert matching_names(spark, shared_folder(spark) + "/bedwatch", "kept-*") == before


def test_folded_batches_are_removed(spark, folder):
    from bedwatch.session import numbered_folders

    path, schema = folder + "/log", "k string, v int"
    for batch in range(13):
        tb.write_changes(spark.createDataFrame([("a", batch), (f"k{batch}", batch)], schema), path, batch, ["k"], 3)
        assert len(numbered_folders(spark, path + "/changes", "batch_id")) <= 7
    assert len(numbered_folders(spark, path + "/snapshot", "upto")) <= 2
    got = {r.k: r.v for r in tb.latest_rows(spark, path, ["k"]).collect()}
    assert got == {"a": 12, **{f"k{b}": b for b in range(13)}}
    assert {r.k: r.v for r in tb.latest_rows(spark, path, ["k"], below=12).collect()}["a"] == 11


def test_one_scan_per_source(spark, folder):
    readings = with_date(spark.createDataFrame([reading("1", "P", 0), reading("1", "P", 0), reading(None, "P", 1), reading(None, "P", 1)], READING))
    readings.write.parquet(folder + "/r")
    df = dedupe_readings(spark.read.parquet(folder + "/r"))
    assert df.count() == 3
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_upsert_keeps_other_keys_and_days(spark, folder):
    path = folder + "/t"
    schema = "patient_id string, simulated_day int, v int"
    tb.upsert_days(spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("a", 2, 1)], schema), path, ["patient_id", "simulated_day"])
    tb.upsert_days(spark.createDataFrame([("a", 1, 2), ("c", 1, 2)], schema), path, ["patient_id", "simulated_day"])
    got = sorted((r.patient_id, r.simulated_day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 2), ("a", 2, 1), ("b", 1, 1), ("c", 1, 2)]
    tb.replace_days(spark.createDataFrame([("z", 2, 9)], schema), path)
    got = sorted((r.patient_id, r.simulated_day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 2), ("b", 1, 1), ("c", 1, 2), ("z", 2, 9)]


def test_change_log(spark, folder):
    path = folder + "/log"
    schema = "k string, v int, deleted boolean"
    tb.write_changes(spark.createDataFrame([("a", 1, False), ("b", 1, False)], schema), path, 0)
    tb.write_changes(spark.createDataFrame([("a", 2, False)], schema), path, 1)
    tb.write_changes(spark.createDataFrame([("a", 2, False)], schema), path, 1)  # replay
    read = lambda: sorted(map(tuple, tb.latest_rows(spark, path, ["k"]).collect()))
    assert read() == [("a", 2), ("b", 1)]
    assert tb.compact_changes(spark, path, ["k"]) == 1
    assert read() == [("a", 2), ("b", 1)]
    tb.write_changes(spark.createDataFrame([("b", 1, True), ("c", 5, False)], schema), path, 2)
    assert read() == [("a", 2), ("c", 5)]
    assert tb.compact_changes(spark, path, ["k"]) == 2
    assert read() == [("a", 2), ("c", 5)]


def test_pending_days(spark):
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "simulated_day int")
    got = daily.pending_days(days(5, 1, 2, 3, 4, 4, 6), days(2, 2), 3)
    assert [r[0] for r in got.collect()] == [1, 3, 4]


def test_hot_event_id_combines_before_the_shuffle(spark):
    df = spark.range(50_000).select(F.lit("same").alias("event_id"), F.lit("P").alias("patient_id"))
    plan = dedupe_readings(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2 and "partial" in plan.lower() or "keys=[event_id" in plan
    assert dedupe_readings(df).count() == 1


def test_a_thousand_days_in_one_run(spark):
    """The bounds of the days are one map, so the plan does not get deeper with their number."""
    n = 1000
    periods = [(d, T0 + timedelta(seconds=300 * d), T0 + timedelta(seconds=300 * (d + 1))) for d in range(1, n + 1)]
    periods = spark.createDataFrame(periods, "simulated_day int, period_start timestamp, period_end timestamp")
    rows = [reading(str(d), "P", 300 * d + 5) for d in range(1, n + 1)]
    labs = spark.createDataFrame([], "patient_id string, test_type string, result_value double, reference_min double, "
                                     "reference_max double, is_abnormal boolean, collected_at timestamp, simulated_day int")
    got = daily.score_days(with_date(spark.createDataFrame(rows, READING)), labs, periods).collect()
    assert len(got) == n
    for r in got:
        assert r["period_start"] == T0 + timedelta(seconds=300 * r["simulated_day"])
        assert r["report_date"] == (T0 + timedelta(seconds=300 * (r["simulated_day"] + 1))).date()


def test_a_day_run_again_without_rows_leaves_none(spark, folder):
    """Rejects and exports of a day's run before are gone; those of other days stay."""
    rejects = spark.createDataFrame([("a", 1), ("b", 2)], "report_id string, simulated_day int")
    tb.replace_days(rejects, f"{folder}/rejects", days=[1, 2])
    tb.replace_days(rejects.limit(0), f"{folder}/rejects", days=[2, 3])
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/rejects").collect()] == [("a", 1)]
    documents = spark.createDataFrame([("x", 1), ("y", 2)], "text string, simulated_day int")
    tb.export_documents_json(documents, f"{folder}/json", [1, 2])
    tb.export_documents_json(documents.filter("simulated_day = 1"), f"{folder}/json", [1, 2])
    assert [r["text"] for r in spark.read.json(f"{folder}/json").collect()] == ["x"]


def test_catch_up_stores_the_totals_of_its_runs(spark, folder):
    import os
    os.makedirs(f"{folder}/labs")
    make_day(spark, f"{folder}/labs", 1)
    make_day(spark, f"{folder}/labs", 2)
    patients = spark.createDataFrame([("P1", "A", "W", "1"), ("P2", "B", "W", "2")],
                                     "patient_id string, name string, ward string, bed_number string")
    args = (f"{folder}/labs", f"{folder}/archive", f"{folder}/lab_table", f"{folder}/risk", patients, f"{folder}/reports")
    assert daily.catch_up(spark, *args, DEFAULTS.with_(max_days_per_run=1)) == [1]
    assert daily.catch_up(spark, *args, DEFAULTS.with_(max_days_per_run=1)) == [2]
    totals = spark.read.parquet(f"{folder}/reports/metrics")
    assert totals.filter("metric_name = 'risk_reports_written'").count() == 2
    assert totals.filter("metric_name = 'last_simulated_day'").agg(F.max("metric_value")).first()[0] == 2.0


RISK_ROW = "patient_id string, simulated_day int, score double"


def test_an_upsert_stages_no_more_than_the_stored_rows_it_keeps(spark, folder, monkeypatch):
    staged, plain = [], tb.stage
    monkeypatch.setattr(tb, "stage", lambda df, label: staged.append(df.count()) or plain(df, label))

    def upsert(*rows):
        tb.upsert_days(spark.createDataFrame(rows, RISK_ROW), f"{folder}/risk", ["patient_id", "simulated_day"], staged=True)
        return sorted(map(tuple, spark.read.parquet(f"{folder}/risk").select("patient_id", "simulated_day", "score").collect()))

    upsert(("a", 1, 1.0), ("b", 1, 1.0), ("a", 3, 1.0))
    assert upsert(("a", 4, 1.0), ("b", 4, 1.0))[-2:] == [("b", 1, 1.0), ("b", 4, 1.0)]
    assert staged == []  # the days were new
    assert upsert(("a", 1, 2.0), ("c", 1, 2.0), ("a", 3, 2.0)) == [
        ("a", 1, 2.0), ("a", 3, 2.0), ("a", 4, 1.0), ("b", 1, 1.0), ("b", 4, 1.0), ("c", 1, 2.0)]
    assert staged == [1]  # patient b of day 1


def test_the_daily_job_computes_its_lab_reports_once(spark, folder):
    """The inputs of ``catch_up_*`` and ``run_days_risk``: all days in one pass, a day again in place of its file before."""
    from contract.queries import _deliver

    seen = spark.sparkContext.accumulator(0)

    def counted(day):
        seen.add(1)
        return day

    days = spark.range(1, 13, 1, 2).select(
        F.concat(F.lit("r"), "id").alias("report_id"),
        F.udf(counted, "int")(F.pmod(F.col("id"), F.lit(3)).cast("int") + 1).alias("simulated_day"))
    _deliver(days, folder)
    read = [spark.read.json(lab_lines_path(f"{folder}/labs", d)).count() for d in (1, 2, 3)]
    assert read == [4, 4, 4] and seen.value == 12
    _deliver(spark.createDataFrame([("x", 2)], "report_id string, simulated_day int"), folder)
    assert [spark.read.json(lab_lines_path(f"{folder}/labs", d)).count() for d in (1, 2, 3)] == [4, 1, 4]


def test_a_report_time_is_read_from_its_text_once(spark):
    from bedwatch.sources import labs as lb

    test = ("Glucose", 144.0, "u", 70.0, 100.0, "", True)
    rows = [("r1", "a", 1, "2026-09-30T12:00:00+00:00", [test, (None, 1.0, "u", 1.0, 2.0, "", None)]),
            ("r2", "a", 1, "never", [test, test]), ("r3", None, 1, None, []), ("r4", "b", 1, "2026-09-30T12:00:00+00:00", None),
            ("r5", "c", 1, "2026-09-30T12:00:00+00:00", [None, ("Sodium", float("nan"), "u", 1.0, 2.0, "", None)])]
    reports = spark.createDataFrame(rows, lb.REPORT_SCHEMA).withColumn("report_seq", F.lit(0).cast("long"))
    timed = lb.with_time(reports)
    assert lb.with_time(timed) is timed
    for made in (lb.flatten_reports, lb.rejected_reports, lb.lab_periods):
        assert made(timed).schema == made(reports).schema and sorted(map(str, made(timed).collect())) == sorted(
            map(str, made(reports).collect()))
    assert sorted((r.report_id, r.test_pos, r.reject_reason) for r in lb.rejected_reports(timed).filter("test_pos is not null").collect()) == [
        ("r1", 1, "missing_test_type"), ("r5", 0, "missing_test_type"), ("r5", 1, "missing_value")]
    assert sorted((r.report_id, r.reject_reason) for r in lb.rejected_reports(timed).filter("test_pos is null").collect()) == [
        ("r2", "bad_collected_at"), ("r3", "missing_patient")]

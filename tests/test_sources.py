import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS
from bedwatch.operators.panel import latest_labs, panel_scores
from bedwatch.sources import labs as lb, patients as pt, readings as rd


def payload(**over):
    base = {"event_id": "e1", "patient_id": "P001", "heart_rate": 80.0, "spo2": 97.0, "systolic_bp": 120.0,
            "diastolic_bp": 80.0, "temperature": 36.8, "timestamp": "2026-09-30T15:53:10.210737+00:00",
            "is_abnormal": False, "condition": "stable"}
    return json.dumps({**base, **over})


def test_parse_and_quarantine(spark):
    rows = [payload(), payload(event_id="e2", patient_id=None), payload(event_id="e3", timestamp="soon"),
            payload(event_id="e4")[:-8], payload(event_id="e5").replace("97.0", "NaN"), payload(event_id=None)]
    parsed = rd.parse_payload(spark.createDataFrame([(r,) for r in rows], "value string"))
    good = {r.event_id: r for r in rd.valid_readings(parsed).collect()}
    assert set(good) == {"e1", "e5", None}
    assert good["e1"].event_time == datetime(2026, 9, 30, 15, 53, 10, 210737)
    assert good["e1"].condition == "stable"
    assert good["e5"].spo2 is None and good["e5"].heart_rate == 80.0
    bad = sorted(r.reject_reason for r in rd.quarantined_readings(parsed).collect())
    assert bad == ["bad_timestamp", "malformed_json", "missing_patient"]


def test_payload_schema_has_no_derived_columns():
    assert "event_time" not in rd.PAYLOAD_SCHEMA.names and rd.ARCHIVE_SCHEMA.names[-2:] == ["event_time", "event_date"]


def test_messages_are_parsed_once(spark):
    df = rd.valid_readings(rd.parse_payload(spark.createDataFrame([(payload(),)], "value string")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_dedupe_keeps_readings_without_id(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)]
    got = rd.dedupe_readings(spark.createDataFrame(rows, "event_id string, v int")).collect()
    assert sorted((r.event_id or "", r.v) for r in got) == [("", 3), ("", 3), ("a", 1), ("b", 2)]


def test_archive_scan(spark, folder):
    assert rd.scan_archive(spark, folder + "/none").count() == 0
    times = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 12:00:00", "2024-01-03 00:00:00"]
    df = spark.createDataFrame([(str(i), "P", t) for i, t in enumerate(times)], "event_id string, patient_id string, t string")
    df = df.select("event_id", "patient_id", F.to_timestamp("t").alias("event_time")).withColumn(
        "event_date", F.to_date("event_time"))
    df.write.partitionBy("event_date").parquet(folder + "/a")
    scan = rd.scan_archive(spark, folder + "/a", datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert sorted(r.event_id for r in scan.collect()) == ["1", "2"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def write_lab(folder, day, reports):
    with open(lb.lab_file_path(folder, day), "w") as f:
        json.dump(reports, f)


def report(pid="P001", at="2026-09-30T15:53:10+00:00", tests=(), day=1):
    return {"report_id": f"L{day}-{pid}", "patient_id": pid, "simulated_day": day, "collected_at": at, "tests": list(tests)}


def lab_test(kind="Glucose", value=86.0, low=70, high=100.0, abnormal=False):
    return {"test_type": kind, "result_value": value, "unit": "u", "reference_min": low, "reference_max": high,
            "is_abnormal": abnormal}


def test_lab_files(spark, folder):
    write_lab(folder, 1, [report(tests=[lab_test(value=1.0), lab_test(value=144.0, abnormal=None)], day=9),
                          report("", tests=[lab_test()]), report("P002", at=None, tests=[lab_test()]),
                          report("P003", at="2026-09-30T17:53:10+02:00", tests=[lab_test(kind=None), lab_test(value=None)])])
    write_lab(folder, 12, [report("P009", at="2026-10-01T00:00:00Z", tests=[lab_test()])])
    reports = lb.read_lab_files(spark, folder)
    flat = lb.flatten_reports(reports)
    got = {(r.patient_id, r.simulated_day, r.result_value, r.is_abnormal) for r in flat.collect()}
    assert got == {("P001", 1, 1.0, False), ("P001", 1, 144.0, False), ("P009", 12, 86.0, False)}  # day from the name
    latest = latest_labs(flat).filter("patient_id = 'P001'").collect()
    assert [r.result_value for r in latest] == [144.0]  # the later duplicate of a file wins
    rejects = sorted(r.reject_reason for r in lb.rejected_reports(reports).collect())
    assert rejects == ["missing_collected_at", "missing_patient", "missing_test_type", "missing_value"]
    periods = {r.simulated_day: r for r in lb.lab_periods(reports).collect()}
    assert periods[1].period_end == datetime(2026, 9, 30, 15, 53, 10)  # counts the report without usable tests
    assert (periods[1].period_end - periods[1].period_start).total_seconds() == DEFAULTS.period_seconds
    assert periods[1].reports == 2
    assert sorted(r[0] for r in lb.available_days(spark, folder).collect()) == [1, 12]
    assert lb.read_lab_files(spark, folder, [12]).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lb.read_lab_files(spark, folder, [3]).count()


def test_all_rejected_file_has_no_period(spark, folder):
    write_lab(folder, 1, [report(None)])
    assert lb.lab_periods(lb.read_lab_files(spark, folder)).count() == 0


def test_missing_bounds_and_untrusted_flags(spark):
    rows = [("P", 1, "A", 5.0, None, 4.0, True), ("P", 1, "B", 5.0, 1.0, 4.0, False), ("P", 1, "C", 2.0, 1.0, 4.0, True)]
    labs = spark.createDataFrame(rows, "patient_id string, simulated_day int, test_type string, result_value double, "
                                       "reference_min double, reference_max double, is_abnormal boolean")
    assert lb.without_bounds(labs).count() == 1
    p = panel_scores(labs).first()
    assert (p.labs_out_of_range, p.abnormal_labs_count) == (1, 2)  # severity recomputed, flag trusted
    assert p.lab_factors == ["B high (5.00, ref: 1.0-4.0)"]
    audit = {r.test_type: (r.derived_abnormal, r.flag_matches, r.reference_range) for r in lb.audit_flags(labs).collect()}
    assert audit["B"] == (True, False, "1.0-4.0") and audit["C"] == (False, False, "1.0-4.0")


def test_insert_absent(spark):
    old = spark.createDataFrame([("P1", "a")], "patient_id string, name string")
    seed = spark.createDataFrame([("P1", "x"), ("P2", "b"), ("P2", "b")], "patient_id string, name string")
    assert sorted(map(tuple, pt.insert_absent(old, seed).collect())) == [("P1", "a"), ("P2", "b")]

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS, REPORT_COLUMNS
from bedwatch.operators import changes, health, risk as rk, staleness as st, windows as wn
from bedwatch.plans import health as hp, reports as rp, ward

T0 = datetime(2024, 1, 1)
RISK = "patient_id string, simulated_day int, combined_risk_score double, risk_level string"


def risk_rows(spark, rows):
    df = spark.createDataFrame(rows, RISK)
    return df.withColumns({
        "vitals_risk_score": F.lit(1.0), "lab_risk_score": F.lit(2.0), "abnormal_vitals_count": F.lit(0),
        "abnormal_labs_count": F.lit(1), "readings_analyzed": F.lit(5), "heart_rate_trend": F.lit(0.1),
        "spo2_trend": F.lit(0.1), "risk_factors": F.lit("None"),
        "report_date": F.date_add(F.lit("2024-01-01").cast("date"), F.expr("cast(simulated_day div 2 as int)"))})


def people(spark, *ids):
    return spark.createDataFrame([(i, f"name {i}", "ICU", "B1") for i in ids],
                                 "patient_id string, name string, ward string, bed_number string")


def test_previous_day_is_exact_in_reports_and_available_in_history(spark):
    risk = risk_rows(spark, [("P", 1, 20.0, "LOW"), ("P", 3, 30.004, "MODERATE"), ("P", 4, 26.001, "MODERATE"),
                             ("Q", 2, 10.0, "LOW"), ("Q", 4, 80.0, "CRITICAL"), ("stranger", 4, 99.0, "CRITICAL")])
    report = {(r.patient_id, r.simulated_day): r.risk_change for r in rp.daily_report(risk, people(spark, "P", "Q")).collect()}
    assert report == {("P", 1): None, ("P", 3): None, ("P", 4): -4.0, ("Q", 2): None, ("Q", 4): None}
    raw = {r.patient_id: r.risk_change for r in rk.latest_risk(risk).collect()}
    assert raw["Q"] is None and raw["P"] == 26.001 - 30.004  # not rounded in the ward view
    history = rp.ward_history(risk, people(spark, "P", "Q"), 10)
    found = {r.patient_id: (r.latest_change, r.direction) for r in rp.patient_histories(history).collect()}
    assert found == {"P": (-4.0, "stable"), "Q": (70.0, "worsening")}
    recent = rp.patient_histories(rp.ward_history(risk, people(spark, "P", "Q"), 2)).collect()
    assert {r.patient_id: (len(r.scores), r.direction) for r in recent} == {"P": (2, "stable"), "Q": (1, "new")}
    one = rp.daily_report(risk, people(spark, "P", "Q"), [4])
    assert sorted((r.patient_id, r.risk_change) for r in one.collect() if r.risk_change) == [("P", -4.0)]
    assert one.columns[:-1] == list(REPORT_COLUMNS[:1]) + [c for c in REPORT_COLUMNS[1:]]
    assert rp.latest_report(risk, people(spark, "P")).count() == 1
    assert rp.report_on_date(risk, people(spark, "P", "Q"), "2024-01-02").first().simulated_day == 3
    assert rp.report_on_date(risk, people(spark, "P"), "2030-01-01").count() == 0
    ordered = [(r.simulated_day, r.combined_risk) for r in rp.in_report_order(rp.daily_report(risk, people(spark, "P", "Q"))).collect()]
    assert ordered == sorted(ordered, key=lambda x: (x[0], -x[1]))


def test_documents_hold_every_patient_once(spark):
    risk = risk_rows(spark, [(f"P{i}", 1, float(i % 90), "LOW") for i in range(300)])
    report = rp.daily_report(risk, people(spark, *[f"P{i}" for i in range(300)]))
    lines = rp.report_documents(report).orderBy("simulated_day", "position").collect()
    assert [r.position for r in lines] == list(range(301))
    assert lines[0].summary.total_patients == 300 and lines[0].patient is None
    order = [(-r.patient.combined_risk, r.patient.patient_id) for r in lines[1:]]
    assert order == sorted(order)


def windows_of(spark, rows):
    """(patient, minute of start, heart rate, spo2)"""
    df = spark.createDataFrame(
        [(p, T0 + timedelta(minutes=m), T0 + timedelta(minutes=m, seconds=30), hr, s, 120.0, 80.0, 36.8) for p, m, hr, s in rows],
        "patient_id string, window_start timestamp, window_end timestamp, avg_heart_rate double, avg_spo2 double, "
        "avg_systolic_bp double, avg_diastolic_bp double, avg_temperature double")
    return df.withColumns({"min_spo2": F.col("avg_spo2"), "max_heart_rate": F.col("avg_heart_rate"), "reading_count": F.lit(10)})


def test_live_trend_uses_the_last_ten_windows(spark):
    rows = [("P", m, 200.0 - m, 97.0) for m in range(5)] + [("P", 100 + m, 80.0 + 4 * m, 97.0 - m) for m in range(10)]
    live = wn.live_features(windows_of(spark, rows + [("Q", 0, 70.0, 98.0)])).collect()
    got = {r.patient_id: r for r in live}
    assert abs(got["P"].hr_trend - 4.0) < 1e-6 and abs(got["P"].spo2_trend + 1.0) < 1e-6
    assert got["P"].heart_rate == 116.0 and got["Q"].hr_trend is None


def test_ward_risk_order_and_missing_data(spark):
    windows = windows_of(spark, [("A", 0, 135.0, 98.0), ("B", 0, 70.0, 98.0), ("C", 0, 112.0, 98.0)])
    risk = risk_rows(spark, [("B", 1, 80.0, "CRITICAL"), ("stranger", 1, 90.0, "CRITICAL")])
    view = ward.ward_risk(windows, risk, people(spark, "A", "B", "C", "D"))
    rows = view.collect()
    assert [(r.patient_id, r.outlook) for r in rows] == [("B", "CRITICAL"), ("A", "HIGH"), ("C", "LOW"), ("D", "LOW")]
    assert rows[3].early_warning_score == 0 and rows[3].heart_rate is None
    assert rows[0].concerns == ["1 abnormal lab result(s) on day 1"]
    assert [r.patient_id for r in ward.needs_attention(view).collect()] == ["B", "A"]
    status = {r.patient_id: r.last_reading for r in ward.ward_status(people(spark, "A", "D"), windows).collect()}
    assert status["D"] is None and status["A"] == T0 + timedelta(seconds=30)


def test_overview_statuses_and_triage(spark):
    windows = windows_of(spark, [("A", 0, 80.0, 98.0), ("B", 0, 80.0, 98.0), ("C", 0, 80.0, 98.0)])
    alerts = spark.createDataFrame([("A", False), ("A", False), ("B", True)], "patient_id string, acknowledged boolean")
    day = risk_rows(spark, [("B", 1, 80.0, "CRITICAL"), ("C", 1, 60.0, "HIGH")])
    cards = ward.ward_overview(ward.ward_status(people(spark, "A", "B", "C", "D"), windows), alerts, day,
                               F.lit(T0 + timedelta(seconds=90))).collect()
    assert [(r.patient_id, r.triage_score, r.overall_status) for r in cards] == [
        ("A", 20, "critical"), ("B", 5, "critical"), ("C", 2, "watch"), ("D", 0, "watch")]
    assert cards[0].age_seconds == 60 and cards[3].age_seconds is None


def test_staleness_opens_once_and_resolves(spark):
    windows = windows_of(spark, [("A", 0, 80.0, 98.0), ("B", 10, 80.0, 98.0)])
    everyone = people(spark, "A", "B", "never")
    none = spark.createDataFrame([], "alert_id long, patient_id string, alert_type string, severity string, "
                                     "message string, triggered_at timestamp, acknowledged boolean")
    at = lambda s: F.lit(T0 + timedelta(seconds=s))
    ids = lambda s: sorted(r.patient_id for r in st.stale_patients(everyone, windows, at(s)).collect())
    assert ids(90) == ["never"]  # exactly the limit is still fresh
    assert ids(91) == ["A", "never"]
    first = st.after_check(none, st.stale_patients(everyone, windows, at(91), DEFAULTS), at(91))
    assert first.count() == 2
    again = st.after_check(first, st.stale_patients(everyone, windows, at(95), DEFAULTS), at(95))
    assert again.count() == 2  # the condition lasts, no second alert
    flowing = windows.unionByName(windows_of(spark, [("A", 20, 80.0, 98.0)]))
    later = st.after_check(again, st.stale_patients(everyone, flowing, at(1200), DEFAULTS), at(1200))
    got = sorted((r.patient_id, r.acknowledged) for r in later.collect())
    assert got == [("A", True), ("B", False), ("never", False)]
    assert st.stalest_age(windows, at(100)).first()[0] == 70
    assert st.stalest_age(windows.limit(0), at(100)).first()[0] == -1
    summary = {r.check: r.status for r in hp.health_summary(
        everyone, windows, metrics(spark, 0, 0), at(95)).collect()}
    assert summary == {"stale_patients": "degraded", "error_rate": "healthy"}


def metrics(spark, errors, total):
    return spark.createDataFrame(
        [("vitals_producer", "send_errors", float(errors), T0), ("vitals_producer", "records_sent", float(total), T0)],
        "component string, metric_name string, metric_value double, recorded_at timestamp")


def test_error_rate_alert(spark):
    none = spark.createDataFrame([], "alert_id long, patient_id string, alert_type string, severity string, "
                                     "message string, triggered_at timestamp, acknowledged boolean")
    fire = lambda e, n, alerts=none: health.error_rate_alert(health.error_rate(metrics(spark, e, n)), alerts, F.lit(T0))
    assert fire(5, 100).count() == 0 and fire(0, 0).count() == 0
    raised = fire(6, 100)
    assert raised.first().message == "Vitals ingestion error rate is 6.0% (6/100), exceeding threshold of 5%."
    open_now = none.unionByName(raised, allowMissingColumns=True)
    assert fire(6, 100, open_now).count() == 0


def test_throughput_survives_a_restart(spark):
    rows = [("c", "m", v, T0 + timedelta(minutes=m)) for m, v in ((0, 10.0), (1, 16.0), (2, 22.0), (3, 4.0))]
    df = spark.createDataFrame(rows, "component string, metric_name string, metric_value double, recorded_at timestamp")
    got = [(r.increase, r.rate_per_second) for r in health.throughput(df, "1 minute").orderBy("window_start").collect()]
    assert got == [(None, None), (6.0, 0.1), (6.0, 0.1), (4.0, 4.0 / 60)]


def test_freshness(spark):
    beats = spark.createDataFrame([("vitals_producer", T0), ("speed_layer", T0 - timedelta(seconds=90)),
                                   ("batch_layer", T0 - timedelta(seconds=901))], "component string, recorded_at timestamp")
    got = {r.component: (r.age_seconds, r.stale) for r in health.component_freshness(beats, F.lit(T0)).collect()}
    assert got == {"vitals_producer": (0, False), "speed_layer": (90, False), "batch_layer": (901, True),
                   "lab_generator": (None, True)}


def test_distribution_of_an_empty_table(spark):
    got = health.level_distribution(risk_rows(spark, []).limit(0)).collect()
    assert [(r.risk_level, r.patients, r.avg_combined_risk) for r in got] == [
        (l, 0, 0.0) for l in ("LOW", "MODERATE", "HIGH", "CRITICAL")]


@pytest.mark.parametrize("crowded,parts", [(False, 1), (False, 7), (True, 7), (True, 40)])
def test_state_changes_match_a_plain_walk(spark, crowded, parts):
    """Spread out, and with most rows in a moment, over few and many partitions."""
    rnd = random.Random(1)
    rows = []
    for pid, n in (("hot", 2000), ("b", 50), ("c", 1)):
        ms = 0
        for i in range(n):
            ms += rnd.choice([0, 1, 2, 300] if crowded else [0, 1000, 600_000, 3_600_000, 20_000_000])
            rows.append((pid, f"{i:05d}", T0 + timedelta(milliseconds=ms), rnd.choice(["stable", "stable", "worse", None])))
    want, last = [], {}
    for pid, eid, ts, cond in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        if pid in last and last[pid] != cond:
            want.append((pid, eid, last[pid], cond))
        last[pid] = cond
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "patient_id string, event_id string, event_time timestamp, condition string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = changes.state_changes(df).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted([(r.patient_id, r.event_id, r.previous, r.condition) for r in found], key=str) == sorted(want, key=str)


def test_a_resolved_alert_stays_resolved_when_others_are_acknowledged(spark):
    from bedwatch.operators import alerts as al

    stale = spark.createDataFrame([(1, "A", "DATA_STALENESS", "WARNING", "m", T0, True), (2, "B", "DATA_STALENESS", "WARNING", "m", T0, False)],
                                  "alert_id long, patient_id string, alert_type string, severity string, message string, "
                                  "triggered_at timestamp, acknowledged boolean")
    requests = spark.createDataFrame([(2, T0), (9, T0)], "alert_id long, acked_at timestamp")
    acks = al.acknowledge(stale, requests)
    assert [(r.alert_id, r.vital_name) for r in acks.collect()] == [(2, None)]
    assert {r.acknowledged for r in al.with_acknowledged(stale, acks).collect()} == {True}
    vital = spark.createDataFrame([(3, 77, "spo2")], "alert_id long, patient_id long, vital_name string")
    one = al.unite_alerts(vital, stale)
    assert sorted((r.patient_id, r.acknowledged) for r in one.collect()) == [("77", False), ("A", True), ("B", False)]


def test_alarm_rate_ignores_a_trickle(spark):
    rows = [("send_errors", 10.0, T0), ("records_sent", 100.0, T0),
            ("send_errors", 30.0, T0 + timedelta(seconds=300)), ("records_sent", 400.0, T0 + timedelta(seconds=300))]
    df = spark.createDataFrame(rows, "metric_name string, metric_value double, recorded_at timestamp")
    got = health.windowed_error_rate(df, 300).orderBy("window_start").collect()
    assert [(r.error_rate, r.exceeded) for r in got] == [(0.1, False), (0.075, True)]

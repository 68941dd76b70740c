"""Alert episodes against a plain sequential simulation."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS
from bedwatch.operators import alerts as al, episodes as ep

T0 = datetime(2024, 1, 1)
BREACH = "patient_id string, event_id string, event_time timestamp, vital_name string, vital_value double, " \
         "threshold_value double, above boolean, severity string"
ACK = "alert_id long, patient_id string, vital_name string, triggered_at timestamp, acked_at timestamp"


def breach(pid, vital, ms, critical=False, eid=None, value=None):
    return (pid, eid or f"{pid}{vital}{ms:09d}", T0 + timedelta(milliseconds=ms), vital,
            value if value is not None else 100.0 + ms % 7, 90.0 + ms % 5, True, "CRITICAL" if critical else "WARNING")


def simulate(breaches, acks=(), cfg=DEFAULTS):
    """One reading at a time; an acknowledgement closes the episode it names."""
    steps = [((b[0], b[3]), b[2], 0, b[1], b) for b in breaches]
    steps += [((a[1], a[2]), a[4], 1, "", a) for a in acks]
    current, done = {}, []
    for key, ts, kind, _, row in sorted(steps, key=lambda s: (s[0], s[1], s[2], s[3])):
        e = current.get(key)
        if kind == 1:
            if e and e["start"] == row[3]:
                e["acked"] = True
            continue
        if e and not e["acked"] and (ts - e["last"]).total_seconds() <= cfg.cooldown_seconds:
            e["n"] += 1
            e["last"], e["value"], e["eid"] = ts, row[4], row[1]
            if row[7] == "CRITICAL" or e["n"] >= cfg.escalate_after:
                e["sev"] = "CRITICAL"
        else:
            e = current[key] = {"key": key, "start": ts, "last": ts, "n": 1, "sev": "WARNING", "value": row[4],
                                "thr": row[5], "eid": row[1], "acked": False}
            done.append(e)
    return sorted((e["key"][0], e["key"][1], e["start"], e["last"], e["n"], e["sev"], e["value"], e["thr"], e["eid"])
                  for e in done)


def rows_of(df):
    return sorted((r.patient_id, r.vital_name, r.triggered_at, r.last_seen_at, r.occurrences, r.severity, r.vital_value,
                   r.threshold_value, r.event_id) for r in df.collect())


def check(spark, breaches, acks=None):
    df = spark.createDataFrame(breaches, BREACH)
    ack_df = None if acks is None else spark.createDataFrame(acks, ACK)
    got = rows_of(ep.alert_episodes(df, ack_df))
    assert got == simulate(breaches, acks or ())
    return got


@pytest.mark.parametrize("gap,episodes", [(299_999, 1), (300_000, 1), (300_001, 2)])
def test_cooldown_is_inclusive(spark, gap, episodes):
    for start in (0, 150_000, 299_999):
        assert len(check(spark, [breach("P", "spo2", start), breach("P", "spo2", start + gap)])) == episodes


@pytest.mark.parametrize("levels,severity", [
    ([True], "WARNING"), ([True, False], "WARNING"), ([False, True], "CRITICAL"), ([True, True], "CRITICAL"),
    ([False, False], "WARNING"), ([False, False, False], "CRITICAL")])
def test_escalation(spark, levels, severity):
    got = check(spark, [breach("P", "spo2", i * 1000, c) for i, c in enumerate(levels)])
    assert [g[5] for g in got] == [severity]


def test_high_and_low_breaches_share_an_alert(spark):
    low = ("P", "b", T0 + timedelta(seconds=5), "heart_rate", 45.0, 50.0, False, "WARNING")
    got = ep.alert_episodes(spark.createDataFrame([breach("P", "heart_rate", 0), low], BREACH)).collect()
    assert len(got) == 1 and got[0].threshold_value == 90.0  # the first limit stays
    assert got[0].message == "heart_rate is below threshold: value=45.0, threshold=50.0"


@pytest.mark.parametrize("seed", range(6))
def test_random_histories(spark, seed):
    rnd = random.Random(seed)
    breaches = []
    for pid, vital, n in (("hot", "spo2", 700), ("hot", "temperature", 60), ("b", "spo2", 60), ("c", "heart_rate", 40)):
        ms = rnd.randrange(1_000_000)
        for i in range(n):
            ms += rnd.choice([0, 1, 1000, 60_000, 299_999, 300_000, 300_001, 400_000])
            breaches.append(breach(pid, vital, ms, rnd.random() < 0.1, eid=f"{i:05d}"))
    rnd.shuffle(breaches)
    found = check(spark, breaches)
    # Acknowledge a third of the alerts at times inside, at the edges of, and after them; some twice.
    acks = []
    for pid, vital, start, last, *_ in found:
        if rnd.random() < 0.35:
            at = rnd.choice([start, last, last + timedelta(milliseconds=1), start + (last - start) / 2,
                             last + timedelta(minutes=2), last + timedelta(hours=3)])
            at = at.replace(microsecond=at.microsecond // 1000 * 1000)
            acks.append((1, pid, vital, start, at))
            if rnd.random() < 0.3:
                acks.append((1, pid, vital, start, at + timedelta(seconds=30)))
    check(spark, breaches, acks)
    # Second round: acknowledge alerts that only exist because of the first acknowledgements.
    for pid, vital, start, last, *_ in simulate(breaches, acks):
        if rnd.random() < 0.2:
            acks.append((1, pid, vital, start, last))
    acks.append((1, "hot", "spo2", T0 - timedelta(days=9), T0 + timedelta(hours=1)))  # names no alert
    check(spark, breaches, acks)


def test_ack_between_breaches_of_one_bucket(spark):
    b = [breach("P", "spo2", ms) for ms in (0, 10, 20, 30)]
    acks = [(1, "P", "spo2", T0, T0 + timedelta(milliseconds=10))]
    got = check(spark, b, acks)
    assert [g[4] for g in got] == [2, 2]  # a breach at the same instant still belongs to the closed alert


def test_many_acks_use_the_join(spark):
    breaches = [breach("P", "spo2", i * 100_000) for i in range(50)]
    acks = [(1, "P", "spo2", b[2], b[2]) for b in breaches]
    got = rows_of(ep.alert_episodes(spark.createDataFrame(breaches, BREACH), spark.createDataFrame(acks, ACK), DEFAULTS))
    assert got == simulate(breaches, acks) and len(got) == 50


def test_collapse_keeps_last_critical_or_first(spark):
    rows = [breach("P", "spo2", 3000), breach("P", "spo2", 1000, True, value=1.0), breach("P", "spo2", 2000, True, value=2.0),
            breach("Q", "spo2", 9000, value=9.0), breach("Q", "spo2", 8000, value=8.0)]
    got = {r.patient_id: r for r in ep.collapse_breaches(spark.createDataFrame(rows, BREACH)).collect()}
    assert (got["P"].occurrences, got["P"].any_critical, got["P"].vital_value) == (3, True, 2.0)
    assert (got["Q"].occurrences, got["Q"].any_critical, got["Q"].vital_value) == (2, False, 8.0)


def test_no_task_sees_all_breaches_of_a_hot_key(spark):
    """Rows reaching the ordering step are bounded by buckets, not by breaches."""
    hot = spark.range(200_000).select(
        F.lit("hot").alias("patient_id"), F.col("id").cast("string").alias("event_id"),
        F.timestamp_millis(F.col("id") * 10).alias("event_time"), F.lit("spo2").alias("vital_name"),
        F.lit(80.0).alias("vital_value"), F.lit(90.0).alias("threshold_value"), F.lit(False).alias("above"),
        F.lit("CRITICAL").alias("severity"))
    assert ep.breach_summaries(hot).count() == 7  # 2000 s in buckets of 300 s
    got = ep.alert_episodes(hot).collect()
    assert len(got) == 1 and got[0].occurrences == 200_000


def test_acknowledge_and_views(spark):
    breaches = [breach("P", "spo2", 0), breach("P", "spo2", 10, True), breach("Q", "spo2", 0), breach("R", "spo2", 5_000)]
    alerts = ep.alert_episodes(spark.createDataFrame(breaches, BREACH))
    ids = {r.patient_id: r.alert_id for r in alerts.collect()}
    requests = spark.createDataFrame([(ids["Q"], T0), (42, T0)], "alert_id long, acked_at timestamp")
    acks = al.acknowledge(alerts, requests)
    assert [r.alert_id for r in acks.collect()] == [ids["Q"]]
    state = al.with_acknowledged(alerts, acks.unionByName(acks))
    assert [r.patient_id for r in al.active_alerts(state).collect()] == ["P", "R"]  # critical first
    assert [r.patient_id for r in al.active_alerts(state, 1).collect()] == ["P"]
    assert [r.patient_id for r in al.critical_alerts(state).collect()] == ["P"]
    assert {r.severity: r.open_alerts for r in al.severity_counts(state).collect()} == {"WARNING": 1, "CRITICAL": 1}
    none = al.with_acknowledged(alerts.limit(0), None)
    assert {r.severity: r.open_alerts for r in al.severity_counts(none).collect()} == {"WARNING": 0, "CRITICAL": 0}

"""Alarms with hold times and counters with restarts, against walks over single samples."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS
from bedwatch.operators import counters, health, rules
from bedwatch.operators.neighbours import with_neighbours

T0 = datetime(2024, 1, 1)
SAMPLES = "rule string, subject string, at timestamp, active boolean"
HOLDS = "rule string, subject string, hold_seconds int, severity string"


def walk(samples, holds, now, gap):
    """One sample after the other, as an evaluator would see them."""
    out = []
    by_rule = defaultdict(dict)
    for rule, subject, at, active in samples:
        if at <= now:
            by_rule[rule, subject][at] = bool(active) or by_rule[rule, subject].get(at, False)
    for key, seen in by_rule.items():
        if key not in holds:
            continue
        hold, severity = holds[key]
        island = None

        def close(end):
            out.append((*key, severity, island[0], island[1], island[2], end, island[3],
                        ("firing" if island[1] else "pending") if end is None else ("resolved" if island[1] else "dropped")))

        for at in sorted(seen):
            if island and at - island[2] > gap:
                close(island[2] + gap)
                island = None
            if seen[at]:
                if island is None:
                    island = [at, None, at, 0]
                island[2], island[3] = at, island[3] + 1
                if island[1] is None and at >= island[0] + timedelta(seconds=hold):
                    island[1] = at
            elif island:
                close(at)
                island = None
        if island:
            close(island[2] + gap if island[2] + gap < now else None)
    return sorted(out, key=lambda r: r[:4])


def states(spark, samples, holds, now, gap_seconds):
    df = rules.rule_states(
        spark.createDataFrame(samples, SAMPLES).repartition(5),
        spark.createDataFrame([(*k, *v) for k, v in holds.items()], HOLDS), F.lit(now), gap_seconds)
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:4])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_states_equal_a_walk_over_the_samples(spark, seed):
    rnd = random.Random(seed)
    holds = {("r", "hot"): (120, "critical"), ("r", "b"): (0, "warning"), ("q", "b"): (45, "warning")}
    samples, at = [], T0
    for _ in range(1500):
        at += timedelta(seconds=rnd.choice([0, 1, 15, 30, 30, 60, 400]))
        key = ("r", "hot") if rnd.random() < 0.7 else rnd.choice([*holds, ("unknown", "x")])
        samples.append((*key, at, rnd.choice([True, True, True, True, False, None])))
    now = at - timedelta(seconds=200)
    got = states(spark, samples, holds, now, 300)
    assert got == walk(samples, holds, now, timedelta(seconds=300))
    assert {r[-1] for r in got} >= {"resolved", "dropped"}


def test_long_islands_over_many_partitions(spark):
    """One condition that lasts over all range partitions is one island, and one that blinks is many."""
    steady = [("r", "a", T0 + timedelta(seconds=30 * k), True) for k in range(3000)]
    blinking = [("r", "b", T0 + timedelta(seconds=30 * k), k % 2 == 0) for k in range(3000)]
    holds = {("r", "a"): (60, "critical"), ("r", "b"): (60, "critical")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = states(spark, steady + blinking, holds, T0 + timedelta(days=3), 60)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == walk(steady + blinking, holds, T0 + timedelta(days=3), timedelta(seconds=60))
    assert sum(r[1] == "a" for r in got) == 1 and sum(r[1] == "b" for r in got) == 1500


def test_a_condition_shorter_than_its_hold_never_fires(spark):
    on = [("r", "a", T0 + timedelta(seconds=10 * k), 3 <= k < 6) for k in range(10)]
    (state,) = states(spark, on, {("r", "a"): (30, "critical")}, T0 + timedelta(hours=1), 60)
    assert state[4] is None and state[-1] == "dropped"
    steps = rules.rule_transitions(rules.rule_states(
        spark.createDataFrame(on, SAMPLES), spark.createDataFrame([("r", "a", 20, "critical")], HOLDS),
        F.lit(T0 + timedelta(hours=1)), 60)).orderBy("at", "step").collect()
    assert [(r["state"], (r["at"] - T0).seconds) for r in steps] == [("pending", 30), ("firing", 50), ("resolved", 60)]


def test_no_samples(spark):
    assert states(spark, [], {("r", "a"): (0, "critical")}, T0, 60) == []


def test_default_holds(spark):
    holds = {(r["rule"], r["subject"]): (r["hold_seconds"], r["severity"]) for r in rules.holds_of(spark).collect()}
    assert holds["stale", "batch_layer"] == (60, "warning") and holds["open_critical_alerts", "ward"] == (0, "critical")


def test_interval_and_freshness_samples(spark):
    grid = rules.Grid(T0, T0 + timedelta(minutes=20), 30)
    rnd = random.Random(4)
    beats = [(rnd.choice(["vitals_producer", "speed_layer", "other"]), T0 + timedelta(seconds=rnd.uniform(-200, 1300))) for _ in range(25)]
    beats += [(None, T0), ("speed_layer", None)]
    df = rules.freshness_samples(spark.createDataFrame(beats, "component string, recorded_at timestamp"), grid)
    got = {(r["subject"], r["at"]): r["active"] for r in df.collect()}
    assert len(got) == 4 * 41
    for (subject, at), active in got.items():
        limit = {c: n for c, n, _ in DEFAULTS.freshness_limits}[subject]
        seen = [t for c, t in beats if c == subject and t is not None and t <= at]
        assert active == (not seen or (at - max(seen)).total_seconds() > limit), (subject, at)
    alerts = [("CRITICAL", T0 + timedelta(seconds=95), T0 + timedelta(seconds=200)), ("CRITICAL", T0 + timedelta(seconds=150), None),
              ("WARNING", T0, None), ("CRITICAL", T0 - timedelta(hours=1), T0 + timedelta(seconds=30))]
    df = rules.open_alert_samples(spark.createDataFrame(alerts, "severity string, triggered_at timestamp, acked_at timestamp"), grid)
    for r in df.collect():
        assert r["active"] == any(s == "CRITICAL" and a <= r["at"] and (b is None or r["at"] < b) for s, a, b in alerts)


def test_patient_age_samples(spark):
    grid = rules.Grid(T0, T0 + timedelta(minutes=15), 30)
    rnd = random.Random(6)
    ends = [(p, T0 + timedelta(seconds=30 * rnd.randrange(25))) for p in "abc" for _ in range(9)]
    got = rules.patient_age_samples(spark.createDataFrame(ends, "patient_id string, window_end timestamp"), grid).collect()
    assert len(got) == 31
    for r in got:
        last = {p: max((t for q, t in ends if q == p and t <= r["at"]), default=None) for p in "abc"}
        assert r["active"] == any(t and (r["at"] - t).total_seconds() > 90 for t in last.values())


def test_ticks_are_counted_in_chunks(spark):
    grid = rules.Grid(T0, T0 + timedelta(seconds=999), 1)
    rnd = random.Random(8)
    spans = [("s", a := rnd.randrange(1000), rnd.choice([None, a + rnd.randrange(300)])) for _ in range(200)]
    df = spark.createDataFrame(spans, "subject string, begin long, end long")
    for chunk in (7, 4096):
        got = {(r["subject"], (r["at"] - T0).seconds): r["n"] for r in rules.covered(df, ["s", "t"], grid, chunk).collect()}
        assert all(got["s", k] == sum(a <= k and (b is None or k < b) for _, a, b in spans) for k in range(1000))
        assert all(got["t", k] == 0 for k in range(1000))


# ---- counters

METRICS = "component string, metric_name string, metric_value double, recorded_at timestamp"


def test_a_restart_inside_a_window_counts(spark):
    """100 before the window; 120, a restart, 5 and 130 inside: the counter grew by 20 + 5 + 125."""
    at = lambda m: T0 + timedelta(minutes=m)
    rows = [("c", "n", 100.0, at(50)), ("c", "n", 120.0, at(65)), ("c", "n", 5.0, at(80)), ("c", "n", 130.0, at(100))]
    df = spark.createDataFrame(rows, METRICS)
    got = {r["window_start"]: r for r in health.throughput(df, "1 hour").collect()}
    assert got[T0]["increase"] is None
    assert got[at(60)]["increase"] == 150.0 and got[at(60)]["rate_per_second"] == 150.0 / 3000
    got = {r["window_start"]: r for r in counters.counter_rates(df, "1 hour").collect()}
    r = got[at(60)]
    assert (r["samples"], r["restarts"], r["increase"]) == (3, 1, 150.0)
    # inside: 5 + 125 over 35 min; 5 min lie before and 20 min after, against 19.25 min usual at most: half of 17.5
    assert r["rate_per_second"] == pytest.approx(130 * (35 + 5 + 8.75) / 35 / 3600)
    assert got[T0]["rate_per_second"] is None and got[T0]["increase"] == 0.0


def test_steps_equal_a_walk(spark):
    rnd = random.Random(3)
    rows, value = [], defaultdict(float)
    for k in range(4000):
        key = "hot" if rnd.random() < 0.7 else rnd.choice("ab")
        value[key] = float(rnd.randrange(5)) if rnd.random() < 0.01 else value[key] + rnd.randrange(4)
        rows.append(("c", key, value[key], T0 + timedelta(seconds=k)))
    rows += [("c", "a", None, T0), ("c", "a", float("nan"), T0), ("c", "a", 1.0, None), (None, "z", 2.0, T0)]
    got = counters.counter_rates(spark.createDataFrame(rows, METRICS).repartition(6), "10 minutes").collect()
    want, last = defaultdict(float), {}
    for _, key, v, at in rows[:4000]:
        if key in last:
            want[key, at.replace(minute=at.minute // 10 * 10, second=0)] += v - last[key] if v >= last[key] else v
        last[key] = v
    found = {(r["metric_name"], r["window_start"]): r["increase"] for r in got if r["metric_name"] != "z"}
    assert found == {k: want[k] for k in found} and set(want) <= set(found)


def test_neighbours_over_borders(spark):
    rows = [("k" if k % 3 else "m", k, k * k) for k in range(500)]
    df = with_neighbours(spark.createDataFrame(rows, "key string, n int, v int").repartition(7), ["key"], ["n"], ["v"])
    for r in df.collect():
        own = [x for x in rows if x[0] == r["key"]]
        i = own.index((r["key"], r["n"], r["v"]))
        assert (r["before"] and r["before"]["v"]) == (own[i - 1][2] if i else None)
        assert (r["after"] and r["after"]["v"]) == (own[i + 1][2] if i + 1 < len(own) else None)

"""The timer per patient against a check of everybody at every instant."""

import random
import subprocess
import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS
from bedwatch.session import STATE_STORE
from bedwatch.streaming import staleness as st

T0 = datetime(2024, 1, 1)
START = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1000


def periodic(ends, checks, last, limit):
    """(opened, resolved or -1) of one patient, checked at every instant up to ``last``."""
    out, opened, at = [], -1, checks.at_or_after(0)
    while at <= last:
        seen = max((e for e in ends if e <= at), default=-1)
        stale = seen < at - limit if seen >= 0 else True
        if stale and opened < 0:
            opened = at
            out.append((at, -1))
        elif not stale and opened >= 0:
            out.append((opened, at))
            opened = -1
        at += checks.every_seconds * 1000
    return out


def by_timer(arrivals, checks, last, limit):
    """The same by the steps of the processor: windows arrive, the clock moves on, due checks are dealt with."""
    silence, out = st.Silence(listed=True), []

    def until(clock):
        nonlocal silence
        while (due := silence.next_check(checks, limit)) is not None and due <= clock:
            silence, change = silence.after_check(due, limit)
            if change:
                out.append(change)

    for clock, end in arrivals:
        until(clock)
        ends = sorted({*silence.ahead, end})
        seen = max([silence.seen, *(e for e in ends if e <= silence.handled)])
        silence = silence._replace(seen=seen, ahead=tuple(e for e in ends if e > seen))
    until(last)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_steps_equal_the_periodic_check(seed):
    rnd = random.Random(seed)
    checks = st.Checks(T0, rnd.choice([30, 45, 600]))
    limit = rnd.choice([60, 90, 1000]) * 1000
    for _ in range(120):
        at, arrivals = START - 200_000, []
        for _ in range(rnd.randint(0, 25)):
            at += rnd.choice([5, 20, 30, 30, 200, 900]) * 1000
            arrivals.append((at, at + rnd.randrange(1, 31) * 1000))  # a window ends after the reading that fills it
        last = START + 12_000_000
        assert by_timer(arrivals, checks, last, limit) == periodic([e for _, e in arrivals], checks, last, limit)


def test_checks_lie_on_their_clock():
    checks = st.Checks(T0, 30)
    assert checks.at_or_after(0) == checks.at_or_after(START) == START
    assert checks.at_or_after(START + 1) == checks.at_or_after(START + 30_000) == START + 30_000


def test_unlisted_patients_have_no_timer():
    assert st.Silence(seen=START).next_check(st.Checks(T0, 30), 1000) is None


def test_stream_over_several_starts(spark, folder):
    """Never seen, gone silent, back again, unknown to the roster; one patient who sends most, and a restart in between."""
    schema = "patient_id string, event_time timestamp"
    at = lambda s: T0 + timedelta(seconds=s)
    steps = [
        [("quiet", at(1)), ("back", at(2)), ("unknown", at(3))] + [("steady", at(k)) for k in range(0, 100)],
        [("steady", at(k)) for k in range(100, 300, 5)],
        [("back", at(310))] + [("steady", at(k)) for k in range(300, 420, 5)],
    ]
    patients = spark.createDataFrame([("quiet", "Q"), ("back", "B"), ("steady", "S"), ("never", "N")], "patient_id string, name string")
    checks, cfg = st.Checks(T0, 30), DEFAULTS
    st.roster(patients, F.lit(T0)).coalesce(1).write.parquet(f"{folder}/roster")
    for k, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/step={k}")
        read = lambda path, kind: spark.readStream.schema(kind).parquet(path)
        signs = st.signs_of_life(read(f"{folder}/in/step=*", schema), cfg).unionByName(read(f"{folder}/roster", st.INPUT))
        st.start_staleness(signs, f"{folder}/alerts", f"{folder}/checkpoint", checks, cfg, {"availableNow": True}).awaitTermination()
    got = {(r["patient_id"], (r["triggered_at"] - T0).seconds): r["acknowledged"]
           for r in st.read_silences(spark, f"{folder}/alerts", patients, cfg).collect()}
    want = {}
    sent = [r for rows in steps for r in rows]
    now = START + 1000 * 415 - 10_000  # the watermark
    for patient in ("quiet", "back", "steady", "never"):
        ends = [START + 1000 * (30 * ((t - T0).seconds // 30) + 30) for p, t in sent if p == patient]
        for opened, resolved in periodic(ends, checks, now, 1000 * cfg.stale_after_seconds):
            want[patient, (opened - START) // 1000] = resolved >= 0
    assert got == want
    assert {("never", 0): False, ("quiet", 120): False, ("back", 120): True}.items() <= got.items()


def test_workers_need_not_have_the_package(tmp_path):
    """What is sent to a Python worker is rebuilt and used where bedwatch cannot be imported."""
    checks = st.Checks(T0, 30)
    sent = cloudpickle.dumps((st.silence_processor(checks, 60_000), st._once_per_window, st.Silence(listed=True), checks))
    (tmp_path / "sent").write_bytes(sent)
    use = ("import importlib.util, pickle; assert importlib.util.find_spec('bedwatch') is None; "
           "p, once, s, c = pickle.load(open('sent', 'rb')); at = s.next_check(c, 60_000); "
           "print(type(p).__name__, once.__name__, s.after_check(at, 60_000)[1])")
    # -I: neither PYTHONPATH nor the folder of the call is searched
    said = subprocess.run([sys.executable, "-I", "-c", use], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    assert said.stdout.split() == ["Processor", "_once_per_window", f"({START},", "-1)"]


@pytest.fixture
def default_store(spark):
    """A session with the state store that Spark has by default, which has no timers."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.unset(STATE_STORE)
    default = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield default
    spark.conf.set(STATE_STORE, before)


def test_sessions_with_the_default_state_store(spark, folder, default_store):
    """A session need not have been built for timers, and its other streams keep their store."""
    patients = spark.createDataFrame([("never", "N")], "patient_id string, name string")
    st.roster(patients, F.lit(T0)).unionByName(st.clock(spark.createDataFrame([(T0 + timedelta(seconds=60),)], "at timestamp"))) \
        .coalesce(1).write.parquet(f"{folder}/in")
    signs = spark.readStream.schema(st.INPUT).parquet(f"{folder}/in")
    before = spark.conf.get(STATE_STORE)
    st.start_staleness(signs, f"{folder}/alerts", f"{folder}/checkpoint", st.Checks(T0, 30), DEFAULTS, {"availableNow": True}).awaitTermination()
    assert spark.conf.get(STATE_STORE) == before == default_store
    got = st.read_silences(spark, f"{folder}/alerts", patients).collect()
    assert [(r["patient_id"], r["triggered_at"], r["acknowledged"]) for r in got] == [("never", T0, False)]


def test_patients_of_a_bucket_share_a_timer(spark, folder):
    """All in one bucket, overdue at different checks, several checks in a batch, odd names, and a restart."""
    at = lambda s: T0 + timedelta(seconds=s)
    sent = [[('a"\\\\', at(1)), ("é, b", at(100)), ("c", at(400))], [("c", at(900)), ('a"\\\\', at(905))], [("c", at(1300))]]
    patients = spark.createDataFrame([(p, p) for p in ('a"\\\\', "é, b", "c", "never")], "patient_id string, name string")
    checks = st.Checks(T0, 30)
    st.roster(patients, F.lit(T0)).coalesce(1).write.parquet(f"{folder}/roster")
    for k, rows in enumerate(sent):
        spark.createDataFrame(rows, "patient_id string, event_time timestamp").coalesce(1).write.parquet(f"{folder}/in/step={k}")
        readings = spark.readStream.schema("patient_id string, event_time timestamp").parquet(f"{folder}/in/step=*")
        signs = st.signs_of_life(readings).unionByName(spark.readStream.schema(st.INPUT).parquet(f"{folder}/roster"))
        st.start_staleness(signs, f"{folder}/alerts", f"{folder}/checkpoint", checks, DEFAULTS, {"availableNow": True}, buckets=1).awaitTermination()
    got = {(r["patient_id"], int((r["triggered_at"] - T0).total_seconds())): r["acknowledged"]
           for r in st.read_silences(spark, f"{folder}/alerts", patients).collect()}
    now, want = START + 1000 * 1300 - 10_000, {}
    for name, in patients.select("patient_id").collect():
        ends = [START + 1000 * (30 * (int((t - T0).total_seconds()) // 30) + 30) for rows in sent for p, t in rows if p == name]
        for opened, resolved in periodic(ends, checks, now, 1000 * DEFAULTS.stale_after_seconds):
            want[name, (opened - START) // 1000] = resolved >= 0
    assert got == want and len(got) > 5

"""Streams give the batch results, however the input is cut into files."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS
from bedwatch.operators import episodes as ep
from bedwatch.operators.health import component_freshness
from bedwatch.operators.windows import window_aggregates
from bedwatch.sources import readings as rd
from bedwatch.streaming import alerts as sa, metrics as mt, speed_layer as sl
from tests.test_episodes import rows_of, simulate

T0 = datetime(2024, 1, 1)


def messages(seed, n=400, spread=7_000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        pid = "hot" if rnd.random() < 0.4 else f"P{rnd.randrange(3)}"
        at = T0 + timedelta(milliseconds=i * spread + rnd.randrange(spread))
        out.append({"event_id": f"{i:06d}", "patient_id": pid, "heart_rate": rnd.choice([80.0, 80.0, 125.0, 155.0]),
                    "spo2": rnd.choice([97.0, 97.0, 97.0, 85.0]), "systolic_bp": 120.0, "diastolic_bp": 80.0,
                    "temperature": 36.8, "timestamp": at.isoformat(timespec="milliseconds") + "Z", "condition": "stable"})
    return out


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    stamp = 1_700_000_000 + int(name[1:])  # the file source reads in order of modification
    os.utime(f"{folder}/{name}.json", (stamp, stamp))


def split(folder, rows, size, seed=0):
    """Files of ``size`` rows, shuffled inside each file."""
    rnd = random.Random(seed)
    for k in range(0, len(rows), size):
        part = rows[k:k + size]
        rnd.shuffle(part)
        put(folder, f"f{k:06d}", part)


def stream(spark, folder):
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    return rd.valid_readings(rd.parse_payload(raw))


def batch(spark, folder):
    return rd.valid_readings(rd.parse_payload(spark.read.text(folder)))


@pytest.mark.parametrize("size", [400, 37])
def test_windows_match_batch(spark, folder, size):
    split(folder + "/in", messages(1), size)
    folders = sl.Folders.under(folder)
    cfg = DEFAULTS.with_(watermark="10 minutes")
    sl.start_windows(stream(spark, folder + "/in"), folders, cfg, drain=True).awaitTermination()
    key = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    want = window_aggregates(batch(spark, folder + "/in"), cfg)
    assert key(sl.read_windows(spark, folders).select(*want.columns)) == key(want)


def test_late_rows_leave_the_windows_but_stay_in_the_archive(spark, folder):
    rows = messages(2, 60, 10_000)
    late = dict(rows[0], event_id="late")
    split(folder + "/in", rows, 20)
    put(folder + "/in", "f900000", [late])
    folders = sl.Folders.under(folder)
    sl.start_speed_layer(stream(spark, folder + "/in"), folder, DEFAULTS, drain=True)
    assert sl.read_windows(spark, folders).agg(F.sum("reading_count")).first()[0] == 60
    metrics = sl.read_metrics(spark, folders)
    totals = {(r.component, r.metric_name): r.metric_value for r in mt.metric_totals(metrics).collect()}
    assert totals["vitals_agg", "rows_late"] == 1 and totals["vitals_agg", "aggregates_written"] > 0
    assert totals["raw_archive", "raw_records_archived"] == 61
    beats = mt.heartbeats(metrics.filter("component = 'vitals_agg'"))
    fresh = component_freshness(beats, F.current_timestamp()).filter("component = 'speed_layer'").first()
    assert beats.count() >= 4 and not fresh.stale
    archived = rd.scan_archive(spark, folders.archive)
    assert archived.count() == 61 and archived.filter("event_id = 'late'").count() == 1


@pytest.mark.parametrize("size,seed", [(400, 3), (23, 3), (61, 4)])
def test_alerts_match_batch(spark, folder, size, seed):
    split(folder + "/in", messages(seed, spread=40_000), size, seed)
    folders = sl.Folders.under(folder)
    sl.start_alerts(stream(spark, folder + "/in"), folders, DEFAULTS, drain=True).awaitTermination()
    want = rows_of(ep.alert_episodes(ep.breach_events(batch(spark, folder + "/in"))))
    assert rows_of(sa.read_alerts(spark, folders.alerts)) == want and len(want) > 20


def test_out_of_order_across_batches_within_the_watermark(spark, folder):
    """A late bridge joins two open alerts; the superseded one disappears."""
    def at(name, seconds):
        m = messages(0, 1)[0]
        when = (T0 + timedelta(seconds=seconds)).isoformat(timespec="milliseconds") + "Z"
        put(folder + "/in", name, [dict(m, event_id=name, patient_id="P", heart_rate=80.0, spo2=85.0, timestamp=when)])
    for i, s in enumerate((0, 500, 250, -100)):
        at(f"f{i}", s)
    folders = sl.Folders.under(folder)
    cfg = DEFAULTS.with_(watermark="20 minutes")
    sl.start_alerts(stream(spark, folder + "/in"), folders, cfg, drain=True).awaitTermination()
    got = sa.read_alerts(spark, folders.alerts).collect()
    assert [(r.triggered_at, r.last_seen_at, r.occurrences, r.severity) for r in got] == [
        (T0 - timedelta(seconds=100), T0 + timedelta(seconds=500), 4, "CRITICAL")]


def test_acknowledgements_in_the_stream(spark, folder):
    rows = messages(5, 300, 20_000)
    split(folder + "/in", rows, 300)
    found = rows_of(ep.alert_episodes(ep.breach_events(batch(spark, folder + "/in"))))
    rnd = random.Random(5)
    acks = []
    for pid, vital, start, last, *_ in found:
        if rnd.random() < 0.5:
            at = start + (last - start) / 2
            acks.append((1, pid, vital, start, at.replace(microsecond=at.microsecond // 1000 * 1000)))
    # One file of readings and one of acknowledgements per micro-batch, in step with event time.
    src = folder + "/mixed"
    cuts = [T0 + timedelta(seconds=s) for s in range(0, 6600, 300)]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = [json.dumps(r) for r in rows if lo <= datetime.fromisoformat(r["timestamp"][:-1]) < hi]
        part += [json.dumps({"ack": True, "alert_id": 1, "patient_id": a[1], "vital_name": a[2],
                             "triggered_at": a[3].isoformat() + "Z", "acked_at": a[4].isoformat() + "Z"})
                 for a in acks if lo <= a[4] < hi]
        os.makedirs(src, exist_ok=True)
        with open(f"{src}/f{i:04d}.json", "w") as f:
            f.write("\n".join(part) + "\n")
        os.utime(f"{src}/f{i:04d}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    ack = raw.select(F.from_json("value", "ack boolean, alert_id long, patient_id string, vital_name string, "
                                          "triggered_at timestamp, acked_at timestamp").alias("a")).select("a.*").filter("ack").drop("ack")
    valid = rd.valid_readings(rd.parse_payload(raw))
    q = (sa.alert_inputs(valid, ack).writeStream.foreachBatch(sa.alert_writer(folder + "/alerts"))
         .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    breaches = [(r.patient_id, r.event_id, r.event_time, r.vital_name, r.vital_value, r.threshold_value, r.above, r.severity)
                for r in ep.breach_events(batch(spark, folder + "/in")).collect()]
    got = sa.read_alerts(spark, folder + "/alerts")
    assert rows_of(got) == simulate(breaches, acks)
    assert len(acks) > 3 and len(rows_of(got)) > len(found)
    starts = {(a[1], a[2], a[3]) for a in acks}
    assert {(r.patient_id, r.vital_name, r.triggered_at) for r in got.filter("acknowledged").collect()} >= {
        s for s in starts if any(s == g[:3] for g in rows_of(got))}


def test_replayed_batch_changes_nothing(spark, folder):
    split(folder + "/in", messages(6, 120, 40_000), 40)
    write = sa.alert_writer(folder + "/alerts")
    files = sorted(os.listdir(folder + "/in"))
    for i, name in enumerate(files):
        part = sa.alert_inputs(batch(spark, f"{folder}/in/{name}"))
        write(part, i)
        write(part, i)
    want = rows_of(ep.alert_episodes(ep.breach_events(batch(spark, folder + "/in"))))
    assert rows_of(sa.read_alerts(spark, folder + "/alerts")) == want


def one_by_one(spark, folder, breaches, write=None):
    """Every breach (patient, seconds, heart rate) is a micro-batch of its own."""
    write = write or sa.alert_writer(folder + "/alerts")
    for i, (pid, seconds, hr) in enumerate(breaches):
        m = dict(messages(0, 1)[0], event_id=f"{i:04d}", patient_id=pid, heart_rate=hr, spo2=97.0,
                 timestamp=(T0 + timedelta(seconds=seconds)).isoformat(timespec="milliseconds") + "Z")
        put(folder + "/in", f"f{i:06d}", [m])
        write(sa.alert_inputs(batch(spark, f"{folder}/in/f{i:06d}.json")), i)
    want = rows_of(ep.alert_episodes(ep.breach_events(batch(spark, folder + "/in"))))
    assert rows_of(sa.read_alerts(spark, folder + "/alerts")) == want
    return want


def test_a_lagging_patient_still_escalates(spark, folder):
    got = one_by_one(spark, folder, [("A", 0, 125.0), ("B", 360, 125.0), ("A", 5, 125.0), ("A", 10, 125.0)])
    assert len(got) == 2


def test_one_reading_dated_ahead_does_not_stop_alerts(spark, folder):
    year = 365 * 86400
    got = one_by_one(spark, folder, [("A", 0, 125.0), ("A", 6 * year, 125.0), ("A", 5, 125.0), ("B", 7, 125.0), ("A", 10, 125.0),
                                     ("A", 7 * year, 125.0), ("B", 12, 125.0), ("A", 15, 125.0), ("B", 20, 125.0)])
    assert len(got) == 4


def test_keys_interleaved_over_many_batches(spark, folder, monkeypatch):
    """Keys far apart in time, in 20 batches; the logs are compacted on the way."""
    from bedwatch.session import numbered_folders

    monkeypatch.setattr(sa, "COMPACT_EVERY", 4)
    rnd = random.Random(9)
    at = {p: k * 4000 for k, p in enumerate("ABCD")}
    rows = []
    for _ in range(20):
        p = rnd.choice("ABCD")
        at[p] += rnd.choice([20, 100, 250, 900])
        rows.append((p, at[p], rnd.choice([125.0, 155.0])))
    one_by_one(spark, folder, rows)
    for log in ("", "/state"):
        assert len(numbered_folders(spark, f"{folder}/alerts{log}/changes", "batch_id")) <= 9


def test_state_is_stored_for_touched_keys_only(spark, folder):
    one_by_one(spark, folder, [(p, 10 * k, 125.0) for k, p in enumerate("ABCDEF")])
    for k in range(6):
        assert spark.read.parquet(f"{folder}/alerts/state/changes/batch_id={k}").count() == 1


def test_metrics_of_more_than_a_hundred_batches_are_exact(spark, folder):
    split(folder + "/in", messages(8, 105), 1)
    folders = sl.Folders.under(folder)
    watcher = mt.BatchMetrics(folders.metrics, compact_every=40)
    spark.streams.addListener(watcher)
    q = watcher.watch(sl.start_archive(stream(spark, folder + "/in"), folders, DEFAULTS, drain=True))
    q.awaitTermination()
    watcher.settle(q)
    spark.streams.removeListener(watcher)
    for _ in range(2):  # reading twice counts nothing twice
        metrics = sl.read_metrics(spark, folders)
        totals = {r.metric_name: r.metric_value for r in mt.metric_totals(metrics).collect()}
        assert totals["rows_read"] == 105 and totals["raw_records_archived"] == 105
        assert metrics.select("batch").distinct().count() == 105


def test_all_three_queries_share_one_stream(spark, folder):
    split(folder + "/in", messages(7, 100), 50)
    queries = sl.start_speed_layer(stream(spark, folder + "/in"), folder, drain=True)
    for q in queries:
        q.awaitTermination()
    assert [q.name for q in queries] == ["raw_archive", "vitals_agg", "vitals_alerts"]
    folders = sl.Folders.under(folder)
    assert rd.scan_archive(spark, folders.archive).count() == 100
    # A second run finds nothing new.
    for q in sl.start_speed_layer(stream(spark, folder + "/in"), folder, drain=True):
        q.awaitTermination()
    assert rd.scan_archive(spark, folders.archive).count() == 100


def test_copies_count_once_and_readings_without_an_id_each(spark, folder):
    """Every message again one file later, out of order; those without an id are different readings."""
    rows = messages(11, 120, 10_000)
    for k in range(0, 120, 30):
        again = rows[max(0, k - 30):k]
        put(folder + "/in", f"f{k:06d}", [*reversed(rows[k:k + 30]), *again])
    put(folder + "/in", "f900000", rows[90:])
    nameless = [dict(rows[-1], event_id=None) for _ in range(3)]
    put(folder + "/in", "f900001", nameless)
    put(folder + "/once", "f1", rows + nameless)
    cfg = DEFAULTS.with_(watermark="20 minutes")
    queries = sl.start_speed_layer(stream(spark, folder + "/in"), folder, cfg, drain=True, unique=True)
    assert len(queries) == 3
    folders = sl.Folders.under(folder)
    key = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    want = window_aggregates(batch(spark, folder + "/once"), cfg)
    assert key(sl.read_windows(spark, folders).select(*want.columns)) == key(want)
    alerts = ep.alert_episodes(ep.breach_events(batch(spark, folder + "/once"), cfg), None, cfg)
    columns = ["patient_id", "vital_name", "severity", "occurrences", "triggered_at", "last_seen_at"]
    assert key(sa.read_alerts(spark, folders.alerts).select(*columns)) == key(alerts.select(*columns))
    assert rd.scan_archive(spark, folders.archive).count() == 120 + 120 + 3  # the archive keeps what was sent


@pytest.mark.parametrize("unique", [False, True])
def test_late_readings_are_put_right(spark, folder, unique):
    """Corrections run after every few batches, one of them twice; a second late reading corrects the same window again."""
    rows = messages(5, 90, 10_000)
    late = [dict(rows[k], event_id=f"late-{k}", heart_rate=150.0) for k in (0, 1, 2, 20)]
    split(folder + "/in", rows, 30)
    folders = sl.Folders.under(folder)

    def run():
        sl.start_speed_layer(stream(spark, folder + "/in"), folder, DEFAULTS, drain=True, unique=unique)
        sl.start_corrections(sl.archived_stream(spark, folders), folders, DEFAULTS, drain=True, unique=unique,
                             origin="2024-01-01 00:00:00").awaitTermination()

    def keyed(df):
        return {(r["patient_id"], r["window_start"]): r["reading_count"] for r in df.collect()}

    run()
    before = keyed(sl.read_windows(spark, folders))
    assert before == keyed(window_aggregates(batch(spark, folder + "/in"), DEFAULTS))
    for k, some in enumerate((late[:2], late[2:])):
        put(folder + "/in", f"f{900_000 + k}", some)
        run()
        assert keyed(sl.read_windows(spark, folders)) == keyed(window_aggregates(batch(spark, folder + "/in"), DEFAULTS))
    after = keyed(sl.read_windows(spark, folders))
    assert sum(after.values()) == sum(before.values()) + 4
    from bedwatch.operators.features import assign_aligned_day, daily_features
    from bedwatch.streaming.corrections import corrected_features, late_readings

    assert late_readings(spark, folders).filter("event_id like 'late%'").count() == 4
    of_days = lambda df: daily_features(assign_aligned_day(rd.dedupe_readings(df), "2024-01-01 00:00:00"), DEFAULTS)
    early = of_days(batch(spark, folder + "/in").filter("event_id not like 'late%'"))
    got = corrected_features(spark, folders, early)
    key = lambda df: sorted((r["patient_id"], r["simulated_day"], r["total"], r["abnormal"], round(r["avg_heart_rate"], 9)) for r in df.collect())
    assert key(got) == key(of_days(batch(spark, folder + "/in")))


def test_a_replayed_correction_gives_the_same(spark, folder):
    rows = messages(6, 60, 10_000)
    split(folder + "/in", rows, 60)
    folders = sl.Folders.under(folder)
    sl.start_archive(stream(spark, folder + "/in"), folders, DEFAULTS, drain=True).awaitTermination()
    from bedwatch.streaming.corrections import correction_writer, corrected_windows

    write = correction_writer(folders)
    archived = spark.read.parquet(folders.archive)
    write(archived, 0)
    once = sorted(map(tuple, corrected_windows(spark, folders).collect()), key=str)
    write(archived, 0)
    assert sorted(map(tuple, corrected_windows(spark, folders).collect()), key=str) == once
    write(archived.limit(0), 1)
    assert sorted(map(tuple, corrected_windows(spark, folders).collect()), key=str) == once


def test_a_batch_keeps_its_summaries_not_its_breaches(spark, folder, monkeypatch):
    """Without acknowledgements what is stored between the steps of a batch grows with its episodes, not its rows."""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") / 1000)
    rows = spark.range(3000).select(
        F.lit("p").alias("patient_id"), F.col("id").alias("event_id"), at.alias("event_time"), F.lit(200.0).alias("heart_rate"),
        F.lit(97.0).alias("spo2"), F.lit(120.0).alias("systolic_bp"), F.lit(80.0).alias("diastolic_bp"), F.lit(36.8).alias("temperature"))
    kept, persist = [], type(rows).persist

    def counted(df, *level):
        kept.append(df.count())
        return persist(df, *level)

    monkeypatch.setattr(type(rows), "persist", counted)
    sa.alert_writer(folder + "/alerts")(sa.alert_inputs(rows), 0)
    assert kept and max(kept) < 10
    assert [r["occurrences"] for r in sa.read_alerts(spark, folder + "/alerts").collect()] == [3000]

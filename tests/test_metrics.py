"""What is kept in the driver about streams, and answers to acknowledgements."""

from datetime import datetime
from types import SimpleNamespace

from bedwatch.operators import alerts as al
from bedwatch.streaming import metrics as mt


def progress(query, batch):
    return SimpleNamespace(id=query, batchId=batch, durationMs={"addBatch": 1}, numInputRows=5, stateOperators=[],
                           observedMetrics={}, timestamp="2024-01-01T00:00:00.000Z")


def test_a_thousand_batches_of_a_query_nobody_watches(spark, folder):
    watcher = mt.BatchMetrics(folder)
    watcher.onQueryProgress(SimpleNamespace(progress=progress("mine", 0)))
    watcher.watch(SimpleNamespace(id="mine", name="raw_archive"))
    watcher.all_watched()
    for k in range(1000):
        watcher.onQueryProgress(SimpleNamespace(progress=progress("other", k)))
    assert watcher.early is None and watcher.done == {"mine": 0}
    assert mt.batch_metrics(spark, folder, ("raw_archive",)).filter("metric_name = 'rows_read'").count() == 1


def test_reports_before_watching_are_kept_per_query_until_it_ends(spark, folder):
    watcher = mt.BatchMetrics(folder)
    for k in range(3):
        watcher.onQueryProgress(SimpleNamespace(progress=progress("a", k)))
        watcher.onQueryProgress(SimpleNamespace(progress=progress("b", k)))
    watcher.onQueryTerminated(SimpleNamespace(id="b"))
    assert set(watcher.early) == {"a"}


def test_every_request_is_answered(spark):
    alerts = spark.createDataFrame([(1,), (1,), (2,)], "alert_id long")
    at = datetime(2024, 1, 1)
    requests = spark.createDataFrame([(1, at), (1, at), (9, at), (None, at)], "alert_id long, acked_at timestamp")
    got = sorted((r["alert_id"] or 0, r["status"]) for r in al.acknowledge_answers(alerts, requests).collect())
    assert got == [(0, "not found"), (1, "acknowledged"), (1, "acknowledged"), (9, "not found")]
    assert al.acknowledge_answers(alerts.limit(0), requests).filter("status = 'not found'").count() == 4

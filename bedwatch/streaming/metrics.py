"""What streaming queries did, per micro-batch, kept as they go."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from bedwatch.sinks.tables import has_changes, latest_rows, write_changes

METRIC_KEYS = ("component", "metric_name", "batch")
SCHEMA = "component string, metric_name string, batch long, metric_value double, at string"
COMPACT_EVERY = 100


class BatchMetrics(StreamingQueryListener):
    """Stores one set of metric rows per query and micro-batch under ``path``/query name.

    Every batch is reported to the listener once, so no list of recent batches has
    to be kept or summed; a batch that runs again replaces its rows. Rows read, rows
    dropped as late, and the counts a query observes while its rows pass by.
    """

    def __init__(self, path: str, compact_every: int = COMPACT_EVERY):
        self.path, self.compact_every = path, compact_every
        self.names: dict[str, str] = {}  # id of a watched query -> its name
        self.early: dict[str, list] | None = {}  # by query id, reported before the query was watched; None once all are
        self.done: dict[str, int] = {}

    def watch(self, query: StreamingQuery) -> StreamingQuery:
        self.names[str(query.id)] = query.name
        for progress in (self.early or {}).pop(str(query.id), []):
            self._store(progress)
        return query

    def all_watched(self) -> None:
        """No further query will be watched: reports of others are not kept from now on."""
        self.early = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.early is not None:
            self.early.pop(str(event.id), None)

    def onQueryProgress(self, event) -> None:
        self._store(event.progress)

    def _store(self, progress) -> None:
        name = self.names.get(str(progress.id))
        if name is None:
            if self.early is not None:
                self.early.setdefault(str(progress.id), []).append(progress)
            return
        if "addBatch" not in progress.durationMs:  # nothing ran
            return
        counts = {"rows_read": progress.numInputRows,
                  "rows_late": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)}
        for observed in progress.observedMetrics.values():
            counts.update(observed.asDict())
        rows = [(name, metric, progress.batchId, float(value), progress.timestamp) for metric, value in counts.items()]
        write_changes(SparkSession.active().createDataFrame(rows, SCHEMA).coalesce(1), f"{self.path}/{name}",
                      progress.batchId, METRIC_KEYS, self.compact_every)
        self.done[str(progress.id)] = progress.batchId

    def settle(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until the last batch of a stopped query has been stored; reports arrive after their batch."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last is not None and "addBatch" in last.durationMs and self.done.get(str(query.id), -1) < last.batchId:
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {last.batchId} of {query.name}")
            time.sleep(0.05)


def batch_metrics(spark: SparkSession, path: str, names: tuple[str, ...]) -> DataFrame:
    """(component, metric_name, batch, metric_value, recorded_at) of the named queries."""
    found = spark.createDataFrame([], SCHEMA)
    for name in names:
        if has_changes(spark, f"{path}/{name}", 1 << 62):
            found = found.unionByName(latest_rows(spark, f"{path}/{name}", METRIC_KEYS))
    return found.withColumn("recorded_at", F.to_timestamp("at")).drop("at")


def metric_totals(metrics: DataFrame) -> DataFrame:
    """Totals over all batches, recorded at the newest of them."""
    return metrics.groupBy("component", "metric_name").agg(
        F.sum("metric_value").alias("metric_value"), F.max("recorded_at").alias("recorded_at"))


def heartbeats(metrics: DataFrame, component: str = "speed_layer") -> DataFrame:
    """One sign of life per batch, for the freshness check."""
    return metrics.filter(F.col("metric_name") == "rows_read").select(
        F.lit(component).alias("component"), "recorded_at")

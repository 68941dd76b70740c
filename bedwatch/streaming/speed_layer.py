"""The three queries off one parsed stream: raw archive, windows, alerts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from bedwatch.config import DEFAULTS, Settings
from bedwatch.operators.windows import window_aggregates
from bedwatch.sinks.tables import latest_rows, write_changes
from bedwatch.sources.readings import quarantined_readings
from bedwatch.streaming.alerts import alert_inputs, alert_writer
from bedwatch.streaming.corrections import WINDOW_KEYS, corrected_windows, correction_writer
from bedwatch.streaming.metrics import BatchMetrics, batch_metrics

QUERY_NAMES = ("raw_archive", "vitals_agg", "vitals_alerts", "rejects", "corrections")
COMPACT_EVERY = 100


class Folders(NamedTuple):
    archive: str
    windows: str
    alerts: str
    checkpoints: str
    rejects: str
    metrics: str
    corrections: str

    @classmethod
    def under(cls, root: str) -> "Folders":
        return cls(*(f"{root}/{name}" for name in cls._fields))


def _trigger(interval: str, drain: bool) -> dict:
    """Run on an interval, or work off what is there and stop."""
    return {"availableNow": True} if drain else {"processingTime": interval}


def unique_readings(readings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """A stream in which a reading delivered again is passed on once; it carries the watermark.

    An id is remembered until the watermark has passed it, so the state holds the ids of that time only; copies further
    apart are late anyway. Readings without an id equal no other and go past that state.
    """
    marked = readings.withWatermark("event_time", cfg.watermark)
    known = marked.filter(F.col("event_id").isNotNull()).dropDuplicatesWithinWatermark(["event_id"])
    return known.unionByName(marked.filter(F.col("event_id").isNull()))


def start_archive(readings: DataFrame, folders: Folders, cfg: Settings = DEFAULTS,
                  drain: bool = False) -> StreamingQuery:
    """Append every valid reading to the archive by date; the file sink commits each batch once."""
    dated = readings.withColumn("event_date", F.to_date("event_time")).observe(
        "archive", F.count("*").alias("raw_records_archived"))
    return (
        dated.writeStream.queryName("raw_archive").format("parquet").partitionBy("event_date")
        .option("path", folders.archive)
        .option("checkpointLocation", f"{folders.checkpoints}/raw_archive")
        .trigger(**_trigger(cfg.archive_trigger, drain)).start()
    )


def start_windows(readings: DataFrame, folders: Folders, cfg: Settings = DEFAULTS,
                  drain: bool = False, unique: bool = False) -> StreamingQuery:
    """Re-emit a window whenever it changed until the watermark closes it; the last emission counts.

    With ``unique``, readings delivered again are left out first.
    """
    marked = unique_readings(readings, cfg) if unique else readings.withWatermark("event_time", cfg.watermark)
    windows = window_aggregates(marked, cfg).observe("windows", F.count("*").alias("aggregates_written"))
    return (
        windows.writeStream.queryName("vitals_agg").outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_changes(
            batch, folders.windows, batch_id, WINDOW_KEYS, COMPACT_EVERY))
        .option("checkpointLocation", f"{folders.checkpoints}/vitals_agg")
        .trigger(**_trigger(cfg.window_trigger, drain)).start()
    )


def start_alerts(readings: DataFrame, folders: Folders, cfg: Settings = DEFAULTS,
                 acks: DataFrame | None = None, drain: bool = False, unique: bool = False) -> StreamingQuery:
    inputs = alert_inputs(unique_readings(readings, cfg) if unique else readings, acks, cfg).observe(
        "alerts", F.count_if(F.col("kind") == "breach").alias("breaches_seen"))
    return (
        inputs.writeStream.queryName("vitals_alerts").outputMode("append")
        .foreachBatch(alert_writer(folders.alerts, cfg))
        .option("checkpointLocation", f"{folders.checkpoints}/vitals_alerts")
        .trigger(**_trigger(cfg.alert_trigger, drain)).start()
    )


def start_rejects(parsed: DataFrame, folders: Folders, cfg: Settings = DEFAULTS,
                  drain: bool = False) -> StreamingQuery:
    """Keep the messages that are no valid reading, with the reason."""
    rejects = quarantined_readings(parsed).observe("rejects", F.count("*").alias("records_rejected"))
    return (
        rejects.writeStream.queryName("rejects").format("parquet").partitionBy("reject_reason")
        .option("path", folders.rejects)
        .option("checkpointLocation", f"{folders.checkpoints}/rejects")
        .trigger(**_trigger(cfg.archive_trigger, drain)).start()
    )


def start_corrections(archive: DataFrame, folders: Folders, cfg: Settings = DEFAULTS, drain: bool = False,
                      unique: bool = False, origin: str | None = None) -> StreamingQuery:
    """Put windows right that were closed when readings for them arrived.

    ``archive`` is the archive read as a stream (``archived_stream``): what it hands on is stored, so a window can be
    computed anew from it. With ``origin``, the daily features of the days that late readings belong to are kept as well.
    """
    return (
        archive.writeStream.queryName("corrections").outputMode("append")
        .foreachBatch(correction_writer(folders, cfg, unique, origin))
        .option("checkpointLocation", f"{folders.checkpoints}/corrections")
        .trigger(**_trigger(cfg.archive_trigger, drain)).start()
    )


def archived_stream(spark: SparkSession, folders: Folders) -> DataFrame:
    """The archive as a stream, in the order in which batches were committed to it."""
    schema = spark.read.parquet(folders.archive).schema
    return spark.readStream.schema(schema).parquet(folders.archive)


def start_speed_layer(readings: DataFrame, root: str, cfg: Settings = DEFAULTS, acks: DataFrame | None = None,
                      drain: bool = False, parsed: DataFrame | None = None, unique: bool = False) -> list[StreamingQuery]:
    """All queries, each with its own checkpoint and pace; their metrics are stored batch by batch.

    ``parsed`` is the stream before ``valid_readings``; if given, what was left out is kept as well. With ``unique``, readings
    delivered again count once in windows and alerts; the archive keeps what was sent.
    """
    folders = Folders.under(root)
    watcher = BatchMetrics(folders.metrics)
    readings.sparkSession.streams.addListener(watcher)
    queries = [
        start_archive(readings, folders, cfg, drain),
        start_windows(readings, folders, cfg, drain, unique),
        start_alerts(readings, folders, cfg, acks, drain, unique),
    ]
    if parsed is not None:
        queries.append(start_rejects(parsed, folders, cfg, drain))
    for q in queries:
        watcher.watch(q)
    watcher.all_watched()
    if drain:
        for q in queries:
            q.awaitTermination()
            watcher.settle(q)
        readings.sparkSession.streams.removeListener(watcher)
    return queries


def read_windows(spark: SparkSession, folders: Folders) -> DataFrame:
    """Every window as it stands; what was corrected for late readings takes the place of what the stream had."""
    windows = latest_rows(spark, folders.windows, WINDOW_KEYS)
    corrected = corrected_windows(spark, folders)
    if corrected is None:
        return windows
    corrected = corrected.select(*windows.columns)
    return windows.join(corrected.select(*WINDOW_KEYS), list(WINDOW_KEYS), "left_anti").unionByName(corrected)


def read_metrics(spark: SparkSession, folders: Folders) -> DataFrame:
    return batch_metrics(spark, folders.metrics, QUERY_NAMES)

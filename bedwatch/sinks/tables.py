"""Keyed writes on plain Parquet: day tables, change logs, append tables, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from bedwatch.config import REPORT_COLUMNS
from bedwatch.session import numbered_folders, remove_folder, stage, temporary_stages


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace_days(rows: DataFrame, path: str, day: str = "simulated_day", days: Sequence[int] | None = None) -> None:
    """Replace exactly the days present in ``rows``, and empty those of ``days`` that have none; others stay untouched.

    The rebalance hint lets AQE size the output files and split a day that
    holds a large share of the rows.
    """
    (
        rows.hint("rebalance", day).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day).parquet(path)
    )
    if days:
        clear_days(rows, path, day, days, day)


def clear_days(rows: DataFrame, path: str, day: str, days: Sequence[int], folder: str) -> None:
    """Remove the stored folders of those ``days`` that ``rows`` has nothing for; a run has few days.

    Only the days of ``rows`` matter, so it may be what the stored rows were made from.
    """
    if not days:  # looking for the days of ``rows`` would compute them once more
        return
    spark = rows.sparkSession
    left = set(days) - {r[0] for r in rows.select(day).distinct().collect()}
    for number in left.intersection(numbered_folders(spark, path, folder)):
        remove_folder(spark, f"{path}/{folder}={number}")


def upsert_days(rows: DataFrame, path: str, keys: Sequence[str], day: str = "simulated_day",
                staged: bool = False) -> None:
    """Insert or replace by key inside day partitions; ``rows`` must be unique on the keys.

    Stored rows of the touched days whose key is not in ``rows`` are kept. They
    are staged first, because a plan must not read the partitions
    it overwrites; so are the input rows, which are read several times, unless
    the caller has already stored them. The first and last touched day prune
    partitions before anything is read; where nothing is stored there, nothing is compared.
    """
    spark = rows.sparkSession
    with temporary_stages(spark):
        rows = rows if staged else stage(rows, "upsert-input")
        stored = read_if_exists(spark, path)
        if stored is not None:
            first, last = rows.agg(F.min(day), F.max(day)).first()
            near = stored.filter(F.col(day).between(first, last)) if first is not None else stored.limit(0)
            if not near.isEmpty():
                touched = near.join(rows.select(day).distinct(), day, "left_semi")
                kept = touched.join(rows.select(*keys), list(keys), "left_anti")
                rows = rows.unionByName(stage(kept, "upsert-kept"), allowMissingColumns=True)
        replace_days(rows, path, day)


# ---- change log: upserts from a stream -----------------------------------

def write_changes(rows: DataFrame, path: str, batch_id: int, keys: Sequence[str] = (),
                  compact_every: int = 0) -> None:
    """Store one micro-batch of upserts. Replaying the batch rewrites the same folder.

    With ``compact_every`` the batches before this one are folded every so
    many batches, so that readers never list more than twice that number.
    """
    rows.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
    if compact_every and batch_id and batch_id % compact_every == 0:
        compact_changes(rows.sparkSession, path, keys, batch_id - 1)


def _newest_snapshot(spark: SparkSession, path: str, below: int | None) -> int | None:
    known = [n for n in numbered_folders(spark, f"{path}/snapshot", "upto") if below is None or n < below]
    return known[-1] if known else None


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str], below: int | None = None) -> DataFrame:
    """Current state of a change log: per key the row of the newest batch (``below`` a batch, if given).

    The per-key limit runs before the shuffle, so a key that was rewritten in
    every batch sends one row per task.
    """
    newest = _newest_snapshot(spark, path, below)
    wanted = [n for n in numbered_folders(spark, f"{path}/changes", "batch_id")
              if (newest is None or n > newest) and (below is None or n < below)]
    folders = [f"{path}/changes/batch_id={n}" for n in wanted]
    log = None
    if folders:
        log = spark.read.option("basePath", f"{path}/changes").parquet(*folders)
    if newest is not None:
        base = spark.read.parquet(f"{path}/snapshot/upto={newest}").withColumn("batch_id", F.lit(newest))
        log = base if log is None else log.unionByName(base, allowMissingColumns=True)
    if log is None:
        log = spark.read.parquet(f"{path}/changes")  # the reader's error says what is missing
    newest_first = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    current = log.withColumn("_rn", F.row_number().over(newest_first)).filter("_rn = 1").drop("_rn")
    if "deleted" in current.columns:
        current = current.filter(~F.coalesce("deleted", F.lit(False))).drop("deleted")
    return current.drop("batch_id")


def has_changes(spark: SparkSession, path: str, below: int) -> bool:
    return _newest_snapshot(spark, path, below) is not None or any(
        n < below for n in numbered_folders(spark, f"{path}/changes", "batch_id"))


def compact_changes(spark: SparkSession, path: str, keys: Sequence[str], upto: int | None = None) -> int:
    """Fold the change batches so far (up to ``upto``) into a snapshot; readers then skip those batches.

    What the snapshot before this one had already replaced is removed. The
    batches folded just now stay until the next compaction, for readers
    that have planned on them.
    """
    if upto is None:
        upto = numbered_folders(spark, f"{path}/changes", "batch_id")[-1]
    before = _newest_snapshot(spark, path, upto)
    latest_rows(spark, path, keys, upto + 1).write.mode("overwrite").parquet(f"{path}/snapshot/upto={upto}")
    if before is not None:
        for n in numbered_folders(spark, f"{path}/changes", "batch_id"):
            if n <= before:
                remove_folder(spark, f"{path}/changes/batch_id={n}")
        for n in numbered_folders(spark, f"{path}/snapshot", "upto"):
            if n < before:
                remove_folder(spark, f"{path}/snapshot/upto={n}")
    return upto


# ---- append tables and exports -------------------------------------------

def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def _by_day(rows: DataFrame):
    """A writer into a folder per day that replaces the days in ``rows`` and leaves the others."""
    return rows.withColumn("day", F.col("simulated_day")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day")


def export_report_csv(report: DataFrame, path: str, days: Sequence[int] = ()) -> None:
    """Report rows with a header, columns in the fixed order, in a folder per day; none for those of ``days`` without rows."""
    _by_day(report.select(*REPORT_COLUMNS)).option("header", True).csv(path)
    clear_days(report, path, "simulated_day", days, "day")


def export_documents_json(documents: DataFrame, path: str, days: Sequence[int] = (),
                          report: DataFrame | None = None) -> None:
    """Report documents as JSON lines in a folder per day; none for those of ``days`` without documents.

    Given the ``report`` they were made of, its days are looked at, and the documents are computed once.
    """
    _by_day(documents).json(path)
    clear_days(documents if report is None else report, path, "simulated_day", days, "day")

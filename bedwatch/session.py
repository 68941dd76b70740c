"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "bedwatch", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution and an on-disk state store.

    Partition counts are left to the cluster: AQE coalesces small shuffles and
    splits skewed joins, so the initial number only has to be high enough.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        STATE_STORE: ROCKSDB,
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def timers_store(spark: SparkSession) -> Iterator[None]:
    """What is started inside can have timers, whatever the session's state store.

    Values and timers of a processor are column families, which Spark's default store does not have; a stream
    keeps the store it was started with. A store that was chosen in place of the default is left.
    """
    before = spark.conf.get(STATE_STORE, None)
    if before and not before.endswith(".HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is only made in local mode, where driver and executors
    are one process; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="bedwatch-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is created until something is written."""
    return f"{shared_folder(spark)}/bedwatch/{label}-{uuid.uuid4().hex}"


#: folders staged inside the innermost ``temporary_stages``
_STAGED: list[list[str]] = []


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches need the same expensive result: the lineage is
    cut, every branch gets its own column pruning, and a lost executor does not
    bring the upstream job back.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    if _STAGED:
        _STAGED[-1].append(path)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end; nothing that reads it may be used afterwards."""
    _STAGED.append([])
    try:
        yield
    finally:
        for path in _STAGED.pop():
            remove_folder(spark, path)


# ---- folders, wherever they are -------------------------------------------

def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove_folder(spark: SparkSession, path: str) -> None:
    store, folder = _at(spark, path)
    store.delete(folder, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """``source`` in the place of ``target``, which need not exist."""
    store, folder = _at(spark, target)
    store.delete(folder, True)
    store.mkdirs(folder.getParent())
    if not store.rename(_at(spark, source)[1], folder):
        raise OSError(f"cannot move {source} to {target}")


def numbered_folders(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers n of the folders ``path``/key=n, ascending; none if there is no such path."""
    store, folder = _at(spark, path)
    if not store.exists(folder):
        return []
    names = [f.getPath().getName() for f in store.listStatus(folder)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{key}="))


def matching_names(spark: SparkSession, path: str, pattern: str) -> set[str]:
    """Names of the files and folders in ``path`` that match; none if there is no such path."""
    store, folder = _at(spark, path)
    if not store.exists(folder):
        return set()
    found = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}"))
    return {f.getPath().getName() for f in found}


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Whole paths of the files and folders that match a glob pattern."""
    store, folder = _at(spark, pattern)
    return [f.getPath().toString() for f in store.globStatus(folder) or []]

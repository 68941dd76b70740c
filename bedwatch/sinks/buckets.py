"""A keyed log in buckets: a batch reads and folds the buckets of its own keys, however many others there are."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from bedwatch.session import matching_paths, remove_folder

_PLACE = re.compile(r"(batch_id|bucket|upto)=(\d+)")


def _numbers(path: str) -> dict[str, int]:
    return {name: int(n) for name, n in _PLACE.findall(path)}


class BucketLog(NamedTuple):
    """One row per key, written anew by the batches that touch it. A key belongs to the bucket its hash names.

    ``changes/batch_id=N/bucket=B`` holds what batch N wrote; a batch that runs again rewrites it. Every ``compact_every``
    batches the buckets touched since then are folded into ``snapshot/bucket=B/upto=N``; others keep the snapshot they have.
    What the compaction before had replaced is removed by the next one.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int
    compact_every: int = 0

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store what a batch made of its keys; ``rows`` are unique on the keys."""
        rows.withColumn("bucket", self.bucket()).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/changes/batch_id={batch_id}")
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.compact(rows.sparkSession, rows.schema, batch_id - 1)

    def _places(self, spark: SparkSession, buckets: Sequence[int] | None, below: int) -> tuple[list[str], list[str]]:
        """Folders that hold these buckets as they were before batch ``below``: newest snapshots, and changes since."""
        some = "*" if buckets is None else "{" + ",".join(map(str, buckets)) + "}"
        newest: dict[int, tuple[int, str]] = {}
        for place in matching_paths(spark, f"{self.path}/snapshot/bucket={some}/upto=*"):
            n = _numbers(place)
            if n["upto"] < below:
                newest[n["bucket"]] = max(newest.get(n["bucket"], (-1, "")), (n["upto"], place))
        changes = []
        for place in matching_paths(spark, f"{self.path}/changes/batch_id=*/bucket={some}"):
            n = _numbers(place)
            if newest.get(n["bucket"], (-1, ""))[0] < n["batch_id"] < below:
                changes.append(place)
        return [place for _, place in newest.values()], changes

    def read(self, spark: SparkSession, schema: T.StructType, buckets: Sequence[int] | None = None,
             below: int = 1 << 62) -> DataFrame | None:
        """The rows of these buckets (of all, if None), of every key the one the newest batch before ``below`` wrote.

        None if nothing is stored for them.
        """
        snapshots, changes = self._places(spark, buckets, below)
        log = None
        for name, base, places in (("upto", "snapshot", snapshots), ("batch_id", "changes", changes)):
            if places:
                kind = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField(name, T.LongType())])
                found = spark.read.schema(kind).option("basePath", f"{self.path}/{base}").parquet(*places)
                found = found.withColumnRenamed(name, "number")
                log = found if log is None else log.unionByName(found)
        if log is None:
            return None
        newest_first = Window.partitionBy(*self.keys).orderBy(F.col("number").desc())
        return log.withColumn("_rn", F.row_number().over(newest_first)).filter("_rn = 1").select(*schema.names)

    def compact(self, spark: SparkSession, schema: T.StructType, upto: int) -> list[int]:
        """Fold the buckets touched since their last snapshot; returns them."""
        _, changes = self._places(spark, None, upto + 1)
        touched = sorted({_numbers(place)["bucket"] for place in changes})
        if touched:
            folded = self.read(spark, schema, touched, upto + 1).withColumns({"bucket": self.bucket(), "upto": F.lit(upto)})
            folded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "bucket", "upto").parquet(f"{self.path}/snapshot")
        self._discard(spark, upto)
        return touched

    def _discard(self, spark: SparkSession, upto: int) -> None:
        """Remove what the compaction before this one had replaced; nobody has planned on it since.

        By then every change up to it was in a snapshot of its bucket.
        """
        known: dict[int, list[int]] = {}
        for place in matching_paths(spark, f"{self.path}/snapshot/bucket=*/upto=*"):
            n = _numbers(place)
            known.setdefault(n["bucket"], []).append(n["upto"])
        before = max((n for numbers in known.values() for n in numbers if n < upto), default=-1)
        for bucket, numbers in known.items():
            kept = max((n for n in numbers if n <= before), default=-1)
            for n in numbers:
                if n < kept:
                    remove_folder(spark, f"{self.path}/snapshot/bucket={bucket}/upto={n}")
        for place in matching_paths(spark, f"{self.path}/changes/batch_id=*"):
            if _numbers(place)["batch_id"] <= before:
                remove_folder(spark, place)

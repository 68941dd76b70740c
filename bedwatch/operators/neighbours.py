"""Each row beside the one before and the one after it of the same key, without gathering a key's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from bedwatch.session import stage

#: number of the range partition a row lies in
PART = "_part"


def in_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """``rows`` range-partitioned by key and order, with their partition's number, and stored.

    A key of any size is spread over as many partitions as its rows fill. The rows are stored because
    everything derived from them has to see the same borders, even if a lost executor makes Spark sample them anew.
    """
    ranged = rows.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
    return stage(ranged.withColumn(PART, F.spark_partition_id()), label)


def edges(rows: DataFrame, keys: Sequence[str], order: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """One row per key and partition: its first and last row, the last one before (``before``) and the first one after (``after``).

    Combined before the shuffle; a key has at most as many of them as there are partitions.
    """
    row = F.struct(*order, *[c for c in carried if c not in order])
    ends = rows.groupBy(*keys, PART).agg(F.min(row).alias("first"), F.max(row).alias("last"))
    across = Window.partitionBy(*keys).orderBy(PART)
    return ends.withColumns({"before": F.lag("last").over(across), "after": F.lead("first").over(across)})


def with_neighbours(rows: DataFrame, keys: Sequence[str], order: Sequence[str], carried: Sequence[str],
                    label: str = "in-ranges") -> DataFrame:
    """``rows`` with ``before`` and ``after``, structs of order and carried columns; null at a key's ends.

    Neighbours inside a partition are compared there; only the first and last row per partition and key are put in
    order to look across the borders. Rows equal in order are put in order by the carried columns. Keys
    and order must not be null.
    """
    known = in_ranges(rows, keys, order, label)
    row = F.struct(*order, *[c for c in carried if c not in order])
    borders = edges(known, keys, order, carried).select(
        *[F.col(k).alias(f"_edge_{k}") for k in keys], F.col(PART).alias("_edge_part"), F.col("before").alias("_before"),
        F.col("after").alias("_after"))
    inside = Window.partitionBy(*keys, PART).orderBy(row)
    near = known.withColumns({"before": F.lag(row).over(inside), "after": F.lead(row).over(inside)})
    same = F.col(PART) == F.col("_edge_part")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_edge_{k}"))
    return near.join(borders, same).withColumns({
        "before": F.coalesce("before", "_before"), "after": F.coalesce("after", "_after"),
    }).drop("_before", "_after", "_edge_part", *[f"_edge_{k}" for k in keys])

"""State changes: readings whose condition differs from the patient's previous reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bedwatch.session import stage

ORDER = ("patient_id", "event_time", "event_id")


def state_changes(readings: DataFrame) -> DataFrame:
    """Readings whose condition differs from the one before; the first reading is no change.

    All rows are range partitioned by patient, time and id, so a patient of any
    size is spread over as many partitions as their rows fill, down to rows of one
    microsecond. Neighbours inside a partition are compared there; each partition
    then gives only its first and last reading per patient, and these few are put
    in order to compare across the boundaries. One way for every size.

    The sorted rows are stored with their partition number first: both branches have
    to see the same boundaries, even if a lost executor makes Spark sample them anew.
    """
    rows = readings.select(*ORDER, "condition").repartitionByRange(*[F.col(c) for c in ORDER])
    rows = stage(rows.withColumn("_part", F.spark_partition_id()), "ordered-readings")
    part = ["patient_id", "_part"]
    inside = Window.partitionBy(*part).orderBy("event_time", "event_id")
    within = rows.withColumns({
        "previous": F.lag("condition").over(inside), "_first": F.row_number().over(inside) == 1,
    }).filter(~F.col("_first") & ~F.col("condition").eqNullSafe(F.col("previous")))

    edge = F.struct("event_time", "event_id", "condition")
    edges = rows.groupBy(*part).agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    across = Window.partitionBy("patient_id").orderBy("_part")
    between = (
        edges.withColumn("_before", F.lag("last").over(across))
        .filter(F.col("_before").isNotNull()
                & ~F.col("first.condition").eqNullSafe(F.col("_before.condition")))
        .select("patient_id", "first.*", F.col("_before.condition").alias("previous"))
    )
    columns = ["patient_id", "event_id", "event_time", "previous", "condition"]
    return within.select(*columns).unionByName(between.select(*columns))

"""The patients dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

PATIENT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("ward", T.StringType()),
    T.StructField("bed_number", T.StringType()),
    T.StructField("admitted_at", T.TimestampType()),
])


def read_patients(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PATIENT_SCHEMA).parquet(path)


def insert_absent(existing: DataFrame, seed: DataFrame, key: str = "patient_id") -> DataFrame:
    """Existing rows unchanged, plus seed rows whose key is new."""
    new = seed.dropDuplicates([key]).join(existing, key, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)

"""Bedside readings: stream payloads, archive scans, cleaning and de-duplication."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bedwatch.config import VITALS

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
    ]
    + [T.StructField(v, T.DoubleType()) for v in VITALS]
    + [
        T.StructField("timestamp", T.StringType()),
        T.StructField("is_abnormal", T.BooleanType()),
        T.StructField("condition", T.StringType()),
    ]
)

ARCHIVE_SCHEMA = (
    T.StructType(list(PAYLOAD_SCHEMA.fields))
    .add("event_time", T.TimestampType())
    .add("event_date", T.DateType())
)

_CORRUPT = "_malformed"


def kafka_readings(spark: SparkSession, servers: str, topic: str,
                   starting_offsets: str = "latest", **options) -> DataFrame:
    """Raw topic as a stream; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    return reader.options(**options).load()


def parse_payload(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON payload to typed columns plus ``event_time``. Works on batches and streams.

    Unparseable JSON or timestamps give nulls, NaN vitals become null, and the
    raw text of malformed records stays in ``_malformed`` for the quarantine.
    The outer generator parses each message once: filters on the parsed columns
    would otherwise be pushed below the projection and parse it again.
    """
    schema = T.StructType(PAYLOAD_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = raw.select(
        F.inline_outer(F.array(F.from_json(F.col(value).cast("string"), schema, options))))
    return clean_vitals(parsed).withColumn("event_time", F.try_to_timestamp("timestamp"))


def clean_vitals(readings: DataFrame) -> DataFrame:
    return readings.withColumns({
        v: F.when(~F.isnan(v), F.col(v)) for v in VITALS if v in readings.columns
    })


def _usable():
    return F.col("patient_id").isNotNull() & F.col("event_time").isNotNull()


def valid_readings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(_usable()).drop(_CORRUPT)


def quarantined_readings(parsed: DataFrame) -> DataFrame:
    """The records ``valid_readings`` leaves out, with the reason."""
    reason = (
        F.when(F.col(_CORRUPT).isNotNull() & F.col("patient_id").isNull(), F.lit("malformed_json"))
        .when(F.col("patient_id").isNull(), F.lit("missing_patient"))
        .otherwise(F.lit("bad_timestamp"))
    )
    return parsed.filter(~_usable()).withColumn("reject_reason", reason)


def dedupe_readings(readings: DataFrame, *within: str) -> DataFrame:
    """One row per event_id (and ``within`` columns); readings without an id are all kept.

    One pass: a reading without an id gets a number of its own beside the null, so that it
    equals no other and null ids spread over all tasks. Identical copies combine before
    the shuffle, so a heavily replayed id does not pile up in one task either.
    """
    own = F.when(F.col("event_id").isNull(), F.monotonically_increasing_id())
    return readings.withColumn("_own", own).dropDuplicates(["event_id", "_own", *within]).drop("_own")


def scan_archive(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Raw archive for ``[start, end)``; a path that does not exist yet is an empty archive.

    The date predicate prunes partitions, the time predicate is exact; neither
    can be derived from the other by the optimizer, so both are written.
    """
    try:
        archive = spark.read.schema(ARCHIVE_SCHEMA).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        archive = spark.createDataFrame([], ARCHIVE_SCHEMA)
    if start is not None:
        archive = archive.filter(
            (F.col("event_date") >= F.to_date(F.lit(start))) & (F.col("event_time") >= F.lit(start)))
    if end is not None:
        archive = archive.filter(
            (F.col("event_date") <= F.to_date(F.lit(end))) & (F.col("event_time") < F.lit(end)))
    return archive

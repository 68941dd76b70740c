"""Daily lab panels: nested report files, flattening, rejects, flag audit, periods."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bedwatch.config import DEFAULTS, LAB_FILE_FORMAT, LAB_NAME_PATTERN, LAB_PATH_PATTERN, Settings
from bedwatch.session import matching_names

TEST_SCHEMA = T.StructType([
    T.StructField("test_type", T.StringType()),
    T.StructField("result_value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("reference_min", T.DoubleType()),
    T.StructField("reference_max", T.DoubleType()),
    T.StructField("reference_range", T.StringType()),
    T.StructField("is_abnormal", T.BooleanType()),
])

REPORT_SCHEMA = T.StructType([
    T.StructField("report_id", T.StringType()),
    T.StructField("patient_id", T.StringType()),
    T.StructField("simulated_day", T.IntegerType()),
    T.StructField("collected_at", T.StringType()),
    T.StructField("tests", T.ArrayType(TEST_SCHEMA)),
])


def _file_day() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), LAB_PATH_PATTERN, 1).cast("int")


def lab_file_path(folder: str, day: int) -> str:
    """A day's reports as one JSON array."""
    return f"{folder}/{LAB_FILE_FORMAT % day}"


def lab_lines_path(folder: str, day: int) -> str:
    """A day's reports as a folder of JSON lines, which any number of tasks can read."""
    return f"{lab_file_path(folder, day)}l"


def read_lab_files(spark: SparkSession, folder: str, days: list[int] | None = None) -> DataFrame:
    """All reports of the given days (or of every file), array files and folders of lines alike.

    The day comes from the path, never from the record. ``report_seq``
    grows in file order, so that within a day the later duplicate can win. A
    day that has neither form is an error. An array file is one task and has to fit
    in it; large days come as lines.
    """
    names = matching_names(spark, folder, "lab_results_day_*")
    if days:
        missing = [d for d in days if not {LAB_FILE_FORMAT % d, f"{LAB_FILE_FORMAT % d}l"} & names]
        if missing:
            raise FileNotFoundError(f"PATH_NOT_FOUND: no lab results of days {missing} in {folder}")
        names &= {n for d in days for n in (LAB_FILE_FORMAT % d, f"{LAB_FILE_FORMAT % d}l")}
    arrays = sorted(f"{folder}/{n}" for n in names if n.endswith(".json"))
    lines = sorted(f"{folder}/{n}" for n in names if n.endswith(".jsonl"))
    found = spark.createDataFrame([], REPORT_SCHEMA).withColumn("report_seq", F.lit(0).cast("long"))
    for paths, multi in ((arrays, True), (lines, False)):
        if paths:
            read = spark.read.schema(REPORT_SCHEMA).option("multiLine", multi).json(paths)
            found = found.unionByName(read.withColumns({
                "simulated_day": _file_day(), "report_seq": F.monotonically_increasing_id()}))
    return found


def available_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days that have a lab file or folder, from the names alone (no file is opened)."""
    days = {int(m[1]) for n in matching_names(spark, folder, "lab_results_day_*")
            if (m := re.fullmatch(LAB_NAME_PATTERN, n))}
    return spark.createDataFrame([(d,) for d in sorted(days)], "simulated_day int")


def _report_reason() -> Column:
    return (
        F.when(F.coalesce(F.col("patient_id").cast("string"), F.lit("")) == "", F.lit("missing_patient"))
        .when(F.coalesce(F.col("collected_at").cast("string"), F.lit("")) == "", F.lit("missing_collected_at"))
        .when(F.col("collected_ts").isNull(), F.lit("bad_collected_at"))
    )


def with_time(reports: DataFrame) -> DataFrame:
    """Reports with their time as ``collected_ts``, read from the text once; null where it is none."""
    if "collected_ts" in reports.columns:
        return reports
    is_text = isinstance(reports.schema["collected_at"].dataType, T.StringType)
    ts = F.try_to_timestamp("collected_at") if is_text else F.col("collected_at").cast("timestamp")
    return reports.withColumn("collected_ts", ts)


def _exploded(reports: DataFrame) -> DataFrame:
    # The outer form keeps the optimizer from adding a "size(tests) > 0" filter, which would
    # compute a derived array twice; reports without tests drop out on the missing position.
    carried = [c for c in reports.columns if c not in ("tests", "collected_at", "collected_ts")]
    tests = (
        with_time(reports).filter(_report_reason().isNull())
        .select(*carried, F.col("collected_ts").alias("collected_at"),
                F.posexplode_outer("tests").alias("test_pos", "test"))
        .filter(F.col("test_pos").isNotNull())
        .select("*", "test.*").drop("test")
    )
    value = F.when(~F.isnan("result_value"), F.col("result_value"))
    return tests.withColumn("result_value", value)


def _test_ok() -> Column:
    return F.col("test_type").isNotNull() & F.col("result_value").isNotNull()


def flatten_reports(reports: DataFrame) -> DataFrame:
    """One row per usable test; a missing abnormal flag counts as normal."""
    return _exploded(reports).filter(_test_ok()).withColumn(
        "is_abnormal", F.coalesce("is_abnormal", F.lit(False)))


def rejected_reports(reports: DataFrame) -> DataFrame:
    """One row per unusable report or test with the reason (quarantine).

    One pass over the tests: a report that is unusable as a whole is told at its first test, or where it has none.
    """
    at, test = F.col("_pos"), F.col("_test")
    own, test_reason = F.col("_reason").isNotNull(), (
        F.when(at.isNull(), F.lit(None))
        .when(test["test_type"].isNull(), F.lit("missing_test_type"))
        .when(test["result_value"].isNull() | F.isnan(test["result_value"]), F.lit("missing_value")))
    reason = F.when(own, F.when(at.isNull() | (at == 0), F.col("_reason"))).otherwise(test_reason)
    return with_time(reports).withColumn("_reason", _report_reason()).select(
        "report_id", "simulated_day", "_reason", F.posexplode_outer("tests").alias("_pos", "_test")
    ).select("report_id", "simulated_day", F.when(~own, at).alias("test_pos"), reason.alias("reject_reason")).filter(
        F.col("reject_reason").isNotNull())


def without_bounds(labs: DataFrame) -> DataFrame:
    """Usable tests that cannot be scored because a reference bound is missing."""
    return labs.filter(F.col("reference_min").isNull() | F.col("reference_max").isNull())


def lab_periods(reports: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The vitals period of each day: it ends at the day's last collection time.

    Every valid report counts, even when all of its tests are rejected; a day
    without a valid report has no period.
    """
    length = F.make_dt_interval(secs=F.lit(cfg.period_seconds))
    return (
        with_time(reports).filter(_report_reason().isNull())
        .groupBy("simulated_day")
        .agg(F.max("collected_ts").alias("period_end"), F.count("*").alias("reports"))
        .withColumns({
            "period_start": F.col("period_end") - length,
            "report_date": F.to_date("period_end"),
        })
    )


def audit_flags(labs: DataFrame) -> DataFrame:
    """Supplied abnormal flags checked against the reference range, bounds included as normal."""
    derived = (F.col("result_value") < F.col("reference_min")) | (
        F.col("result_value") > F.col("reference_max"))
    return labs.withColumns({
        "derived_abnormal": derived,
        "reference_range": F.concat_ws("-", F.col("reference_min").cast("string"),
                                       F.col("reference_max").cast("string")),
        "flag_matches": derived.eqNullSafe(F.col("is_abnormal")),
    })

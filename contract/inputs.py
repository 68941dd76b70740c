"""The given test tables read as readings, lab reports, patients and metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from bedwatch.config import DEFAULTS, LAB_PANEL, VITALS
from bedwatch.operators.features import assign_aligned_day, daily_features
from bedwatch.operators.panel import latest_labs, panel_scores
from bedwatch.operators.risk import score_patients
from bedwatch.operators.rules import Grid
from bedwatch.operators.windows import window_aggregates
from bedwatch.sources.labs import flatten_reports
from bedwatch.session import new_folder
from bedwatch.sources.readings import dedupe_readings

DAY = 86_400
ORIGIN = "2024-01-01 00:00:00"
AS_OF = "2024-01-31 00:00:00"

# Readings of the test tables are hours apart, so durations and trend limits are days, not seconds.
CFG = DEFAULTS.with_(
    period_seconds=5 * DAY, window="1 day", watermark="1 day", slope_unit_seconds=float(DAY),
    hr_rise_limit=5.0, spo2_fall_limit=-1.0, live_hr_rise_limit=6.0, live_spo2_fall_limit=-1.0,
    cooldown_seconds=2 * DAY, stale_after_seconds=DAY // 2, min_records_per_second=0.0039,
    state_buckets=4,
)


HOUR = 3_600
#: conditions are looked at every hour; limits and holds are hours as well
GRID = Grid(datetime(2024, 1, 1), datetime(2024, 1, 31), HOUR)
RULES_CFG = CFG.with_(
    freshness_limits=(("vitals_producer", 1_200, "critical"), ("lab_generator", 600, "warning"),
                      ("speed_layer", HOUR, "critical"), ("batch_layer", 2 * HOUR, "warning")),
    patient_age_limit_seconds=2 * DAY,
    rule_holds=(("stale", "vitals_producer", HOUR), ("stale", "lab_generator", 2 * HOUR), ("stale", "speed_layer", 2 * HOUR),
                ("stale", "batch_layer", 0), ("error_rate", "vitals_producer", HOUR),
                ("patient_data_age", "ward", 6 * HOUR), ("open_critical_alerts", "ward", 0)),
    min_records_per_second=0.0002,
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def as_readings(events: DataFrame, *carried) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        F.col("user_id").alias("patient_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("condition"),
        (F.lit(48.0) + F.lit(0.5) * F.col("value")).alias("heart_rate"),
        (F.lit(100.0) - F.lit(0.11) * k).alias("spo2"),
        (F.lit(75.0) + F.lit(0.9) * ((F.col("event_id") * 37) % 125)).alias("systolic_bp"),
        (F.lit(45.0) + F.lit(0.5) * ((F.col("event_id") * 37) % 125)).alias("diastolic_bp"),
        (F.lit(34.9) + F.lit(0.04) * ((F.col("event_id") * 53) % 100)).alias("temperature"),
        *carried,
    )


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return as_readings(table(spark, sf, "events"))


def as_payload(events: DataFrame) -> DataFrame:
    """Readings as JSON messages; one event type arrives damaged in four ways."""
    rows = as_readings(events, F.get_json_object("props", "$.k").cast("int").alias("k"))
    error = F.col("condition") == "error"
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    json = F.to_json(F.struct(
        F.when(~(error & (F.col("k") >= 75)), F.col("event_id").cast("string")).alias("event_id"),
        F.when(~(error & F.col("k").between(25, 49)), F.col("patient_id").cast("string")).alias("patient_id"),
        *VITALS,
        F.when(error & F.col("k").between(50, 74), F.lit("not a time")).otherwise(time).alias("timestamp"),
        "condition",
    ))
    cut = F.expr("left(j, length(j) - 5)")
    return rows.select(json.alias("j"), "condition", "k").select(
        F.when((F.col("condition") == "error") & (F.col("k") < 25), cut).otherwise(F.col("j")).alias("value"))


SLICES = 8
#: a file is read by one task, so a slice has as many files as its rows are worth
ROWS_PER_FILE = 50_000


def bounds_of(df: DataFrame, time: str) -> tuple:
    return tuple(df.agg(F.min(time), F.max(time)).first())


def slice_of(time: str, bounds: tuple):
    """The number of the slice of time a row lies in; slices are equally long, and one if there is only one instant."""
    low, high = bounds
    if low is None or low == high:
        return F.lit(0)
    step = (high - low).total_seconds() * 1e6 / SLICES
    return F.least(F.lit(SLICES - 1), F.floor((F.unix_micros(time) - F.unix_micros(F.lit(low))) / F.lit(step))).cast("int")


def streamed(df: DataFrame, number, label: str, slices: int = SLICES) -> DataFrame:
    """``df`` as a stream that gives one slice per micro-batch, in the order of ``number``; empty slices are batches too.

    Written once by all tasks, a large slice by several, in files of ``ROWS_PER_FILE`` rows at most: a batch of one file would
    be one task, however many rows it has. The file source goes by the time of modification and
    takes a fixed number of files at a time, so the files of a slice get its time, and empty ones up to the same number.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.withColumn("_slice", number).hint("rebalance", "_slice").write.option(
        "maxRecordsPerFile", ROWS_PER_FILE).partitionBy("_slice").parquet(path)
    spark.createDataFrame([], df.schema).coalesce(1).write.parquet(f"{path}-empty")
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    store, conf = folder.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jsc.hadoopConfiguration()
    empty = store.globStatus(hadoop.Path(f"{path}-empty/part-*"))[0].getPath()
    files = {k: [f.getPath() for f in store.globStatus(hadoop.Path(f"{path}/_slice={k}/part-*")) or []] for k in range(slices)}
    most = max(1, *map(len, files.values()))
    for k, own in files.items():
        for n in range(most - len(own)):
            own.append(hadoop.Path(f"{path}/_slice={k}/part-empty-{n}.parquet"))
            hadoop.FileUtil.copy(store, empty, store, own[-1], False, conf)
        for f in own:
            store.setTimes(f, 1_600_000_000_000 + 1_000 * k, -1)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", most).parquet(f"{path}/_slice=*")


def events_in_time(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def stream_of(spark: SparkSession, sf: str) -> DataFrame:
    """The events in time order, in eight micro-batches."""
    rows = events_in_time(spark, sf)
    return streamed(rows, slice_of("ts", bounds_of(rows, "ts")), "stream-input")


UNIQUE_CFG = CFG.with_(watermark="10 days")


def repeated_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Every reading sent twice, the second time with the slice after its own; some have no id and come once."""
    events = events_in_time(spark, sf)
    nameless = F.col("event_id") % 17 == 0
    copies = F.when(nameless, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    rows = as_readings(events).withColumn("_again", F.explode(copies))
    number = (slice_of("event_time", bounds_of(events, "ts")) + F.col("_again")).cast("int")
    sent = rows.withColumn("event_id", F.when(~nameless, F.col("event_id")))
    return streamed(sent, number, "stream-repeated", SLICES + 1).drop("_again")


def held_back(spark: SparkSession, sf: str, time: str = "event_time"):
    """Is a reading one of the first five slices that arrives at the very end, long after its window has closed."""
    number = slice_of(time, bounds_of(events_in_time(spark, sf), "ts"))
    return (F.col("event_id") % 10 == 3) & (number < 5)


def late_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = events_in_time(spark, sf)
    number = F.when(held_back(spark, sf), F.lit(SLICES)).otherwise(slice_of("event_time", bounds_of(events, "ts")))
    return streamed(as_readings(events), number, "stream-late", SLICES + 1)


def lab_reports(spark: SparkSession, sf: str) -> DataFrame:
    """One report per order line; some lack the patient or the time, some carry an unusable test."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_discount",
        "l_returnflag", "l_linestatus")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    kind = F.col("l_linenumber") % len(LAB_PANEL)

    def pick(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), kind + 1)

    low, high = pick([p[1] for p in LAB_PANEL]), pick([p[2] for p in LAB_PANEL])
    value = F.round((low + (high - low) * (F.col("l_quantity") - 5.0) / 37.0).cast("decimal(38,10)"), 2).cast("double")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumns({
        "test_type": pick([p[0] for p in LAB_PANEL]), "low": low, "high": high, "value": value,
    })
    out = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    flag = F.when(F.col("l_tax") >= 0.08, ~out).when(out | (F.col("l_linestatus") == "F"), out)
    test = F.struct(
        "test_type", F.col("value").alias("result_value"), F.col("low").alias("reference_min"),
        F.col("high").alias("reference_max"), flag.alias("is_abnormal"))
    unusable = F.struct(
        F.when(F.col("l_linestatus") == "F", F.col("test_type")).alias("test_type"),
        F.lit(None).cast("double").alias("result_value"), F.col("low").alias("reference_min"),
        F.col("high").alias("reference_max"), F.lit(None).cast("boolean").alias("is_abnormal"))
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("report_id"),
        F.when(~((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A")), F.col("o_custkey")).alias("patient_id"),
        (F.lit(1) + F.col("l_orderkey") % 6).cast("int").alias("simulated_day"),
        F.when(~((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "A")), F.col("o_orderdate"))
        .alias("collected_at"),
        F.when(F.col("l_returnflag") == "R", F.array(test, unusable)).otherwise(F.array(test)).alias("tests"),
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
    )


LATEST = ("collected_at", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "test_pos")


def labs(spark: SparkSession, sf: str) -> DataFrame:
    """Latest usable result per patient, test and day."""
    return latest_labs(flatten_reports(lab_reports(spark, sf)), LATEST)


def patients(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("ward"), F.concat(F.lit("B"), F.col("c_custkey")).alias("bed_number"))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return daily_features(assign_aligned_day(dedupe_readings(readings(spark, sf)), ORIGIN, CFG), CFG)


def risk(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_patients(features(spark, sf), panel_scores(labs(spark, sf), CFG), CFG)
    return scored.withColumn("report_date", F.date_add(F.lit(ORIGIN).cast("date"), F.col("simulated_day") * 5))


def windows(spark: SparkSession, sf: str) -> DataFrame:
    return window_aggregates(readings(spark, sf), CFG)


def counters(spark: SparkSession, sf: str) -> DataFrame:
    """Metric rows as sent by the producers: one count per event, errors counted apart."""
    events = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("recorded_at"), "event_type")
    names = F.when(F.col("event_type") == "error", F.array(F.lit("records_sent"), F.lit("send_errors"))
                   ).otherwise(F.array(F.lit("records_sent")))
    return events.select(
        F.lit("vitals_producer").alias("component"), F.explode(names).alias("metric_name"),
        F.lit(1.0).alias("metric_value"), "recorded_at")


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Running counters per event type, one snapshot per hour with traffic."""
    from pyspark.sql import Window

    hourly = table(spark, sf, "events").groupBy(
        F.col("event_type").alias("metric_name"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("recorded_at"),
    ).agg(F.count("*").alias("n"))
    w = Window.partitionBy("metric_name").orderBy("recorded_at")
    return hourly.select(
        F.lit("vitals_producer").alias("component"), "metric_name",
        F.sum("n").over(w).cast("double").alias("metric_value"), "recorded_at")


def restarting_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """The same counters of processes that are restarted every eight hours: twice inside a day, once at its start."""
    from pyspark.sql import Window

    at = F.col("ts").cast("timestamp")
    hourly = table(spark, sf, "events").groupBy(
        F.col("event_type").alias("metric_name"), F.date_trunc("hour", at).alias("recorded_at")).agg(F.count("*").alias("n"))
    run = F.floor(F.unix_timestamp("recorded_at") / (8 * HOUR))
    w = Window.partitionBy("metric_name", run).orderBy("recorded_at")
    return hourly.select(
        F.lit("vitals_producer").alias("component"), "metric_name",
        F.sum("n").over(w).cast("double").alias("metric_value"), "recorded_at")


def heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    """Event types stand for the components' signs of life; the lab generator is never heard of."""
    component = (
        F.when(F.col("event_type") == "view", F.lit("vitals_producer"))
        .when(F.col("event_type") == "purchase", F.lit("speed_layer"))
        .when(F.col("event_type") == "signup", F.lit("batch_layer"))
    )
    return table(spark, sf, "events").select(
        component.alias("component"), F.col("ts").cast("timestamp").alias("recorded_at")
    ).filter(F.col("component").isNotNull())

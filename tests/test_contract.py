"""Every registered query against its SQL, and against the plan shapes we rely on."""

import os
import re

import pytest
from pyspark.sql import functions as F

import check
from __spark_entry__ import entry, queries
from contract.oracle import ORACLE
from contract.queries import REGISTRY

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


def no_cross_join_and_no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert bad not in plan, plan


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(spark, name):
    ok, note = check.compare(spark, SF, name, no_cross_join_and_no_python)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() > 0


def plan_of(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_flagship_join_adds_no_shuffle(spark):
    """Ids, features, tests and panels shuffle once each; the full outer join reuses two of those."""
    assert plan_of(spark, "daily_risk").count("Exchange hashpartitioning") == 4


def test_per_key_limits_run_before_the_shuffle(spark):
    for name in ("lab_latest", "ews_latest", "live_trend", "patient_vitals", "latest_risk"):
        plan = plan_of(spark, name)
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_scans_read_only_what_is_needed(spark):
    plan = queries()["error_rate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan


def test_report_days_prune_partitions(spark, tmp_path):
    from bedwatch.plans.reports import daily_report
    from contract import inputs as inp

    inp.risk(spark, SF).write.partitionBy("simulated_day").parquet(f"{tmp_path}/risk")
    stored = spark.read.parquet(f"{tmp_path}/risk")
    plan = daily_report(stored, inp.patients(spark, SF), [4])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "simulated_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_one_scan_per_source(spark):
    assert plan_of(spark, "daily_features").count("FileScan parquet") == 1
    assert plan_of(spark, "daily_risk").count("FileScan parquet") == 3


def test_scored_days_add_no_shuffle_on_the_day(spark):
    from bedwatch.plans.daily import score_days
    from contract import inputs as inp
    from contract.inputs import CFG

    readings = inp.readings(spark, SF)
    periods = readings.groupBy(F.lit(1).alias("simulated_day")).agg(
        F.max("event_time").alias("period_end"), F.min("event_time").alias("period_start"))
    plan = score_days(readings, inp.labs(spark, SF), periods, CFG)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(simulated_day#\d+, \d+\)", plan)

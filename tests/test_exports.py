"""Exports."""

from bedwatch.sinks import tables as tb


def test_no_days_to_clear_computes_nothing(spark, folder):
    """Rows whose computation fails are not looked at when there is no day to clear."""
    rows = spark.range(3).selectExpr("cast(raise_error('computed') as int) AS simulated_day")
    tb.clear_days(rows, folder, "simulated_day", (), "day")

"""Values at, just below and just above every limit of the scoring model."""

import pytest
from pyspark.sql import functions as F

from bedwatch.config import DEFAULTS, VITALS
from bedwatch.functions import scoring as sc
from bedwatch.functions.numeric import age_seconds, round_to, whole_units_since
from bedwatch.functions.vitals import breach_candidates, breaches_any, risk_status, vital_status, worst_status

EPS = 1e-6


def evaluate(spark, rows, schema, **columns):
    """Rows of the computed columns, in input order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return df.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()


def test_early_warning_bands(spark):
    cases = {
        "heart_rate": [(40, 3), (40 + EPS, 1), (50, 1), (50 + EPS, 0), (90, 0), (90 + EPS, 1), (110, 1),
                       (110 + EPS, 2), (130, 2), (130 + EPS, 3), (None, 0)],
        "spo2": [(91, 3), (91 + EPS, 2), (93, 2), (93 + EPS, 1), (95, 1), (95 + EPS, 0), (None, 0)],
        "systolic_bp": [(90, 3), (90 + EPS, 2), (100, 2), (100 + EPS, 1), (110, 1), (110 + EPS, 0), (219, 0),
                        (219 + EPS, 3), (None, 0)],
        "temperature": [(35, 3), (35 + EPS, 1), (36, 1), (36 + EPS, 0), (38, 0), (38 + EPS, 1), (39, 1),
                        (39 + EPS, 2), (None, 0)],
    }
    from bedwatch.config import EWS_BANDS
    for vital, table in cases.items():
        rows = evaluate(spark, [(None if v is None else float(v),) for v, _ in table], "v double",
                        points=sc.band_points(F.col("v"), *EWS_BANDS[vital]))
        assert [r.points for r in rows] == [p for _, p in table], vital


def test_early_warning_levels(spark):
    rows = [
        (70.0, 98.0, 120.0, 37.0),   # 0
        (100.0, 94.0, 105.0, 35.5),  # 1+1+1+1 = 4
        (120.0, 94.0, 105.0, 35.5),  # 2+1+1+1 = 5
        (131.0, 98.0, 120.0, 37.0),  # 3 alone
        (131.0, 92.0, 95.0, 37.0),   # 3+2+2 = 7
        (None, None, None, None),
    ]
    c = sc.ews_components(**{v: F.col(v) for v in ("heart_rate", "spo2", "systolic_bp", "temperature")})
    got = evaluate(spark, rows, "heart_rate double, spo2 double, systolic_bp double, temperature double",
                   score=sc.ews_score(c), level=sc.ews_level(c))
    assert [(r.score, r.level) for r in got] == [
        (0, "LOW"), (4, "LOW"), (5, "MEDIUM"), (3, "MEDIUM"), (7, "HIGH"), (0, "LOW")]


def test_vitals_risk(spark):
    rows = [
        (100, 17, 2.0, 0.0, 32.0),       # 17 % and a rising heart rate
        (100, 17, 1.5, -0.3, 17.0),      # limits themselves do not count
        (100, 17, 1.6, -0.31, 47.0),
        (100, 90, 5.0, -5.0, 100.0),     # capped
        (3, 1, None, None, 33.33),
        (0, 0, 9.0, -9.0, 0.0),
    ]
    got = evaluate(spark, rows, "n long, k long, hr double, s double, want double",
                   got=sc.vitals_risk(F.col("n"), F.col("k"), F.col("hr"), F.col("s")), want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]


def test_lab_severity_and_panel(spark):
    rows = [
        (70.0, 70.0, 100.0, 0.0), (100.0, 70.0, 100.0, 0.0), (144.0, 70.0, 100.0, 100.0),
        (100.3, 70.0, 100.0, 50.5), (69.0, 70.0, 100.0, 51.67), (130.0, 70.0, 100.0, 100.0),
        (5.0, 4.0, 4.0, 100.0), (5.0, None, 4.0, 0.0), (5.0, 4.0, None, 0.0),
    ]
    got = evaluate(spark, rows, "v double, lo double, hi double, want double",
                   got=sc.lab_severity(F.col("v"), F.col("lo"), F.col("hi")), want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]
    panels = [(0.0, 0, 0.0), (51.67, 1, 51.67), (51.67, 3, 71.67), (95.0, 2, 100.0)]
    got = evaluate(spark, panels, "m double, n long, want double",
                   got=sc.panel_risk(F.col("m"), F.col("n")), want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]


def test_combined_level_and_worked_example(spark):
    got = evaluate(spark, [(32.0, 100.0)], "v double, l double", s=sc.combined_risk(F.col("v"), F.col("l")),
                   level=sc.risk_level(sc.combined_risk(F.col("v"), F.col("l"))))[0]
    assert (got.s, got.level) == (59.2, "HIGH")
    edges = [(24.99, "LOW"), (25.0, "MODERATE"), (49.99, "MODERATE"), (50.0, "HIGH"), (74.99, "HIGH"), (75.0, "CRITICAL")]
    got = evaluate(spark, edges, "s double, want string", got=sc.risk_level(F.col("s")), want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]


def test_outlook_takes_the_worse(spark):
    rows = [("LOW", None, "LOW"), ("LOW", "MODERATE", "MODERATE"), ("MEDIUM", "MODERATE", "HIGH"),
            ("MEDIUM", "CRITICAL", "CRITICAL"), ("HIGH", "LOW", "CRITICAL"), ("MEDIUM", None, "HIGH")]
    got = evaluate(spark, rows, "e string, d string, want string", got=sc.outlook(F.col("e"), F.col("d")),
                   want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]


def test_direction(spark):
    rows = [(None, "new"), (5.0, "worsening"), (4.999, "stable"), (-5.0, "improving"), (-4.999, "stable")]
    got = evaluate(spark, rows, "c double, want string", got=sc.direction(F.col("c")), want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]


@pytest.mark.parametrize("vital,low,high", [
    ("heart_rate", 50.0, 120.0), ("spo2", 90.0, None), ("systolic_bp", 80.0, 180.0),
    ("temperature", 35.0, 38.5), ("diastolic_bp", None, None)])
def test_breach_limits_are_strict(spark, vital, low, high):
    calm = {"heart_rate": 80.0, "spo2": 97.0, "systolic_bp": 120.0, "diastolic_bp": 70.0, "temperature": 36.8}
    values = [(v, False) for v in (low, high) if v is not None]
    values += [(low - EPS, True)] if low is not None else [(-1000.0, vital != "diastolic_bp" and low is not None)]
    values += [(high + EPS, True)] if high is not None else [(1000.0, False)]
    values.append((None, False))
    rows = [tuple(v if name == vital else calm[name] for name in VITALS) + (want,) for v, want in values]
    schema = ", ".join(f"{v} double" for v in VITALS) + ", want boolean"
    got = evaluate(spark, rows, schema, got=breaches_any(), n=F.size(F.array_compact(breach_candidates())), want=F.col("want"))
    assert [(r.got, r.n == 1) for r in got] == [(r.want, r.want) for r in got]


def test_vital_status(spark):
    rows = [(60.0, "normal"), (100.0, "normal"), (100.0 + EPS, "watch"), (59.9, "watch"), (120.0, "watch"),
            (120.0 + EPS, "critical"), (49.9, "critical"), (None, "watch"), (float("nan"), "watch")]
    got = evaluate(spark, rows, "v double, want string", got=vital_status("heart_rate", F.col("v")), want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]
    low = evaluate(spark, [(20.0,)], "v double", got=vital_status("diastolic_bp", F.col("v")))
    assert low[0].got == "watch"  # diastolic pressure never alerts


def test_statuses_combine(spark):
    rows = [("CRITICAL", "normal", "critical"), ("HIGH", "normal", "watch"), ("MODERATE", "normal", "normal"),
            (None, "watch", "watch"), ("LOW", "critical", "critical")]
    got = evaluate(spark, rows, "l string, o string, want string",
                   got=worst_status(risk_status(F.col("l")), F.col("o")), want=F.col("want"))
    assert [r.got for r in got] == [r.want for r in got]


def test_texts(spark):
    row = evaluate(
        spark, [(100, 17, 2.345, -0.5)], "n long, k long, hr double, s double",
        v=sc.vitals_factors(F.col("n"), F.col("k"), F.col("hr"), F.col("s")),
        lab=sc.lab_factor(F.lit("Glucose"), F.lit(144.0), F.lit(70.0), F.lit(100.0)),
        none=sc.factors_text(F.array().cast("array<string>")),
        both=sc.split_factors(F.lit("a b; c;d")), empty=sc.split_factors(F.lit("None")),
    )[0]
    assert row.v == ["17/100 vital readings breached alert thresholds", "Heart rate rising (+2.35 bpm/min)",
                     "SpO2 falling (-0.50 %/min)"]
    assert row.lab == "Glucose high (144.00, ref: 70.0-100.0)"
    assert row.none == "None" and row.both == ["a b", "c", "d"] and row.empty == []


def test_concerns_use_the_live_limits(spark):
    row = evaluate(
        spark, [("MEDIUM", 5, 3.0, -0.5, 2, 7), ("LOW", 0, 3.1, -0.51, 0, None)],
        "e string, p int, hr double, s double, labs long, d int",
        codes=sc.concern_codes(F.col("e"), F.col("hr"), F.col("s"), F.col("labs")),
        texts=sc.concern_texts(F.col("e"), F.col("p"), F.col("hr"), F.col("s"), F.col("labs"), F.col("d")))
    assert row[0].codes == ["early_warning", "abnormal_labs"]
    assert row[0].texts == ["Early warning score 5 (MEDIUM)", "2 abnormal lab result(s) on day 7"]
    assert row[1].texts == ["Heart rate rising +3.1 bpm/min over last 5 min", "SpO2 falling -0.51 %/min over last 5 min"]


def test_rounding_and_time(spark):
    rows = evaluate(spark, [(1.005,), (0.125,), (-0.305,), (float("nan"),)], "x double", r=round_to(F.col("x"), 2))
    assert [r.r for r in rows] == [1.01, 0.13, -0.31, None]
    row = spark.sql("SELECT timestamp'2024-01-01 00:00:00.900' a, timestamp'2024-01-01 00:01:30.100' b").select(
        whole_units_since(F.col("a"), F.col("b"), 60).alias("minutes"),
        age_seconds(F.col("b"), F.col("a")).alias("floor0"), age_seconds(F.col("a"), F.col("b")).alias("age")).first()
    assert (row.minutes, row.floor0, row.age) == (1.5, 0, 89)


def test_breakdown(spark):
    b = evaluate(spark, [(32.0, 100.0, 59.2, "HIGH")], "v double, l double, c double, lvl string",
                 b=sc.risk_breakdown(F.col("v"), F.col("l"), F.col("c"), F.col("lvl")))[0].b
    assert (b.vitals_part, b.lab_part, b.combined_risk, b.risk_level) == (19.2, 40.0, 59.2, "HIGH")
    assert DEFAULTS.vitals_weight + DEFAULTS.lab_weight == 1.0

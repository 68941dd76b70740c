"""The same results in plain SQL over the given tables, for comparison.

Written independently of the Spark plans: joins where those use windows,
row-level ordering where those use summaries.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _r(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _t(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%g')"


# ---- shared subqueries ---------------------------------------------------

READINGS = """
readings AS (
  SELECT event_id, user_id AS patient_id, ts AS event_time, event_type AS condition, k,
         48e0 + 0.5e0 * value AS heart_rate,
         100e0 - 0.11e0 * k AS spo2,
         75e0 + 0.9e0 * ((event_id * 37) % 125) AS systolic_bp,
         45e0 + 0.5e0 * ((event_id * 37) % 125) AS diastolic_bp,
         34.9e0 + 0.04e0 * ((event_id * 53) % 100) AS temperature
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
)"""

PATIENTS = """
patients AS (
  SELECT c_custkey AS patient_id, c_name AS name, c_mktsegment AS ward, 'B' || c_custkey AS bed FROM customer
)"""

ABNORMAL = """(heart_rate > 120e0 OR heart_rate < 50e0 OR spo2 < 90e0 OR systolic_bp > 180e0 OR systolic_bp < 80e0
  OR temperature > 38.5e0 OR temperature < 35e0)"""

FEATURES = READINGS + f""",
dayed AS (
  SELECT *, 1 + CAST(floor(date_diff('day', DATE '2024-01-01', CAST(event_time AS DATE)) / 5) AS BIGINT) AS simulated_day
  FROM readings
),
timed AS (
  SELECT *, (floor(epoch(event_time)) - epoch(TIMESTAMP '2024-01-01') - (simulated_day - 1) * 432000e0) / 86400e0 AS t
  FROM dayed
),
features AS (
  SELECT patient_id, simulated_day, count(*) AS total,
         CAST(sum(CASE WHEN {ABNORMAL} THEN 1 ELSE 0 END) AS BIGINT) AS abnormal,
         CASE WHEN var_samp(t) > 0 THEN regr_slope(heart_rate, t) END AS hr_trend,
         CASE WHEN var_samp(t) > 0 THEN regr_slope(spo2, t) END AS spo2_trend,
         avg(heart_rate) AS avg_heart_rate, min(spo2) AS min_spo2, max(temperature) AS max_temperature
  FROM timed GROUP BY patient_id, simulated_day
)"""

LABS = """
raw_reports AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, p.*,
         CAST(ROUND(CAST(low + (high - low) * (l_quantity - 5e0) / 37e0 AS DECIMAL(38,10)), 2) AS DOUBLE) AS v
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
  JOIN (VALUES (0, 'WBC', 4e0, 11e0), (1, 'Hemoglobin', 12e0, 17.5e0), (2, 'Glucose', 70e0, 100e0),
               (3, 'Creatinine', 0.6e0, 1.2e0), (4, 'CRP', 0e0, 5e0)) p(kind, test_type, low, high)
    ON kind = l_linenumber % 5
),
reports AS (
  SELECT *, l_orderkey || '-' || l_linenumber AS report_id,
         CASE WHEN NOT (l_linenumber = 7 AND l_returnflag = 'A') THEN o_custkey END AS patient_id,
         CASE WHEN NOT (l_linenumber = 6 AND l_returnflag = 'A') THEN o_orderdate END AS collected_at,
         CAST(1 + l_orderkey % 6 AS BIGINT) AS simulated_day,
         (v < low OR v > high) AS derived_abnormal
  FROM raw_reports
),
flat AS (
  -- Unflagged tests are the normal ones with an open line status; a missing flag counts as normal.
  SELECT *, COALESCE(CASE WHEN l_tax >= 0.08e0 THEN NOT derived_abnormal
                          WHEN derived_abnormal OR l_linestatus = 'F' THEN derived_abnormal END, FALSE) AS is_abnormal
  FROM reports WHERE patient_id IS NOT NULL AND collected_at IS NOT NULL
)"""

LATEST_LABS = LABS + """,
labs AS (
  SELECT *, CASE WHEN v BETWEEN low AND high THEN 0e0
                 ELSE CAST(ROUND(CAST(least(100e0, 50e0 + 50e0 * (CASE WHEN v < low THEN low - v ELSE v - high END)
                                 / greatest(high - low, 1e-9)) AS DECIMAL(38,10)), 2) AS DOUBLE) END AS severity
  FROM (
    SELECT *, row_number() OVER (PARTITION BY patient_id, test_type, simulated_day ORDER BY collected_at DESC,
             l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM flat
  ) WHERE rn = 1
)"""

PANELS = LATEST_LABS + f""",
panels AS (
  SELECT patient_id, simulated_day, max(severity) AS max_severity,
         count(*) FILTER (WHERE severity > 0) AS labs_out_of_range,
         count(*) FILTER (WHERE is_abnormal) AS abnormal_labs_count,
         CASE WHEN count(*) FILTER (WHERE severity > 0) > 0
              THEN {_r("least(max(severity) + 10e0 * (count(*) FILTER (WHERE severity > 0) - 1), 100e0)", 2)}
              ELSE 0e0 END AS lab_risk_score,
         string_agg(CASE WHEN severity > 0 THEN printf('%s %s (%.2f, ref: %s-%s)', test_type,
             CASE WHEN v > high THEN 'high' ELSE 'low' END, v, CAST(low AS VARCHAR), CAST(high AS VARCHAR)) END, '; '
             ORDER BY test_type) AS lab_text
  FROM labs GROUP BY patient_id, simulated_day
)"""

RISK = FEATURES + "," + PANELS + f""",
halves AS (
  SELECT COALESCE(f.patient_id, p.patient_id) AS patient_id, COALESCE(f.simulated_day, p.simulated_day) AS simulated_day,
         COALESCE(total, 0) AS total, COALESCE(abnormal, 0) AS abnormal, hr_trend, spo2_trend,
         COALESCE(lab_risk_score, 0e0) AS lab_risk_score, COALESCE(abnormal_labs_count, 0) AS abnormal_labs_count,
         lab_text,
         CASE WHEN COALESCE(total, 0) > 0 THEN
           {_r('''least(100e0, 100e0 * abnormal / total + CASE WHEN hr_trend > 5 THEN 15e0 ELSE 0e0 END
                 + CASE WHEN spo2_trend < -1 THEN 15e0 ELSE 0e0 END)''', 2)} ELSE 0e0 END AS vitals_risk_score
  FROM features f FULL OUTER JOIN panels p ON f.patient_id = p.patient_id AND f.simulated_day = p.simulated_day
),
combined AS (
  SELECT *, {_r('0.6e0 * vitals_risk_score + 0.4e0 * lab_risk_score', 2)} AS combined_risk_score FROM halves
),
risk AS (
  SELECT patient_id, simulated_day, vitals_risk_score, lab_risk_score, combined_risk_score,
         CASE WHEN combined_risk_score >= 75 THEN 'CRITICAL' WHEN combined_risk_score >= 50 THEN 'HIGH'
              WHEN combined_risk_score >= 25 THEN 'MODERATE' ELSE 'LOW' END AS risk_level,
         abnormal AS abnormal_vitals_count, abnormal_labs_count, total AS readings_analyzed,
         {_r('hr_trend', 4)} AS heart_rate_trend, {_r('spo2_trend', 4)} AS spo2_trend,
         CAST(CAST(DATE '2024-01-01' + INTERVAL 1 DAY * CAST(simulated_day * 5 AS INT) AS DATE) AS VARCHAR) AS report_date,
         COALESCE(NULLIF(concat_ws('; ',
           CASE WHEN total > 0 AND abnormal > 0 THEN abnormal || '/' || total || ' vital readings breached alert thresholds' END,
           CASE WHEN total > 0 AND hr_trend > 5 THEN printf('Heart rate rising (%+.2f bpm/day)', hr_trend) END,
           CASE WHEN total > 0 AND spo2_trend < -1 THEN printf('SpO2 falling (%+.2f %%/day)', spo2_trend) END,
           lab_text), ''), 'None') AS risk_factors,
         (CASE WHEN total > 0 AND abnormal > 0 THEN 1 ELSE 0 END + CASE WHEN total > 0 AND hr_trend > 5 THEN 1 ELSE 0 END
          + CASE WHEN total > 0 AND spo2_trend < -1 THEN 1 ELSE 0 END
          + CASE WHEN lab_text IS NULL THEN 0 ELSE len(string_split(lab_text, '; ')) END) AS n_factors
  FROM combined
),
changed AS (
  SELECT r.*, prev.combined_risk_score AS previous_score,
         r.combined_risk_score - prev.combined_risk_score AS risk_change
  FROM risk r LEFT JOIN risk prev ON prev.patient_id = r.patient_id AND prev.simulated_day = r.simulated_day - 1
),
newest AS (
  SELECT c.* FROM changed c JOIN (SELECT patient_id, max(simulated_day) AS d FROM risk GROUP BY patient_id) m
    ON c.patient_id = m.patient_id AND c.simulated_day = m.d
),""" + PATIENTS + f""",
report AS (
  SELECT c.simulated_day, c.patient_id, name, ward, bed, risk_level, combined_risk_score AS combined_risk,
         {_r('risk_change', 2)} AS risk_change, vitals_risk_score AS vitals_risk, lab_risk_score AS lab_risk,
         abnormal_vitals_count AS abnormal_vitals, abnormal_labs_count AS abnormal_labs, readings_analyzed,
         heart_rate_trend, spo2_trend, risk_factors
  FROM changed c JOIN patients p ON p.patient_id = c.patient_id
),
history AS (
  SELECT r.patient_id, name, r.simulated_day, combined_risk_score AS combined_risk, vitals_risk_score AS vitals_risk,
         lab_risk_score AS lab_risk, risk_level
  FROM risk r JOIN patients p ON p.patient_id = r.patient_id
  WHERE r.simulated_day IN (SELECT DISTINCT simulated_day FROM risk ORDER BY simulated_day DESC LIMIT 4)
),
directions AS (
  SELECT patient_id, name, change, days, scores, CASE WHEN change IS NULL THEN 'new' WHEN change >= 5 THEN 'worsening'
         WHEN change <= -5 THEN 'improving' ELSE 'stable' END AS direction
  FROM (SELECT patient_id, name, count(*) AS days,
               string_agg(CAST(combined_risk AS VARCHAR), '|' ORDER BY simulated_day) AS scores,
               max(combined_risk) FILTER (WHERE rn = 1) - max(combined_risk) FILTER (WHERE rn = 2) AS change
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY simulated_day DESC) AS rn FROM history)
        GROUP BY patient_id, name)
)"""


def _windows(source: str, name: str = "windows") -> str:
    return f"""
{name} AS (
  SELECT patient_id, date_trunc('day', event_time) AS window_start,
         date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end,
         avg(heart_rate) AS avg_heart_rate, avg(spo2) AS avg_spo2, avg(systolic_bp) AS avg_systolic_bp,
         avg(diastolic_bp) AS avg_diastolic_bp, avg(temperature) AS avg_temperature, min(spo2) AS min_spo2,
         max(heart_rate) AS max_heart_rate, count(*) AS reading_count
  FROM {source} GROUP BY patient_id, date_trunc('day', event_time)
)"""


WINDOWS = READINGS + "," + _windows("readings")

WINDOW_COLUMNS = ", ".join(
    [f"{_t(c)} AS {c}" for c in ("window_start", "window_end")]
    + [f"{_r(c, 6)} AS {c}" for c in (
        "avg_heart_rate", "avg_spo2", "avg_systolic_bp", "avg_diastolic_bp", "avg_temperature", "min_spo2",
        "max_heart_rate")]
    + ["reading_count"])

# What is left of the damaged deliveries; ids of a fourth kind of damage are missing.
DELIVERED = READINGS + """,
delivered AS (
  SELECT * EXCLUDE (event_id, patient_id), CAST(patient_id AS VARCHAR) AS patient_id,
         CASE WHEN NOT (condition = 'error' AND k >= 75) THEN CAST(event_id AS VARCHAR) END AS event_id,
         event_id AS original_id
  FROM readings WHERE NOT (condition = 'error' AND k < 75)
)"""

LIVE_PARTS = f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY window_start DESC) AS rn FROM windows),
live AS (
  SELECT patient_id,
         max(avg_heart_rate) FILTER (WHERE rn = 1) AS heart_rate, max(avg_spo2) FILTER (WHERE rn = 1) AS spo2,
         max(avg_systolic_bp) FILTER (WHERE rn = 1) AS systolic_bp,
         max(avg_diastolic_bp) FILTER (WHERE rn = 1) AS diastolic_bp,
         max(avg_temperature) FILTER (WHERE rn = 1) AS temperature, max(window_end) AS last_window_end,
         CASE WHEN count(*) > 1 THEN regr_slope(avg_heart_rate, x) END AS hr_trend,
         CASE WHEN count(*) > 1 THEN regr_slope(avg_spo2, x) END AS spo2_trend
  FROM (SELECT *, epoch(window_start) / 86400e0 AS x FROM ranked WHERE rn <= 10) GROUP BY patient_id
)"""


def _points(table: str, source: str) -> str:
    return f""",
{table}_points AS (
  SELECT *,
    CASE WHEN heart_rate IS NULL THEN 0 WHEN heart_rate <= 40 THEN 3 WHEN heart_rate <= 50 THEN 1
         WHEN heart_rate <= 90 THEN 0 WHEN heart_rate <= 110 THEN 1 WHEN heart_rate <= 130 THEN 2 ELSE 3 END AS heart_rate_points,
    CASE WHEN spo2 IS NULL THEN 0 WHEN spo2 <= 91 THEN 3 WHEN spo2 <= 93 THEN 2 WHEN spo2 <= 95 THEN 1 ELSE 0 END AS spo2_points,
    CASE WHEN systolic_bp IS NULL THEN 0 WHEN systolic_bp <= 90 THEN 3 WHEN systolic_bp <= 100 THEN 2
         WHEN systolic_bp <= 110 THEN 1 WHEN systolic_bp <= 219 THEN 0 ELSE 3 END AS systolic_bp_points,
    CASE WHEN temperature IS NULL THEN 0 WHEN temperature <= 35 THEN 3 WHEN temperature <= 36 THEN 1
         WHEN temperature <= 38 THEN 0 WHEN temperature <= 39 THEN 1 ELSE 2 END AS temperature_points
  FROM {source}
),
{table} AS (
  SELECT *, CASE WHEN early_warning_score >= 7 THEN 'HIGH'
                 WHEN early_warning_score >= 5 OR greatest(heart_rate_points, spo2_points, systolic_bp_points,
                      temperature_points) = 3 THEN 'MEDIUM' ELSE 'LOW' END AS early_warning_level
  FROM (SELECT *, heart_rate_points + spo2_points + systolic_bp_points + temperature_points AS early_warning_score
        FROM {table}_points)
)"""


WARD = (
    RISK + "," + _windows("readings") + LIVE_PARTS + """,
merged AS (
  SELECT p.patient_id, p.name, p.ward, p.bed, l.* EXCLUDE (patient_id),
         n.* EXCLUDE (patient_id, spo2_trend, heart_rate_trend)  -- the live trends are meant
  FROM patients p LEFT JOIN live l ON l.patient_id = p.patient_id LEFT JOIN newest n ON n.patient_id = p.patient_id
)""" + _points("warned", "merged") + """,
ward_view AS (
  SELECT *, CASE greatest(
      CASE early_warning_level WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 0 END,
      CASE risk_level WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MODERATE' THEN 1 ELSE 0 END)
      WHEN 3 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MODERATE' ELSE 'LOW' END AS outlook
  FROM warned
)""")

BREACHES = """
breaches AS (
  SELECT patient_id, event_id, date_trunc('milliseconds', event_time) AS event_time, b.*
  FROM {source}, LATERAL (VALUES
    ('heart_rate', heart_rate, 120e0, heart_rate > 120e0, heart_rate > 150e0),
    ('heart_rate', heart_rate, 50e0, heart_rate < 50e0, heart_rate < 40e0),
    ('spo2', spo2, 90e0, spo2 < 90e0, spo2 < 90e0),
    ('systolic_bp', systolic_bp, 180e0, systolic_bp > 180e0, systolic_bp > 200e0),
    ('systolic_bp', systolic_bp, 80e0, systolic_bp < 80e0, systolic_bp < 70e0),
    ('temperature', temperature, 38.5e0, temperature > 38.5e0, temperature > 39.5e0),
    ('temperature', temperature, 35e0, temperature < 35e0, temperature < 34.5e0)
  ) b(vital_name, vital_value, threshold_value, breached, critical)
  WHERE breached
)"""


# The upper limits are those of 120, 180 and 38.5.
MESSAGE = """printf('%s is %s threshold: value=%.1f, threshold=%.1f', vital_name,
  CASE WHEN threshold_value IN (120e0, 180e0, 38.5e0) THEN 'above' ELSE 'below' END,
  vital_value, threshold_value)"""


def _episodes(source: str = "readings", cut: str = "0") -> str:
    return BREACHES.format(source=source) + f""",
marked AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 2 DAY THEN 0 ELSE 1 END AS starts
  FROM breaches WINDOW w AS (PARTITION BY patient_id, vital_name ORDER BY event_time, event_id)
),
runs AS (
  SELECT *, sum(starts) OVER (PARTITION BY patient_id, vital_name ORDER BY event_time, event_id
                              ROWS UNBOUNDED PRECEDING) AS run FROM marked
),
opened AS (
  SELECT *, min(event_time) OVER (PARTITION BY patient_id, vital_name, run) AS run_start FROM runs
),
parts AS (SELECT *, {cut} AS part FROM opened),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY patient_id, vital_name, run, part ORDER BY event_time, event_id) AS pos,
         row_number() OVER (PARTITION BY patient_id, vital_name, run, part ORDER BY event_time DESC, event_id DESC) AS back
  FROM parts
),
episodes AS (
  SELECT patient_id, vital_name, count(*) AS occurrences,
         CASE WHEN count(*) >= 3 OR bool_or(critical AND pos > 1) THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
         max(vital_value) FILTER (WHERE back = 1) AS vital_value,
         max(threshold_value) FILTER (WHERE pos = 1) AS threshold_value,
         min(event_time) AS triggered_at, max(event_time) AS last_seen_at,
         CAST(max(event_id) FILTER (WHERE back = 1) AS VARCHAR) AS event_id,
         max({MESSAGE}) FILTER (WHERE back = 1) AS message
  FROM placed GROUP BY patient_id, vital_name, run, part
)"""


ALERT_COLUMNS = f"""patient_id, severity, vital_name, {_r('vital_value', 6)} AS vital_value, threshold_value,
  {_t('triggered_at')} AS triggered_at, {_t('last_seen_at')} AS last_seen_at, occurrences, event_id"""

EPISODES = READINGS + "," + _episodes()
# Temperature alerts are acknowledged.
OPEN = EPISODES + ", open_alerts AS (SELECT * FROM episodes WHERE vital_name <> 'temperature')"

AS_OF = "TIMESTAMP '2024-01-31'"


def _status(name: str, low: str, high: str, breach: str) -> str:
    return (f"CASE WHEN {name} IS NULL THEN 'watch' WHEN {breach} THEN 'critical' "
            f"WHEN {name} < {low} OR {name} > {high} THEN 'watch' ELSE 'normal' END AS {name}_status")


STATUSES = {
    "heart_rate": _status("heart_rate", "60e0", "100e0", "heart_rate < 50e0 OR heart_rate > 120e0"),
    "spo2": _status("spo2", "95e0", "100e0", "spo2 < 90e0"),
    "systolic_bp": _status("systolic_bp", "90e0", "140e0", "systolic_bp < 80e0 OR systolic_bp > 180e0"),
    "diastolic_bp": _status("diastolic_bp", "60e0", "90e0", "FALSE"),
    "temperature": _status("temperature", "36.1e0", "37.2e0", "temperature < 35e0 OR temperature > 38.5e0"),
}

# ---- readings ------------------------------------------------------------

VITAL_COLUMNS = ", ".join(
    f"{_r(v, 6)} AS {v}" for v in ("heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature"))

ORACLE["readings_clean"] = f"""WITH {DELIVERED}
SELECT event_id, patient_id, condition, {_t('event_time')} AS event_time, {VITAL_COLUMNS}
FROM (SELECT * FROM delivered UNION ALL SELECT * FROM delivered WHERE event_id IS NULL)"""

ORACLE["readings_quarantine"] = f"""WITH {READINGS}
SELECT CASE WHEN k < 25 THEN 'malformed_json' WHEN k < 50 THEN 'missing_patient' ELSE 'bad_timestamp' END AS reject_reason,
       2 * count(*) AS records
FROM readings WHERE condition = 'error' AND k < 75 GROUP BY 1"""

ORACLE["breach_flags"] = f"""WITH {READINGS}
SELECT event_id, patient_id, {ABNORMAL} AS abnormal, {", ".join(STATUSES.values())} FROM readings"""

ORACLE["breach_events"] = f"""WITH {READINGS}, {BREACHES.format(source='readings')}
SELECT event_id, patient_id, vital_name, {_r('vital_value', 6)} AS vital_value, threshold_value,
       CASE WHEN critical THEN 'CRITICAL' ELSE 'WARNING' END AS severity, {_t('event_time')} AS event_time,
       {MESSAGE} AS message FROM breaches"""

ORACLE["breach_collapse"] = f"""WITH {READINGS}, {BREACHES.format(source='readings')},
ordered AS (
  SELECT *, count(*) OVER k AS occurrences, bool_or(critical) OVER k AS any_critical,
         row_number() OVER (k ORDER BY event_time, event_id) AS pos,
         row_number() OVER (k ORDER BY critical DESC, event_time DESC, event_id DESC) AS back
  FROM breaches WINDOW k AS (PARTITION BY patient_id, vital_name)
)
SELECT patient_id, vital_name, occurrences, any_critical, event_id, {_r('vital_value', 6)} AS vital_value, threshold_value,
       CASE WHEN critical THEN 'CRITICAL' ELSE 'WARNING' END AS severity, {_t('event_time')} AS event_time
FROM ordered WHERE (any_critical AND back = 1) OR (NOT any_critical AND pos = 1)"""

ORACLE["state_changes"] = f"""WITH {READINGS}
SELECT patient_id, event_id, {_t('event_time')} AS event_time, previous, condition
FROM (SELECT *, lag(condition) OVER (PARTITION BY patient_id ORDER BY event_time, event_id) AS previous FROM readings)
WHERE previous IS NOT NULL AND previous <> condition"""

# ---- windows -------------------------------------------------------------

ORACLE["vitals_windows"] = f"WITH {WINDOWS} SELECT patient_id, {WINDOW_COLUMNS} FROM windows"
ORACLE["window_changelog"] = ORACLE["vitals_windows"]
ORACLE["stream_vitals_windows"] = (
    f"WITH {DELIVERED}, {_windows('delivered')} SELECT patient_id, {WINDOW_COLUMNS} FROM windows")
ORACLE["stream_raw_archive"] = f"""WITH {DELIVERED}
SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, count(*) AS readings, count(event_id) AS with_id
FROM delivered GROUP BY 1"""
ORACLE["patient_vitals"] = f"""WITH {WINDOWS}
SELECT patient_id, {WINDOW_COLUMNS}
FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY window_end DESC) AS rn FROM windows) WHERE rn <= 20"""
ORACLE["ews_latest"] = f"""WITH {WINDOWS} {LIVE_PARTS},
rounded AS (SELECT patient_id, last_window_end, {_r('heart_rate', 6)} AS heart_rate, {_r('spo2', 6)} AS spo2,
  {_r('systolic_bp', 6)} AS systolic_bp, {_r('temperature', 6)} AS temperature FROM live)
{_points('warned', 'rounded')}
SELECT patient_id, {_t('last_window_end')} AS window_end, heart_rate, spo2, systolic_bp, temperature,
       CAST(heart_rate_points AS BIGINT) AS heart_rate_points, CAST(spo2_points AS BIGINT) AS spo2_points,
       CAST(systolic_bp_points AS BIGINT) AS systolic_bp_points, CAST(temperature_points AS BIGINT) AS temperature_points,
       CAST(early_warning_score AS BIGINT) AS early_warning_score, early_warning_level
FROM warned"""
LIVE_COLUMNS = f"""{_r('heart_rate', 6)} AS heart_rate, {_r('spo2', 6)} AS spo2, {_r('systolic_bp', 6)} AS systolic_bp,
       {_r('temperature', 6)} AS temperature, {_r('hr_trend', 5)} AS hr_trend, {_r('spo2_trend', 5)} AS spo2_trend,
       {_t('last_window_end')} AS last_window_end"""
ORACLE["live_trend"] = f"WITH {WINDOWS} {LIVE_PARTS} SELECT patient_id, {LIVE_COLUMNS} FROM live"

# ---- daily job -----------------------------------------------------------

FEATURE_COLUMNS = f"""patient_id, simulated_day, total, abnormal, {_r('hr_trend', 5)} AS hr_trend,
       {_r('spo2_trend', 5)} AS spo2_trend, {_r('avg_heart_rate', 6)} AS avg_heart_rate, {_r('min_spo2', 6)} AS min_spo2,
       {_r('max_temperature', 6)} AS max_temperature"""
ORACLE["daily_features"] = f"WITH {FEATURES} SELECT {FEATURE_COLUMNS} FROM features"
ORACLE["period_features"] = f"""WITH {READINGS},
periods AS (
  SELECT dayofyear(CAST(event_time AS DATE)) AS simulated_day, max(event_time) AS period_end,
         max(event_time) - INTERVAL 2 DAY AS period_start FROM readings GROUP BY 1
),
timed AS (
  SELECT r.*, p.simulated_day, (floor(epoch(event_time)) - floor(epoch(period_start))) / 86400e0 AS t
  FROM readings r JOIN periods p ON event_time >= period_start AND event_time < period_end
),
features AS (
  SELECT patient_id, simulated_day, count(*) AS total,
         CAST(sum(CASE WHEN {ABNORMAL} THEN 1 ELSE 0 END) AS BIGINT) AS abnormal,
         CASE WHEN var_samp(t) > 0 THEN regr_slope(heart_rate, t) END AS hr_trend,
         CASE WHEN var_samp(t) > 0 THEN regr_slope(spo2, t) END AS spo2_trend,
         avg(heart_rate) AS avg_heart_rate, min(spo2) AS min_spo2, max(temperature) AS max_temperature
  FROM timed GROUP BY patient_id, simulated_day
)
SELECT {FEATURE_COLUMNS} FROM features"""

ORACLE["lab_flatten"] = f"""WITH {LABS}
SELECT report_id, patient_id, simulated_day, CAST(0 AS BIGINT) AS test_pos, test_type, v AS result_value,
       low AS reference_min, high AS reference_max, is_abnormal, {_t('collected_at')} AS collected_at,
       {_r('l_extendedprice', 2)} AS l_extendedprice FROM flat"""
ORACLE["lab_rejects"] = f"""WITH {LABS}
SELECT simulated_day, reject_reason, count(*) AS rejected FROM (
  SELECT simulated_day, CASE WHEN patient_id IS NULL THEN 'missing_patient' ELSE 'missing_collected_at' END AS reject_reason
  FROM reports WHERE patient_id IS NULL OR collected_at IS NULL
  UNION ALL
  SELECT simulated_day, CASE WHEN l_linestatus = 'F' THEN 'missing_value' ELSE 'missing_test_type' END
  FROM flat WHERE l_returnflag = 'R'
) GROUP BY ALL"""
ORACLE["lab_periods"] = f"""WITH {LABS}
SELECT simulated_day, {_t("max(collected_at) - INTERVAL 5 DAY")} AS period_start, {_t('max(collected_at)')} AS period_end,
       CAST(CAST(max(collected_at) AS DATE) AS VARCHAR) AS report_date, count(*) AS reports FROM flat GROUP BY simulated_day"""
LAB_COLUMNS = f"""patient_id, test_type, simulated_day, v AS result_value, low AS reference_min, high AS reference_max,
       is_abnormal, {_t('collected_at')} AS collected_at"""
ORACLE["lab_latest"] = f"WITH {LATEST_LABS} SELECT {LAB_COLUMNS} FROM labs"
ORACLE["lab_upsert"] = ORACLE["lab_latest"]
ORACLE["lab_flag_audit"] = f"""WITH {LABS}
SELECT test_type, CAST(low AS VARCHAR) || '-' || CAST(high AS VARCHAR) AS reference_range, is_abnormal, derived_abnormal,
       is_abnormal = derived_abnormal AS flag_matches, count(*) AS tests FROM flat GROUP BY ALL"""
ORACLE["lab_score"] = f"""WITH {PANELS}
SELECT patient_id, simulated_day, max_severity, labs_out_of_range, abnormal_labs_count, lab_risk_score FROM panels"""
ORACLE["lab_severities"] = f"WITH {LATEST_LABS} SELECT patient_id, test_type, simulated_day, severity FROM labs"
ORACLE["patient_labs"] = f"""WITH {LATEST_LABS}
SELECT {LAB_COLUMNS} FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY patient_id
  ORDER BY collected_at DESC, simulated_day DESC, test_type) AS rn FROM labs) WHERE rn <= 20"""

RISK_COLUMNS = """patient_id, simulated_day, report_date, vitals_risk_score, lab_risk_score, combined_risk_score, risk_level,
       abnormal_vitals_count, abnormal_labs_count, readings_analyzed, heart_rate_trend, spo2_trend"""
ORACLE["daily_risk"] = f"WITH {RISK} SELECT {RISK_COLUMNS} FROM risk"
ORACLE["risk_upsert"] = ORACLE["daily_risk"]
ORACLE["risk_factors"] = f"""WITH {RISK}
SELECT patient_id, simulated_day, risk_factors, CAST(n_factors AS BIGINT) AS n_factors FROM risk"""
ORACLE["risk_change"] = f"""WITH {RISK} SELECT patient_id, simulated_day, combined_risk_score, previous_score,
       {_r('risk_change', 4)} AS risk_change FROM changed"""
ORACLE["latest_risk"] = f"""WITH {RISK} SELECT patient_id, simulated_day, combined_risk_score, risk_level,
       {_r('risk_change', 4)} AS risk_change FROM newest"""
ORACLE["risk_breakdown"] = f"""WITH {RISK}
SELECT patient_id, simulated_day, vitals_risk_score AS vitals_risk, {_r('vitals_risk_score * 0.6e0', 1)} AS vitals_part,
       lab_risk_score AS lab_risk, {_r('lab_risk_score * 0.4e0', 1)} AS lab_part,
       {_r('combined_risk_score', 1)} AS combined_risk, risk_level FROM risk"""
ORACLE["pending_days"] = f"""WITH {FEATURES}, {LABS}
SELECT DISTINCT simulated_day FROM reports
WHERE simulated_day NOT IN (SELECT simulated_day FROM dayed WHERE event_time < TIMESTAMP '2024-01-11')
ORDER BY simulated_day LIMIT 3"""
ORACLE["run_totals"] = f"""WITH {RISK}
SELECT 'batch_layer' AS component, 'raw_readings_processed' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM readings
UNION ALL SELECT 'batch_layer', 'lab_records_ingested', CAST(count(*) AS DOUBLE) FROM labs
UNION ALL SELECT 'batch_layer', 'risk_reports_written', CAST(count(*) AS DOUBLE) FROM risk
UNION ALL SELECT 'batch_layer', 'last_simulated_day', CAST(max(simulated_day) AS DOUBLE) FROM risk"""
ORACLE["patients_insert_absent"] = f"""WITH {PATIENTS}
SELECT patient_id, name, ward, bed AS bed_number FROM patients
UNION ALL SELECT DISTINCT s_suppkey + 1000000, s_name, 'General', CAST(NULL AS VARCHAR) FROM supplier"""

# ---- reports -------------------------------------------------------------

ORACLE["daily_report"] = f"WITH {RISK} SELECT * FROM report"
ORACLE["report_csv"] = ORACLE["daily_report"]
ORACLE["latest_report"] = (
    f"WITH {RISK} SELECT * FROM report WHERE simulated_day = (SELECT max(simulated_day) FROM risk)")
ORACLE["report_on_date"] = f"""WITH {RISK} SELECT * FROM report
WHERE simulated_day = (SELECT max(simulated_day) FROM risk WHERE report_date = '2024-01-16')"""
ORACLE["report_summary"] = f"""WITH {RISK}
SELECT simulated_day, CAST(CAST(DATE '2024-01-01' + INTERVAL 1 DAY * CAST(simulated_day * 5 AS INT) AS DATE) AS VARCHAR) AS report_date,
       count(*) AS total_patients, count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_count,
       count(*) FILTER (WHERE risk_level = 'HIGH') AS high_count,
       count(*) FILTER (WHERE risk_level = 'MODERATE') AS moderate_count,
       count(*) FILTER (WHERE risk_level = 'LOW') AS low_count FROM report GROUP BY simulated_day"""
ORACLE["report_documents"] = f"""WITH {RISK}
SELECT simulated_day, row_number() OVER (PARTITION BY simulated_day ORDER BY combined_risk DESC, patient_id) AS position,
       patient_id, combined_risk, risk_level, CAST(NULL AS BIGINT) AS total_patients, CAST(NULL AS BIGINT) AS critical_count
FROM report
UNION ALL
SELECT simulated_day, 0, NULL, NULL, NULL, count(*), count(*) FILTER (WHERE risk_level = 'CRITICAL') FROM report
GROUP BY simulated_day"""
ORACLE["report_json"] = ORACLE["report_documents"]
ORACLE["catch_up_days"] = (f"WITH {RISK} SELECT {RISK_COLUMNS}, CAST(2 AS BIGINT) AS runs FROM risk "
                           "WHERE simulated_day <= 6 AND simulated_day <> 4")
ORACLE["catch_up_reports"] = f"""WITH {RISK}
SELECT simulated_day, 'report' AS kind, count(*) AS rows FROM report WHERE simulated_day <= 6 AND simulated_day <> 4
GROUP BY simulated_day
UNION ALL SELECT 4, 'missing_patient', count(*) FROM labs WHERE simulated_day = 4"""
ORACLE["report_days"] = f"WITH {RISK} SELECT DISTINCT simulated_day, report_date FROM risk"
ORACLE["latest_report_day"] = f"WITH {RISK} SELECT max(simulated_day) AS day FROM risk"
ORACLE["ward_history"] = f"WITH {RISK} SELECT * FROM history"
ORACLE["ward_day_summary"] = f"""WITH {RISK}
SELECT simulated_day, {_r('avg(combined_risk)', 2)} AS avg_risk, count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE risk_level = 'HIGH') AS high, count(*) FILTER (WHERE risk_level = 'MODERATE') AS moderate,
       count(*) FILTER (WHERE risk_level = 'LOW') AS low FROM history GROUP BY simulated_day"""
ORACLE["patient_direction"] = f"""WITH {RISK}
SELECT patient_id, name, {_r('change', 2)} AS latest_change, direction, days, scores FROM directions"""
ORACLE["direction_counts"] = f"WITH {RISK} SELECT direction, count(*) AS patients FROM directions GROUP BY direction"
ORACLE["risk_heatmap"] = f"""WITH {RISK}
SELECT patient_id, name, {", ".join(
    f"max(combined_risk) FILTER (WHERE simulated_day = {d}) AS day_{d}" for d in range(1, 7))}
FROM report GROUP BY patient_id, name"""
ORACLE["patient_risk_history"] = f"""WITH {RISK}
SELECT {RISK_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY simulated_day DESC) AS rn FROM risk)
WHERE rn <= 3"""

# ---- ward ----------------------------------------------------------------

ORACLE["ward_risk"] = f"""WITH {WARD}
SELECT patient_id, name, ward, bed, outlook,
       concat_ws('|', CASE WHEN early_warning_level <> 'LOW' THEN 'early_warning' END,
                 CASE WHEN hr_trend > 6 THEN 'heart_rate_rising' END, CASE WHEN spo2_trend < -1 THEN 'spo2_falling' END,
                 CASE WHEN abnormal_labs_count > 0 THEN 'abnormal_labs' END) AS concern_codes,
       CAST(early_warning_score AS BIGINT) AS early_warning_score, early_warning_level, {LIVE_COLUMNS}, simulated_day,
       risk_level, combined_risk_score, lab_risk_score, vitals_risk_score, {_r('risk_change', 4)} AS risk_change
FROM ward_view"""
ORACLE["ward_concerns"] = f"""WITH {WARD}
SELECT patient_id, CAST(row_number() OVER (PARTITION BY patient_id ORDER BY o) - 1 AS BIGINT) AS position, concern FROM (
  SELECT patient_id, 1 AS o, printf('Early warning score %d (%s)', early_warning_score, early_warning_level) AS concern
  FROM ward_view WHERE early_warning_level <> 'LOW'
  UNION ALL SELECT patient_id, 2, printf('Heart rate rising %+.1f bpm/day over last 10 day', hr_trend) FROM ward_view WHERE hr_trend > 6
  UNION ALL SELECT patient_id, 3, printf('SpO2 falling %+.2f %%/day over last 10 day', spo2_trend) FROM ward_view WHERE spo2_trend < -1
  UNION ALL SELECT patient_id, 4, printf('%d abnormal lab result(s) on day %d', abnormal_labs_count, simulated_day)
  FROM ward_view WHERE abnormal_labs_count > 0)"""
ORACLE["ward_attention"] = f"""WITH {WARD} SELECT patient_id, outlook, CAST(early_warning_score AS BIGINT) AS early_warning_score
FROM ward_view WHERE outlook IN ('HIGH', 'CRITICAL')"""
ORACLE["attention_count"] = f"WITH {WARD} SELECT count(*) AS patients FROM ward_view WHERE outlook IN ('HIGH', 'CRITICAL')"
ORACLE["patient_status"] = f"""WITH {RISK}
SELECT patient_id, simulated_day, risk_level,
       CASE risk_level WHEN 'CRITICAL' THEN 'critical' WHEN 'HIGH' THEN 'watch' ELSE 'normal' END AS overall_status,
       CASE WHEN risk_factors = 'None' THEN '' ELSE replace(risk_factors, '; ', '|') END AS factors FROM newest"""
STATUS = WINDOWS + LIVE_PARTS + "," + PATIENTS + """,
status AS (
  SELECT p.*, heart_rate, spo2, systolic_bp, diastolic_bp, temperature, last_window_end AS last_reading
  FROM patients p LEFT JOIN live l ON l.patient_id = p.patient_id
)"""
ORACLE["ward_status"] = f"""WITH {STATUS}
SELECT patient_id, name, ward, bed, {VITAL_COLUMNS}, {_t('last_reading')} AS last_reading FROM status"""
ORACLE["ward_totals"] = f"""WITH {OPEN}
SELECT 'total_patients' AS name, count(*) AS value FROM customer
UNION ALL SELECT 'active_alerts', count(*) FROM open_alerts"""
# ---- alerts --------------------------------------------------------------

ORACLE["alert_episodes"] = f"WITH {EPISODES} SELECT {ALERT_COLUMNS}, message FROM episodes"
ORACLE["alert_episodes_acked"] = f"""WITH {READINGS}, {_episodes(cut='''CASE WHEN vital_name IN ('spo2', 'heart_rate')
  AND event_time > run_start + INTERVAL 30 HOUR THEN 1 ELSE 0 END''')} SELECT {ALERT_COLUMNS} FROM episodes"""
ORACLE["stream_alert_episodes"] = f"WITH {DELIVERED}, {_episodes('delivered')} SELECT {ALERT_COLUMNS} FROM episodes"
ORACLE["stream_alerts_acked"] = ORACLE["alert_episodes_acked"]
ORACLE["stream_metrics"] = f"""WITH {DELIVERED}, {BREACHES.format(source='delivered')},
sliced AS (SELECT count(*) AS n FROM events),
counted AS (
  SELECT 'raw_archive' AS component, 'raw_records_archived' AS metric_name, (SELECT count(*) FROM delivered) AS n
  UNION ALL SELECT 'vitals_alerts', 'breaches_seen', (SELECT count(*) FROM breaches)
  UNION ALL SELECT 'rejects', 'records_rejected', (SELECT n FROM sliced) - (SELECT count(*) FROM delivered)
  UNION ALL SELECT c, 'rows_read', (SELECT n FROM sliced)
    FROM (VALUES ('raw_archive'), ('vitals_agg'), ('vitals_alerts'), ('rejects')) t(c)
)
SELECT component, metric_name, CAST(n AS DOUBLE) AS metric_value, CAST(8 AS BIGINT) AS batches FROM counted
UNION ALL SELECT c, 'rows_late', 0e0, 0 FROM (VALUES ('raw_archive'), ('vitals_agg'), ('vitals_alerts'), ('rejects')) t(c)"""
ALERT_ORDER = "(severity = 'CRITICAL') DESC, last_seen_at DESC, patient_id, vital_name, triggered_at"
ORACLE["active_alerts"] = (
    f"WITH {OPEN} SELECT {ALERT_COLUMNS} FROM (SELECT * FROM open_alerts ORDER BY {ALERT_ORDER} LIMIT 50)")
ORACLE["critical_alerts"] = f"""WITH {OPEN} SELECT {ALERT_COLUMNS} FROM (
  SELECT * FROM open_alerts WHERE severity = 'CRITICAL' ORDER BY {ALERT_ORDER} LIMIT 5)"""
ORACLE["warning_alerts"] = f"WITH {OPEN} SELECT {ALERT_COLUMNS} FROM open_alerts WHERE severity = 'WARNING'"
ORACLE["alert_counts"] = f"""WITH {OPEN}
SELECT s.severity, count(o.patient_id) AS open_alerts FROM (VALUES ('WARNING'), ('CRITICAL')) s(severity)
LEFT JOIN open_alerts o ON o.severity = s.severity GROUP BY s.severity"""
ORACLE["open_alerts_per_patient"] = f"WITH {OPEN} SELECT patient_id, count(*) AS open_alerts FROM open_alerts GROUP BY patient_id"

# ---- health --------------------------------------------------------------

STALE_PARTS = f"""
seen AS (SELECT p.patient_id, p.name, max(window_end) AS last_seen FROM patients p
         LEFT JOIN windows w ON w.patient_id = p.patient_id GROUP BY p.patient_id, p.name),
stale AS (SELECT * FROM seen WHERE last_seen IS NULL OR last_seen < {AS_OF} - INTERVAL 12 HOUR)"""
STALE = WINDOWS + "," + PATIENTS + "," + STALE_PARTS
ORACLE["stale_patients"] = f"WITH {STALE} SELECT patient_id, name, {_t('last_seen')} AS last_seen FROM stale"
ORACLE["stalest_age"] = f"""WITH {STALE}
SELECT COALESCE(CAST(floor(epoch({AS_OF}) - epoch(min(last_seen))) AS BIGINT), -1) AS age_seconds FROM seen"""
STALE_TEXT = "'No vitals data received for patient ' || patient_id || ' (' || name || ') in the last 43200 seconds.'"
STALENESS = f"""
seen_early AS (SELECT p.patient_id, p.name, max(window_end) AS last_seen FROM patients p
  LEFT JOIN windows w ON w.patient_id = p.patient_id AND window_end <= TIMESTAMP '2024-01-20' GROUP BY p.patient_id, p.name),
early AS (SELECT * FROM seen_early WHERE last_seen IS NULL OR last_seen < TIMESTAMP '2024-01-19 12:00:00'),
staleness AS (
  SELECT CAST(patient_id AS VARCHAR) AS patient_id, 'DATA_STALENESS' AS alert_type, 'WARNING' AS severity, {STALE_TEXT} AS message,
         '2024-01-20 00:00:00.000' AS triggered_at, patient_id NOT IN (SELECT patient_id FROM stale) AS acknowledged FROM early
  UNION ALL
  SELECT CAST(patient_id AS VARCHAR), 'DATA_STALENESS', 'WARNING', {STALE_TEXT}, '2024-01-31 00:00:00.000', FALSE
  FROM stale WHERE patient_id NOT IN (SELECT patient_id FROM early)
)"""
ORACLE["staleness_alerts"] = f"WITH {STALE}, {STALENESS} SELECT * FROM staleness"
ORACLE["ward_overview"] = f"""WITH {RISK}, {_windows('readings')} {LIVE_PARTS}, {_episodes()}, {STALE_PARTS}, {STALENESS},
status AS (
  SELECT p.patient_id, name, heart_rate, spo2, systolic_bp, temperature, last_window_end AS last_reading
  FROM patients p LEFT JOIN live l ON l.patient_id = p.patient_id
),
cards AS (
  SELECT s.*, COALESCE(a.n, 0) AS open_alerts,
         CASE risk_level WHEN 'CRITICAL' THEN 'critical' WHEN 'HIGH' THEN 'watch' ELSE 'normal' END AS risk_status,
         {", ".join(STATUSES[v] for v in ("heart_rate", "spo2", "systolic_bp", "temperature"))}
  FROM status s
  LEFT JOIN (SELECT patient_id, count(*) AS n FROM (
      SELECT CAST(patient_id AS VARCHAR) AS patient_id FROM episodes WHERE vital_name <> 'temperature'
      UNION ALL SELECT patient_id FROM staleness WHERE NOT acknowledged) GROUP BY patient_id) a
    ON a.patient_id = CAST(s.patient_id AS VARCHAR)
  LEFT JOIN (SELECT * EXCLUDE (spo2_trend) FROM risk WHERE simulated_day = (SELECT max(simulated_day) FROM risk)) r
    ON r.patient_id = s.patient_id
)
SELECT patient_id, name, heart_rate_status, spo2_status, systolic_bp_status, temperature_status, risk_status,
       CASE WHEN 'critical' IN (heart_rate_status, spo2_status, systolic_bp_status, temperature_status, risk_status)
                 OR open_alerts > 0 THEN 'critical'
            WHEN 'watch' IN (heart_rate_status, spo2_status, systolic_bp_status, temperature_status, risk_status)
            THEN 'watch' ELSE 'normal' END AS overall_status,
       open_alerts, open_alerts * 10 + CASE risk_status WHEN 'critical' THEN 5 WHEN 'watch' THEN 2 ELSE 0 END AS triage_score,
       CAST(floor(epoch({AS_OF}) - epoch(last_reading)) AS BIGINT) AS age_seconds
FROM cards"""
ORACLE["risk_level_distribution"] = f"""WITH {RISK},
latest AS (SELECT * FROM risk WHERE simulated_day = (SELECT max(simulated_day) FROM risk))
SELECT l.risk_level, count(r.patient_id) AS patients,
       (SELECT COALESCE({_r('avg(combined_risk_score)', 2)}, 0e0) FROM latest) AS avg_combined_risk
FROM (VALUES ('LOW'), ('MODERATE'), ('HIGH'), ('CRITICAL')) l(risk_level) LEFT JOIN latest r ON r.risk_level = l.risk_level
GROUP BY l.risk_level"""
ORACLE["active_patients"] = "SELECT count(*) AS active_patients FROM customer"
ERRORS = "CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE)"
ORACLE["error_rate"] = f"""SELECT {ERRORS} AS errors, CAST(count(*) AS DOUBLE) AS total,
       {_r(f'{ERRORS} / count(*)', 6)} AS error_rate FROM events"""
ORACLE["error_rate_by_day"] = f"""SELECT {_t("date_trunc('day', ts)")} AS window_start, {ERRORS} AS errors,
       CAST(count(*) AS DOUBLE) AS total, {_r(f'{ERRORS} / count(*)', 6)} AS error_rate,
       {_r(f'({ERRORS} / 86400e0) / greatest(count(*) / 86400e0, 0.0039e0)', 6)} AS alarm_rate,
       ({ERRORS} / 86400e0) / greatest(count(*) / 86400e0, 0.0039e0) > 0.05e0 AS exceeded
FROM events GROUP BY date_trunc('day', ts)"""
SNAPSHOTS = """
snapshots AS (
  SELECT event_type AS metric_name, date_trunc('hour', ts) AS recorded_at,
         CAST(sum(count(*)) OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts)) AS DOUBLE) AS metric_value
  FROM events GROUP BY event_type, date_trunc('hour', ts)
)"""
ORACLE["throughput"] = f"""WITH {SNAPSHOTS},
points AS (
  SELECT metric_name, time_bucket(INTERVAL 6 HOUR, recorded_at, TIMESTAMP '1970-01-01') AS window_start,
         max(recorded_at) AS recorded_at, max(metric_value) AS metric_value FROM snapshots GROUP BY ALL
),
steps AS (
  SELECT *, metric_value - lag(metric_value) OVER w AS increase, epoch(recorded_at) - epoch(lag(recorded_at) OVER w) AS elapsed
  FROM points WINDOW w AS (PARTITION BY metric_name ORDER BY window_start)
)
SELECT 'vitals_producer' AS component, metric_name, {_t('window_start')} AS window_start, metric_value, increase,
       {_r('increase / elapsed', 9)} AS rate_per_second FROM steps"""
ORACLE["metric_snapshot"] = f"""WITH {SNAPSHOTS}
SELECT 'vitals_producer' AS component, metric_name, max(metric_value) AS metric_value, {_t('max(recorded_at)')} AS recorded_at
FROM snapshots GROUP BY metric_name"""
ORACLE["freshness"] = f"""
SELECT c.component, CAST(limit_seconds AS BIGINT) AS limit_seconds, severity,
       CAST(floor(epoch({AS_OF}) - epoch(last_seen)) AS BIGINT) AS age_seconds,
       COALESCE(floor(epoch({AS_OF}) - epoch(last_seen)) > limit_seconds, TRUE) AS stale
FROM (VALUES ('vitals_producer', 60, 'critical', 'view'), ('lab_generator', 600, 'warning', NULL),
             ('speed_layer', 90, 'critical', 'purchase'), ('batch_layer', 900, 'warning', 'signup'))
     c(component, limit_seconds, severity, event_type)
LEFT JOIN (SELECT event_type, max(ts) AS last_seen FROM events GROUP BY event_type) e ON e.event_type = c.event_type"""
ORACLE["condition_checks"] = f"""WITH {STALE}, {_episodes()}
SELECT *, value > "limit" AS firing FROM (
  SELECT 'patient_data_age' AS "check", CAST(floor(epoch({AS_OF}) - epoch(min(last_seen))) AS DOUBLE) AS value, 90e0 AS "limit" FROM seen
  UNION ALL
  SELECT 'open_critical_alerts', CAST(count(*) AS DOUBLE), 0e0 FROM episodes WHERE vital_name <> 'temperature' AND severity = 'CRITICAL')"""
SYSTEM_ALERT = """SELECT 'SYSTEM' AS patient_id, 'HIGH_ERROR_RATE' AS alert_type, 'CRITICAL' AS severity,
       printf('Vitals ingestion error rate is %.1f%% (%d/%d), exceeding threshold of %.0f%%.', 100e0 * e / n, e, n, 5e0) AS message
FROM (SELECT count(*) FILTER (WHERE event_type = 'error') AS e, count(*) AS n FROM events) WHERE e / n > 0.05"""
ORACLE["health_alerts"] = f"""WITH {STALE}
SELECT CAST(patient_id AS VARCHAR) AS patient_id, 'DATA_STALENESS' AS alert_type, 'WARNING' AS severity, {STALE_TEXT} AS message FROM stale
UNION ALL {SYSTEM_ALERT}"""
ALL_OPEN = f"""WITH {STALE}, {STALENESS}, {_episodes()},
all_open AS (
  SELECT CAST(patient_id AS VARCHAR) AS patient_id, 'VITAL_THRESHOLD' AS alert_type, severity, message, vital_name,
         {_t('triggered_at')} AS triggered_at FROM episodes WHERE vital_name <> 'temperature'
  UNION ALL SELECT patient_id, alert_type, severity, message, NULL, triggered_at FROM staleness WHERE NOT acknowledged
  UNION ALL SELECT *, NULL, '2024-01-31 00:00:00.000' FROM ({SYSTEM_ALERT})
)"""
ORACLE["all_active_alerts"] = f"{ALL_OPEN} SELECT * FROM all_open"
ORACLE["all_alert_counts"] = f"{ALL_OPEN} SELECT severity, count(*) AS open_alerts FROM all_open GROUP BY severity"
ORACLE["health_summary"] = f"""WITH {STALE}
SELECT *, CASE WHEN value > "limit" THEN 'degraded' ELSE 'healthy' END AS status FROM (
  SELECT 'stale_patients' AS "check", CAST(count(*) AS DOUBLE) AS value, 0e0 AS "limit" FROM stale
  UNION ALL SELECT 'error_rate', {_r(f'{ERRORS} / count(*)', 6)}, 0.05e0 FROM events)"""


# ---- rules with hold times -------------------------------------------------

RULE_STATES = WINDOWS + f""", {_episodes()},
ticks AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 HOUR)) AS moment),
heard AS (
  SELECT moment, component, limit_seconds, max(ts) AS last_seen
  FROM ticks CROSS JOIN (VALUES ('vitals_producer', 1200, 'view'), ('lab_generator', 600, 'none'),
                                ('speed_layer', 3600, 'purchase'), ('batch_layer', 7200, 'signup')) c(component, limit_seconds, event_type)
  LEFT JOIN events e ON e.event_type = c.event_type AND e.ts <= moment GROUP BY ALL
),
hours AS (
  SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (WHERE event_type = 'error') / 3600e0 AS errors, count(*) / 3600e0 AS total
  FROM events GROUP BY 1
),
silences AS (
  SELECT window_end + INTERVAL 2 DAY AS old_at, lead(window_end) OVER (PARTITION BY patient_id ORDER BY window_end) AS next_end FROM windows
),
looked AS (
  SELECT 'stale' AS rule, component AS subject, moment, last_seen IS NULL OR moment - last_seen > to_seconds(limit_seconds) AS active FROM heard
  UNION ALL SELECT 'error_rate', 'vitals_producer', hour + INTERVAL 1 HOUR, errors / greatest(total, 0.0002e0) > 0.05e0 FROM hours
  UNION ALL SELECT 'patient_data_age', 'ward', moment,
    moment IN (SELECT t.moment FROM ticks t JOIN silences s ON t.moment > old_at AND (next_end IS NULL OR t.moment < next_end)) FROM ticks
  UNION ALL SELECT 'open_critical_alerts', 'ward', moment,
    moment IN (SELECT t.moment FROM ticks t JOIN episodes e ON vital_name = 'temperature' AND severity = 'CRITICAL'
           AND t.moment >= triggered_at AND t.moment < last_seen_at + INTERVAL 1 HOUR) FROM ticks
),
sampled AS (
  SELECT *, lag(active) OVER w AS was, lag(moment) OVER w AS before_at, lead(moment) OVER w AS next_at
  FROM looked WHERE moment <= {AS_OF} WINDOW w AS (PARTITION BY rule, subject ORDER BY moment)
),
numbered AS (
  SELECT *, sum(CASE WHEN was AND moment - before_at <= INTERVAL 3 HOUR THEN 0 ELSE 1 END)
              OVER (PARTITION BY rule, subject ORDER BY moment ROWS UNBOUNDED PRECEDING) AS island
  FROM sampled WHERE active
),
begun AS (SELECT *, min(moment) OVER (PARTITION BY rule, subject, island) AS active_at FROM numbered),
islands AS (
  SELECT rule, subject, severity, active_at, min(moment) FILTER (WHERE moment >= active_at + to_hours(hold)) AS fired_at, max(moment) AS last_at,
         arg_max_null(next_at, moment) AS next_at, count(*) AS samples
  FROM begun JOIN (VALUES ('stale', 'vitals_producer', 1, 'critical'), ('stale', 'lab_generator', 2, 'warning'),
                          ('stale', 'speed_layer', 2, 'critical'), ('stale', 'batch_layer', 0, 'warning'),
                          ('error_rate', 'vitals_producer', 1, 'critical'), ('patient_data_age', 'ward', 6, 'critical'),
                          ('open_critical_alerts', 'ward', 0, 'critical')) h(rule, subject, hold, severity) USING (rule, subject)
  GROUP BY rule, subject, severity, active_at
),
ended AS (
  SELECT *, CASE WHEN next_at <= last_at + INTERVAL 3 HOUR THEN next_at
                 WHEN last_at + INTERVAL 3 HOUR < {AS_OF} THEN last_at + INTERVAL 3 HOUR END AS ended_at FROM islands
),
states AS (
  SELECT *, CASE WHEN ended_at IS NULL THEN CASE WHEN fired_at IS NULL THEN 'pending' ELSE 'firing' END
                 WHEN fired_at IS NULL THEN 'dropped' ELSE 'resolved' END AS state FROM ended
)"""
ORACLE["rule_states"] = f"""WITH {RULE_STATES}
SELECT rule, subject, severity, {_t('active_at')} AS active_at, {_t('fired_at')} AS fired_at, {_t('last_at')} AS last_active_at,
       {_t('ended_at')} AS ended_at, samples, state FROM states"""
ORACLE["rule_transitions"] = f"""WITH {RULE_STATES}
SELECT rule, subject, severity, {_t('moment')} AS "at", CAST(step AS BIGINT) AS step, state FROM (
  SELECT rule, subject, severity, active_at AS moment, 0 AS step, 'pending' AS state FROM states
  UNION ALL SELECT rule, subject, severity, fired_at, 1, 'firing' FROM states WHERE fired_at IS NOT NULL
  UNION ALL SELECT rule, subject, severity, ended_at, 2, CASE WHEN fired_at IS NULL THEN 'dropped' ELSE 'resolved' END FROM states
  WHERE ended_at IS NOT NULL)"""


# ---- counters that restart -------------------------------------------------

ORACLE["counter_rates"] = f"""WITH hourly AS (
  SELECT event_type AS metric_name, date_trunc('hour', ts) AS recorded_at, count(*) AS n FROM events GROUP BY 1, 2
),
snapshots AS (
  SELECT metric_name, recorded_at, CAST(sum(n) OVER (PARTITION BY metric_name, floor(epoch(recorded_at) / 28800e0) ORDER BY recorded_at) AS DOUBLE) AS v
  FROM hourly
),
steps AS (
  SELECT *, date_trunc('day', recorded_at) AS day, lag(v) OVER w AS before_v, lag(recorded_at) OVER w AS before_at
  FROM snapshots WINDOW w AS (PARTITION BY metric_name ORDER BY recorded_at)
),
grown AS (
  SELECT *, CASE WHEN v >= before_v THEN v - before_v WHEN before_v IS NOT NULL THEN v END AS step,
         before_at >= day AS inside FROM steps
),
days AS (
  SELECT metric_name, day, count(*) AS samples, count(*) FILTER (WHERE v < before_v) AS restarts,
         COALESCE(sum(step), 0e0) AS increase, sum(step) FILTER (WHERE inside) AS own, arg_min(v, recorded_at) AS first_v,
         epoch(max(recorded_at)) - epoch(min(recorded_at)) AS sampled,
         epoch(min(recorded_at)) - epoch(day) AS head, epoch(day) + 86400 - epoch(max(recorded_at)) AS tail
  FROM grown GROUP BY metric_name, day
),
usual AS (SELECT *, sampled / (samples - 1) AS gap FROM days),
reached AS (
  SELECT *, CASE WHEN head >= 1.1e0 * gap THEN gap / 2 ELSE head END AS to_start, CASE WHEN tail >= 1.1e0 * gap THEN gap / 2 ELSE tail END AS to_end
  FROM usual
)
SELECT 'vitals_producer' AS component, metric_name, {_t('day')} AS window_start, samples, restarts, increase,
       CASE WHEN samples > 1 THEN {_r('''own * (sampled + to_end + CASE WHEN own > 0 AND first_v >= 0 AND sampled * first_v / own < to_start
                                    THEN sampled * first_v / own ELSE to_start END) / sampled / 86400e0''', 9)} END AS rate_per_second
FROM reached"""


# ---- streams with copies and late readings ---------------------------------

ORACLE["stream_windows_deduped"] = ORACLE["vitals_windows"]
ORACLE["stream_late_corrections"] = ORACLE["vitals_windows"]
ORACLE["stream_corrected_features"] = ORACLE["daily_features"]
ORACLE["stream_alerts_deduped"] = f"SELECT * EXCLUDE (event_id, message) FROM ({ORACLE['alert_episodes']})"
ORACLE["stream_late_rows"] = """WITH bounds AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events),
held AS (SELECT e.* FROM events e, bounds WHERE event_id % 10 = 3 AND floor((epoch_us(ts) - low) / ((high - low) / 8)) < 5)
SELECT 'windows dropped as late' AS what, count(DISTINCT (user_id, CAST(ts AS DATE))) AS n FROM held
UNION ALL SELECT 'late readings kept', count(*) FROM held"""


# ---- runs of the daily job, answers to requests ----------------------------

ORACLE["run_days_risk"] = f"WITH {RISK} SELECT {RISK_COLUMNS}, CAST(0 AS BIGINT) AS rejects_left FROM risk WHERE simulated_day <= 3"
ORACLE["catch_up_totals"] = f"""WITH {RISK},
totals AS (
  SELECT 'raw_readings_processed' AS metric_name, CAST(sum(readings_analyzed) AS DOUBLE) AS metric_value FROM risk
  WHERE simulated_day <= 6 AND simulated_day <> 4
  UNION ALL SELECT 'risk_reports_written', CAST(count(*) AS DOUBLE) FROM risk WHERE simulated_day <= 6 AND simulated_day <> 4
  UNION ALL SELECT 'lab_records_ingested', CAST(count(*) AS DOUBLE) FROM labs WHERE simulated_day <> 4
  UNION ALL SELECT 'records_rejected', CAST(count(*) AS DOUBLE) FROM labs WHERE simulated_day = 4
  UNION ALL SELECT 'labs_without_bounds', 0e0
  UNION ALL SELECT 'last_simulated_day', 6e0
)
SELECT 'batch_layer' AS component, metric_name, metric_value, CAST(2 AS BIGINT) AS runs FROM totals"""
ORACLE["acknowledge_answers"] = f"""WITH {EPISODES}
SELECT patient_id, vital_name, {_t('triggered_at')} AS triggered_at,
       CASE WHEN patient_id % 3 = 0 THEN 'not found' ELSE 'acknowledged' END AS status FROM episodes"""
ORACLE["stream_staleness"] = ORACLE["staleness_alerts"]

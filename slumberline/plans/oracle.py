"""The registered queries as plain SQL over the ``events`` table, to check the results against.

The SQL states each result in its own way: the fit is a Newton iteration, the area under the curve a
rank formula, the dense index a global ranking.
"""

from __future__ import annotations

from slumberline.plans import stream_oracle
from slumberline.plans.shared_sql import EVENTS, FEATURES, FIT, SCORED, SPLIT

_STATS = (
    "WITH"
    + EVENTS
    + """
SELECT count(value) AS "Count", round(min(value), 6) AS "Min_Pressure", round(avg(value), 6) AS "Mean_Pressure",
       round(stddev_samp(value), 6) AS "StdDev_Pressure", round(max(value), 6) AS "Max_Pressure"
FROM ev WHERE sensor_id = 'click'"""
)

_HOURS = (
    "WITH"
    + EVENTS
    + """
SELECT hour_of_day, count(*) AS "count" FROM ev
WHERE sensor_id = 'click' AND hour_of_day IS NOT NULL GROUP BY hour_of_day ORDER BY hour_of_day"""
)

_TEST_SCORES = (
    "WITH RECURSIVE" + SCORED + "\nSELECT reg, event_id, label, prediction FROM scored WHERE split = 'test'"
)

_SENSOR_SCORES = (
    "WITH RECURSIVE"
    + SCORED
    + """
SELECT "timestamp" AS "Event_Time_ms", pressure_value, hour_of_day, prediction AS "Is_Sleeping_Prediction"
FROM scored WHERE reg = 0"""
)

_AUC = (
    "WITH RECURSIVE"
    + SCORED
    + """,
steps AS (
  SELECT reg, margin, sum(label) AS p, sum(1 - label) AS n FROM scored WHERE split = 'test' GROUP BY reg, margin
),
ranked AS (
  SELECT reg, p, n, sum(n) OVER (PARTITION BY reg ORDER BY margin) - n AS below FROM steps
)
SELECT reg, round(sum(p * (below + n / 2)) / nullif(sum(p) * sum(n), 0), 4) AS auc FROM ranked GROUP BY reg"""
)

ORACLE_SQL: dict[str, str] = {
    "csv_scan": "WITH" + EVENTS + '\nSELECT event_id, "timestamp", sensor_id, value FROM ev',
    "projected_scan_dropna": "WITH"
    + EVENTS
    + """
SELECT "timestamp", sensor_id, value FROM ev
WHERE "timestamp" IS NOT NULL AND sensor_id IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
  AND event_id % 7 NOT IN (0, 1)""",
    "sensor_filter_eq": "WITH"
    + EVENTS
    + "\nSELECT event_id, \"timestamp\", sensor_id, value FROM ev WHERE sensor_id = 'click'",
    "sensor_filter_in": "WITH"
    + EVENTS
    + "\nSELECT event_id, \"timestamp\", sensor_id, value FROM ev WHERE sensor_id IN ('click', 'view')",
    "hour_features": "WITH"
    + EVENTS
    + """
SELECT event_id, "timestamp", value AS pressure_value, hour_of_day FROM ev WHERE sensor_id = 'click'""",
    "event_clock": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time FROM events",
    "night_pressure_label": "WITH"
    + EVENTS
    + """
SELECT event_id, hour_of_day,
       CASE WHEN value > 25.0 AND (hour_of_day >= 22 OR hour_of_day < 7) THEN CAST(1 AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS label
FROM ev WHERE sensor_id = 'click'""",
    "feature_table": "WITH" + FEATURES + "\nSELECT event_id, pressure_value, hour_of_day, label FROM ft",
    "message_roundtrip": "WITH" + EVENTS + '\nSELECT "timestamp", sensor_id, value FROM ev',
    "replay_messages": "WITH"
    + EVENTS
    + """
SELECT "timestamp", sensor_id, value FROM ev
WHERE sensor_id IN ('click', 'view') AND "timestamp" IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)""",
    "topic_peek": "WITH"
    + EVENTS
    + """
SELECT event_id AS "offset", "timestamp", sensor_id, value FROM ev ORDER BY event_id LIMIT 10""",
    "topic_peek_any": """
WITH first AS (SELECT * FROM events ORDER BY event_id LIMIT 10)
SELECT event_id AS "offset", 'event_id' AS field, 'BIGINT' AS type, CAST(event_id AS DOUBLE) AS number,
       CAST(NULL AS VARCHAR) AS text FROM first
UNION ALL SELECT event_id, 'user_id', 'BIGINT', CAST(user_id AS DOUBLE), NULL FROM first
UNION ALL SELECT event_id, 'value', 'DECIMAL', round(value, 6), NULL FROM first
UNION ALL SELECT event_id, 'kind', 'STRING', NULL, event_type FROM first
UNION ALL SELECT event_id, 'props', 'OBJECT', NULL, replace(props, ' ', '') FROM first""",
    "csv_inferred_schema": """
WITH texts AS (
  SELECT unnest([
    {'column': 'event_id', 'place': 1, 'text': CAST(event_id AS VARCHAR)},
    {'column': 'time', 'place': 2, 'text': strftime(ts, '%Y-%m-%d %H:%M:%S.%g')},
    {'column': 'sensor', 'place': 3, 'text': CASE WHEN event_id % 7 <> 1 THEN event_type END},
    {'column': 'value', 'place': 4, 'text': CASE WHEN event_id % 7 <> 0 THEN CAST(value AS VARCHAR) END},
    {'column': 'user', 'place': 5, 'text': CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END},
    {'column': 'high', 'place': 6, 'text': CAST(value > 25 AS VARCHAR)},
    {'column': 'nothing', 'place': 7, 'text': CAST(NULL AS VARCHAR)}
  ], recursive := true) FROM events
)
SELECT "column",
       CASE WHEN count(text) = 0 THEN 'string'
            WHEN bool_and(text IN ('true', 'false')) THEN 'boolean'
            WHEN bool_and(regexp_full_match(text, '[+-]?[0-9]+')) THEN 'bigint'
            WHEN bool_and(text IS NULL OR TRY_CAST(text AS DOUBLE) IS NOT NULL) THEN 'double'
            WHEN bool_and(text IS NULL OR TRY_CAST(text AS TIMESTAMP) IS NOT NULL) THEN 'timestamp'
            ELSE 'string' END AS type,
       count(*) AS "rows", count(*) - count(text) AS nulls
FROM texts GROUP BY "column" ORDER BY 1""",
    "every_nth_event": "WITH"
    + EVENTS
    + """
SELECT idx, event_id, sensor_id, value
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM ev WHERE sensor_id IN ('click', 'view'))
WHERE idx % 100 = 0""",
    "pressure_stats": _STATS,
    "stats_csv_sink": _STATS,
    "hour_distribution": _HOURS,
    "hours_csv_sink": _HOURS,
    "train_test_split": "WITH" + SPLIT + "\nSELECT event_id, split FROM sp",
    "split_counts": "WITH" + SPLIT + '\nSELECT split, count(*) AS "count" FROM sp GROUP BY split',
    "scaler_stats": "WITH"
    + SPLIT
    + "\nSELECT round(std_pressure, 6) AS std_pressure, round(std_hour, 6) AS std_hour FROM dev",
    "scaled_features": "WITH"
    + SPLIT
    + """
SELECT event_id, round(pressure_value / std_pressure, 6) AS pressure_scaled,
       round(hour_of_day / std_hour, 6) AS hour_scaled
FROM sp, dev""",
    "logreg_coefficients": "WITH RECURSIVE"
    + FIT
    + """
SELECT reg, round(w0, 4) AS intercept, round(w1, 4) AS w_pressure, round(w2, 4) AS w_hour FROM fit""",
    "logreg_score": _TEST_SCORES,
    "model_reload_score": _TEST_SCORES,
    "label_distribution": "WITH"
    + SPLIT
    + "\nSELECT label, count(*) AS \"count\" FROM sp WHERE split = 'test' GROUP BY label",
    "confusion_matrix": "WITH RECURSIVE" + SCORED + '\nSELECT reg, label, prediction, n AS "count" FROM confusion',
    "eval_metrics": "WITH RECURSIVE"
    + SCORED
    + """,
cells AS (
  SELECT reg, label AS class, n AS actual, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS hit
  FROM confusion
  UNION ALL
  SELECT reg, prediction, 0, n, 0 FROM confusion
),
classes AS (
  SELECT reg, class, sum(actual) AS actual, sum(hit) AS hit,
         coalesce(sum(hit) / nullif(sum(predicted), 0), 0) AS prec, coalesce(sum(hit) / nullif(sum(actual), 0), 0) AS rec
  FROM cells GROUP BY reg, class
)
SELECT reg, round(sum(hit) / sum(actual), 6) AS accuracy,
       round(sum(actual * prec) / sum(actual), 6) AS weighted_precision,
       round(sum(actual * rec) / sum(actual), 6) AS weighted_recall,
       round(sum(actual * coalesce(2 * prec * rec / nullif(prec + rec, 0), 0)) / sum(actual), 6) AS f1
FROM classes GROUP BY reg""",
    "auc_exact": _AUC,
    # At these sizes there are fewer distinct margins than bins.
    "auc_binned": _AUC,
    "stream_decode": "WITH"
    + FEATURES
    + """
SELECT "timestamp", 'click' AS sensor_id, pressure_value, hour_of_day FROM ft""",
    "stream_score": _SENSOR_SCORES,
    "batch_score": _SENSOR_SCORES,
    **stream_oracle.ORACLE_SQL,
}
# Data that came in two file sets gives what all of it gives.
ORACLE_SQL |= {
    "incremental_pressure_stats": _STATS,
    "incremental_hours": _HOURS,
    "incremental_coefficients": ORACLE_SQL["logreg_coefficients"],
    "incremental_confusion": ORACLE_SQL["confusion_matrix"],
}

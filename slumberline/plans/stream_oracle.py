"""The queries of ``stream_catalog`` as plain SQL. A stream has closed what lies before its watermark: ten minutes before the
latest event."""

from __future__ import annotations

from slumberline.plans.shared_sql import EVENTS, FEATURES, SCORED

_WINDOWS = (
    EVENTS
    + """,
readings AS (SELECT "timestamp" AS ms, value FROM ev WHERE sensor_id = 'click' AND "timestamp" IS NOT NULL),
mark AS (SELECT max(ms) - 600000 AS watermark FROM readings),
placed AS (
  SELECT 'tumbling' AS kind, ms // 3600000 * 3600000 AS window_start, value FROM readings
  UNION ALL
  SELECT 'sliding', ms // 900000 * 900000 - 900000 * k, value FROM readings, range(4) AS s(k)
)"""
)

_SESSIONS = (
    EVENTS
    + """,
asleep AS (
  SELECT sensor_id, "timestamp" AS ms, value FROM ev
  WHERE value > 25.0 AND isfinite(value) AND (hour_of_day >= 22 OR hour_of_day < 7) AND sensor_id IS NOT NULL
),
mark AS (SELECT max(ms) - 600000 AS watermark FROM asleep),
steps AS (
  SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY sensor_id ORDER BY ms) <= 1800000 THEN 0 ELSE 1 END AS fresh
  FROM asleep
),
islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY sensor_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS island FROM steps
)"""
)

ORACLE_SQL: dict[str, str] = {
    "stream_window_stats": "WITH"
    + _WINDOWS
    + """
SELECT kind, window_start, window_start + 3600000 AS window_end, count(value) AS "Count",
       round(min(value), 6) AS "Min_Pressure", round(avg(value), 6) AS "Mean_Pressure",
       round(stddev_samp(value), 6) AS "StdDev_Pressure", round(max(value), 6) AS "Max_Pressure"
FROM placed, mark WHERE window_start + 3600000 <= watermark GROUP BY kind, window_start""",
    "stream_sleep_sessions": "WITH"
    + _SESSIONS
    + """
SELECT sensor_id, min(ms) AS session_start, max(ms) AS session_end, count(*) AS readings,
       round(avg(value), 6) AS mean_pressure
FROM islands GROUP BY sensor_id, island HAVING max(ms) + 1800000 <= (SELECT watermark FROM mark)""",
    "stream_dedup": "WITH"
    + FEATURES
    + """
SELECT "timestamp", 'click' AS sensor_id, pressure_value, hour_of_day FROM ft""",
    "stream_two_tables": "WITH RECURSIVE"
    + SCORED
    + """
SELECT hour_of_day, prediction AS "Is_Sleeping_Prediction", count(*) AS scored, count(*) AS counted
FROM scored WHERE reg = 0 GROUP BY hour_of_day, prediction""",
    "stream_versioned_score": "WITH RECURSIVE"
    + SCORED
    + """
SELECT "timestamp" AS "Event_Time_ms", pressure_value, hour_of_day, prediction AS "Is_Sleeping_Prediction",
       CAST(CASE WHEN reg = 0 THEN 2 ELSE 1 END AS BIGINT) AS version
FROM scored WHERE (reg = 0) = ("timestamp" >= 1705363200000)""",
    "stream_audit": "WITH"
    + EVENTS
    + """,
told AS (
  SELECT *, event_id % 11 = 0 AS cut_off, event_id % 13 = 0 AND event_id % 11 <> 0 AS no_number FROM ev
)
SELECT count(*) AS received, count(*) FILTER (cut_off OR no_number) AS malformed,
       count(*) FILTER (sensor_id = 'click' AND NOT cut_off) AS of_sensor,
       count(*) FILTER (sensor_id = 'click' AND NOT cut_off AND (no_number OR NOT isfinite(value))) AS unusable,
       count(*) FILTER (sensor_id = 'click' AND NOT cut_off AND NOT no_number AND isfinite(value)) AS scorable
FROM told""",
}

"""Common parts of the SQL that registered queries are checked against."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id, epoch_us(ts) // 1000 AS "timestamp", event_type AS sensor_id,
         CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, CAST(hour(ts) AS BIGINT) AS hour_of_day
  FROM events
)"""

FEATURES = (
    EVENTS
    + """,
ft AS (
  SELECT event_id, "timestamp", value AS pressure_value, hour_of_day,
         CASE WHEN value > 25.0 AND (hour_of_day >= 22 OR hour_of_day < 7) THEN CAST(1 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS label
  FROM ev
  WHERE sensor_id = 'click' AND isfinite(value) AND hour_of_day IS NOT NULL
)"""
)

SPLIT = (
    FEATURES
    + """,
sp AS (
  SELECT ft.*, CASE WHEN xor(b, b >> 15) < round(0.7 * 4294967296) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, (xor(a, a >> 15) * 1566083941) & 4294967295 AS b
        FROM (SELECT event_id AS id, ((xor(event_id, event_id >> 32) & 4294967295) * 1103515245) & 4294967295 AS a FROM ft)
       ) JOIN ft ON id = event_id
),
dev AS MATERIALIZED (
  SELECT stddev_samp(pressure_value) AS std_pressure, stddev_samp(hour_of_day) AS std_hour
  FROM sp WHERE split = 'train'
)"""
)

# Newton steps for the penalized mean log loss, from zero, solving each 3x3 system by Cramer's rule.
FIT = (
    SPLIT
    + """,
tr AS MATERIALIZED (
  SELECT pressure_value / std_pressure AS a, hour_of_day / std_hour AS b, label AS y
  FROM sp, dev WHERE split = 'train'
),
newton(reg, step, w0, w1, w2) AS (
  SELECT reg, 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  FROM (VALUES (CAST(0.3 AS DOUBLE)), (CAST(0.0 AS DOUBLE))) AS r(reg)
  UNION ALL
  SELECT reg, step + 1,
    w0 - (g0*(h11*h22-h12*h12) - h01*(g1*h22-h12*g2) + h02*(g1*h12-h11*g2)) / det,
    w1 - (h00*(g1*h22-h12*g2) - g0*(h01*h22-h12*h02) + h02*(h01*g2-g1*h02)) / det,
    w2 - (h00*(h11*g2-g1*h12) - h01*(h01*g2-g1*h02) + g0*(h01*h12-h11*h02)) / det
  FROM (
    SELECT *, h00*(h11*h22-h12*h12) - h01*(h01*h22-h12*h02) + h02*(h01*h12-h11*h02) AS det
    FROM (
      SELECT reg, step, w0, w1, w2,
        avg(p - y) AS g0, avg((p - y) * a) + reg * w1 AS g1, avg((p - y) * b) + reg * w2 AS g2,
        avg(p * (1 - p)) AS h00, avg(p * (1 - p) * a) AS h01, avg(p * (1 - p) * b) AS h02,
        avg(p * (1 - p) * a * a) + reg AS h11, avg(p * (1 - p) * a * b) AS h12,
        avg(p * (1 - p) * b * b) + reg AS h22
      FROM (
        SELECT n.*, tr.*, 1 / (1 + exp(-(w0 + w1 * a + w2 * b))) AS p
        FROM newton n, tr WHERE n.step < 12
      )
      GROUP BY reg, step, w0, w1, w2
    )
  )
),
fit AS MATERIALIZED (SELECT reg, w0, w1, w2 FROM newton WHERE step = 12)"""
)

SCORED = (
    FIT
    + """,
margins AS (
  SELECT reg, split, event_id, "timestamp", pressure_value, hour_of_day, label,
         w0 + w1 * (pressure_value / std_pressure) + w2 * (hour_of_day / std_hour) AS margin
  FROM sp, dev, fit
),
scored AS (
  SELECT *, CASE WHEN margin > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM margins
),
confusion AS (
  SELECT reg, label, prediction, count(*) AS n FROM scored WHERE split = 'test' GROUP BY reg, label, prediction
)"""
)

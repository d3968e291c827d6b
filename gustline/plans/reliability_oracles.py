"""The same results in SQL as the queries of `reliability`."""

from gustline.plans.oracles import ALERTS, CHAIN, CLOSED_ALERTS, PAYLOADS, RAISED, READINGS, THRESHOLDS, _with
from gustline.plans.oracles import ORACLES as PLAIN

ORACLES = {
    "stream_pane_stats": PLAIN["stream_late_data"],
    "stream_pane_alerts": PLAIN["stream_change_alerts"],
    "archived_polls": _with(READINGS, PAYLOADS) + """
SELECT id, CAST(1 AS BIGINT) AS n_sent, dt, CASE WHEN dt >= epoch(TIMESTAMP '2024-01-20') THEN 'folder' ELSE 'archive' END AS lies FROM flat""",
    "history_reload": _with(READINGS, PAYLOADS) + """,
weather AS (
  SELECT strftime(make_timestamp(dt * 1000000), '%Y-%m-%d') AS date, city AS name, count(*) AS n_rows, max(temperature) AS top
  FROM flat GROUP BY 1, 2
),
stock AS (
  SELECT strftime(o_orderdate, '%Y-%m-01') AS date, o_orderpriority AS name, count(*) AS n_rows, round(max(CAST(o_totalprice AS DOUBLE) + 1), 6) AS top
  FROM orders GROUP BY 1, 2
),
phases AS (
  SELECT phase, date, name, n_rows, top FROM (SELECT * FROM weather UNION ALL SELECT * FROM stock), (SELECT unnest(['loaded', 'broken']) AS phase)
  UNION ALL
  SELECT 'reloaded', date, CASE WHEN date >= '2024-01-20' THEN upper(name) ELSE name END, n_rows, top FROM weather
  UNION ALL
  SELECT 'reloaded', * FROM stock
)
SELECT phase, date[1:4] AS year, date[6:7] AS month, date[9:10] AS day, name, n_rows, top FROM phases""",
    "frame_versions": _with(READINGS, PAYLOADS) + """,
told AS (
  SELECT *, CASE WHEN id % 23 = 0 THEN NULL WHEN id % 19 = 0 THEN 99 WHEN id % 2 = 0 THEN 7 ELSE 8 END AS schema_id
  FROM flat
),
judged AS (
  SELECT *, CASE WHEN schema_id IS NULL THEN 'no frame' WHEN schema_id = 99 THEN 'unknown schema'
                 WHEN id % 29 = 0 THEN 'not decoded' ELSE '' END AS reason
  FROM told
)
SELECT id, CAST(schema_id AS BIGINT) AS schema_id, reason, CASE WHEN reason = '' THEN city END AS city,
       CASE WHEN reason = '' THEN temperature END AS temperature, CASE WHEN reason = '' AND schema_id = 7 THEN pressure END AS pressure,
       CASE WHEN reason = '' THEN humidity END AS humidity, CASE WHEN reason = '' THEN dt END AS dt
FROM judged""",
    "alerts_once": _with(READINGS, THRESHOLDS) + """
SELECT event_timestamp, id, city, country, round(temperature, 6) AS temperature, pressure, visibility, wind_speed,
       temp_anomaly, pressure_anomaly, visibility_anomaly, wind_anomaly, true AS sent_again
FROM thresholds""",
    # A trigger drops what lies behind the mark that the one before it went by, which knew the parts before that.
    "delivery_accounts": _with(READINGS) + """,
parts AS (SELECT id % 6 AS part, max(event_timestamp) AS latest FROM r GROUP BY 1),
marks AS (SELECT part, max(latest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 10 DAY AS mark FROM parts)
SELECT CAST(part + 1 AS INTEGER) AS part, count(*) AS rows_in, count(*) FILTER (mark IS NULL OR event_timestamp > mark) AS rows_out,
       count(*) FILTER (event_timestamp <= mark) AS rows_late
FROM r JOIN marks ON r.id % 6 = part GROUP BY part""",
    "match_rejects": """
WITH polls AS (SELECT o_orderkey AS poll, o_orderpriority <> '1-URGENT' AS held FROM orders),
elements AS (
  SELECT poll, unnest(range(2)) AS position, poll % 13 = 0 AS worded FROM polls WHERE held AND poll % 17 <> 0
)
SELECT poll, CAST(position AS INTEGER) AS position, CASE WHEN worded AND position = 0 THEN 'wrong type' ELSE '' END AS reason,
       CASE WHEN worded AND position = 0 THEN NULL ELSE poll * 2 + position END AS id
FROM elements
UNION ALL
SELECT poll, -1, 'not an object', NULL FROM polls WHERE poll % 17 = 0
UNION ALL
SELECT poll, 2, 'not an object', NULL FROM polls WHERE held AND poll % 11 = 0 AND poll % 13 <> 0 AND poll % 17 <> 0""",
    "daily_reload": _with(READINGS, PAYLOADS) + """,
weather AS (
  SELECT '05' AS day, city AS name, count(*) AS n_rows, max(temperature) AS top
  FROM flat WHERE strftime(make_timestamp(dt * 1000000), '%Y-%m-%d') = '2024-01-05' GROUP BY city
),
stock AS (
  SELECT '05' AS day, o_orderpriority AS name, count(*) AS n_rows, round(max(CAST(o_totalprice AS DOUBLE) + 1), 6) AS top
  FROM orders GROUP BY o_orderpriority
)
SELECT phase, day, name, n_rows, top FROM (SELECT * FROM weather UNION ALL SELECT * FROM stock), (SELECT unnest(['loaded', 'broken']) AS phase)
UNION ALL
SELECT 'reloaded', day, upper(name), n_rows, top FROM weather
UNION ALL
SELECT 'reloaded', * FROM stock WHERE name <> '5-LOW'""",
    "suppression_handover": _with(READINGS, ALERTS, RAISED, CHAIN, recursive=True) + "SELECT * FROM kept",
    "suppression_expiring": """
WITH RECURSIVE e AS (SELECT event_type, user_id, ts, event_id FROM events),
c AS (
  SELECT event_type, user_id, min(ts) AS t FROM e GROUP BY event_type, user_id
  UNION ALL
  SELECT c.event_type, c.user_id, min(e.ts) FROM c JOIN e
    ON e.event_type = c.event_type AND e.user_id = c.user_id AND e.ts >= c.t + INTERVAL 1800 SECOND
  GROUP BY c.event_type, c.user_id, c.t
)
SELECT e.event_type, e.user_id, e.event_id, e.ts
FROM c JOIN e ON e.event_type = c.event_type AND e.user_id = c.user_id AND e.ts = c.t
QUALIFY row_number() OVER (PARTITION BY e.event_type, e.user_id, e.ts ORDER BY e.event_id) = 1""",
    "state_audit": _with(READINGS, CLOSED_ALERTS, RAISED, CHAIN, recursive=True) + """
SELECT city, alert_type, anomaly, max(alert_time) AS alert_time, max(alert_time) AS written FROM kept GROUP BY city, alert_type, anomaly""",
}

"""The same results in SQL, for a second engine to run on the given tables."""

READINGS = """
r AS (
  SELECT event_id AS id, event_type AS city,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'US' ELSE 'VN' END AS country,
         CASE WHEN k < 50 THEN 'Clear' ELSE 'Clouds' END AS weather_main,
         'cover ' || k AS weather_description,
         value / 5 - 2 AS temperature, NULLIF(985 + k % 60, 1000) AS pressure,
         NULLIF(k, 13) AS humidity, 10000 - k * 100 AS visibility,
         CAST(k % 15 AS DOUBLE) AS wind_speed,
         date_trunc('second', ts) AS event_timestamp, k
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e
)"""

FLAGGED = """
flagged AS (
  SELECT event_timestamp, 'threshold' AS alert_type, id, city, country, weather_main,
         weather_description, temperature, pressure, humidity, visibility, wind_speed,
         coalesce(temperature <= 0 OR temperature >= 38, false) AS temp_anomaly,
         coalesce(pressure <= 995 OR pressure >= 1033, false) AS pressure_anomaly,
         coalesce(visibility <= 1000, false) AS visibility_anomaly,
         coalesce(wind_speed >= 10, false) AS wind_anomaly
  FROM r
)"""

THRESHOLDS = FLAGGED + """,
thresholds AS (
  SELECT * FROM flagged
  WHERE temp_anomaly OR pressure_anomaly OR visibility_anomaly OR wind_anomaly
)"""

# A struct extreme: the latest maximum, the earliest minimum, a null metric first.
STATS = """
w AS (
  SELECT r.*, time_bucket(INTERVAL 5 MINUTE, event_timestamp) - i * INTERVAL 5 MINUTE
           AS window_start
  FROM (SELECT r.*, unnest(range(6)) AS i FROM r) r
),
stats AS (
  SELECT city, country, window_start, window_start + INTERVAL 30 MINUTE AS window_end,
         avg(temperature) AS avg_temp, avg(pressure) AS avg_pressure,
         avg(wind_speed) AS avg_wind_speed, avg(humidity) AS avg_humidity,
         avg(visibility) AS avg_vis, min(wind_speed) AS min_wind, min(humidity) AS min_humidity,
""" + ",\n".join(
    f"""         first({m} ORDER BY {m} {d} NULLS {n}, event_timestamp {d}) AS {a},
         first(event_timestamp ORDER BY {m} {d} NULLS {n}, event_timestamp {d}) AS {a}_time"""
    for a, m, d, n in [
        ("max_temp", "temperature", "DESC", "LAST"),
        ("min_temp", "temperature", "ASC", "FIRST"),
        ("max_pressure", "pressure", "DESC", "LAST"),
        ("min_pressure", "pressure", "ASC", "FIRST"),
        ("max_wind", "wind_speed", "DESC", "LAST"),
        ("max_humidity", "humidity", "DESC", "LAST"),
        ("min_visibility", "visibility", "ASC", "FIRST"),
    ]
) + """
  FROM w GROUP BY city, country, window_start
)"""

FEATURES = STATS + """,
features AS (
  SELECT *, max_temp - avg_temp AS temp_rise, avg_temp - min_temp AS temp_fall,
         max_pressure - min_pressure AS pressure_drop, max_wind - min_wind AS wind_rise,
         max_humidity - min_humidity AS humidity_rise
  FROM stats
),
labelled AS (
  SELECT *,
         CASE WHEN temp_rise >= 3 THEN 'rise rapidly'
              WHEN temp_fall >= 3 THEN 'fall rapidly' END AS temp_change_anomaly,
         CASE WHEN pressure_drop >= 2 THEN 'drop/unstable' END AS pressure_change_anomaly,
         CASE WHEN wind_rise >= 8 THEN 'rise rapidly' END AS wind_change_anomaly,
         CASE WHEN avg_humidity <> 0 AND humidity_rise / avg_humidity >= 0.2
              THEN 'rise rapidly' END AS humidity_change_anomaly,
         CASE WHEN avg_vis > 5000 AND min_visibility < 2000
              THEN 'drop/unstable' END AS visibility_change_anomaly
  FROM features
)"""

CHANGES = FEATURES + """,
changes AS (
  SELECT 'change' AS alert_type, city, country, window_start, max_temp, max_temp_time, min_temp,
         min_temp_time, round(temp_rise, 6) AS temp_rise, round(temp_fall, 6) AS temp_fall,
         temp_change_anomaly, max_wind, max_wind_time, wind_rise, wind_change_anomaly,
         min_pressure, min_pressure_time, pressure_drop, pressure_change_anomaly,
         max_humidity, max_humidity_time AS max_humid_time, humidity_rise,
         humidity_change_anomaly, min_visibility, min_visibility_time, visibility_change_anomaly
  FROM labelled
  WHERE coalesce(temp_change_anomaly, pressure_change_anomaly, wind_change_anomaly,
                 humidity_change_anomaly, visibility_change_anomaly) IS NOT NULL
)"""

ALERTS = THRESHOLDS + "," + CHANGES + """,
alerts AS (SELECT * FROM thresholds UNION ALL BY NAME SELECT * FROM changes),
timed AS (
  SELECT *, coalesce(event_timestamp, window_start + INTERVAL 30 MINUTE) AS alert_time
  FROM alerts
)"""

FLAGS = ["temp_anomaly", "pressure_anomaly", "visibility_anomaly", "wind_anomaly"]
LABELS = [
    "temp_change_anomaly", "wind_change_anomaly", "pressure_change_anomaly",
    "humidity_change_anomaly", "visibility_change_anomaly",
]
RAISED = "raised AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT city, country, alert_type, '{name}' AS anomaly, alert_time, id FROM timed WHERE {test}"
    for name, test in [(f, f) for f in FLAGS] + [(lb, f"{lb} IS NOT NULL") for lb in LABELS]
) + "\n)"

# The chain of emissions of each key: the first row, then the first one 1800 s or more later.
CHAIN = """
emitted AS (
  SELECT city, alert_type, anomaly, min(alert_time) AS t FROM raised GROUP BY ALL
  UNION ALL
  SELECT c.city, c.alert_type, c.anomaly,
         (SELECT min(e.alert_time) FROM raised e
           WHERE e.city = c.city AND e.alert_type = c.alert_type AND e.anomaly = c.anomaly
             AND e.alert_time >= c.t + INTERVAL 1800 SECOND)
  FROM emitted c WHERE c.t IS NOT NULL
),
kept AS (
  SELECT r.* FROM raised r JOIN emitted e
    ON r.city = e.city AND r.alert_type = e.alert_type AND r.anomaly = e.anomaly
   AND r.alert_time = e.t
  QUALIFY row_number() OVER (PARTITION BY r.city, r.alert_type, r.anomaly, r.alert_time
                             ORDER BY r.country, r.id) = 1
)"""

# Items of an alert in the order of the consumer: position, metric, value, message, time.
THRESHOLD_ITEMS = [
    ("temp_anomaly", "'Temperature'", "temperature || '°C'",
     "CASE WHEN temperature > 0 THEN 'Exceeding the safety threshold' ELSE 'Below the safety threshold' END"),
    ("pressure_anomaly", "'Pressure'", "pressure || 'hPa'",
     "CASE WHEN pressure >= 1033 THEN 'Exceeding the safety threshold' ELSE 'Below the safety threshold' END"),
    ("visibility_anomaly", "'Visibility'", "visibility || 'meter'", "'Below the safety threshold'"),
    ("wind_anomaly", "'Wind Speed'", "wind_speed || 'm/s'", "'Exceeding the safety threshold'"),
]
CHANGE_ITEMS = [
    ("temp_change_anomaly = 'rise rapidly'", "'Temperature fluctuation'", "max_temp || '°C'",
     "'Sudden increase of ' || temp_rise || '°C in the last 30 minutes'", "max_temp_time"),
    ("temp_change_anomaly = 'fall rapidly'", "'Temperature fluctuation'", "min_temp || '°C'",
     "'Sudden decrease of ' || temp_fall || '°C in the last 30 minutes'", "min_temp_time"),
    ("wind_change_anomaly IS NOT NULL", "'Wind speed fluctuation'", "max_wind || 'm/s'",
     "'Sudden increase of ' || wind_rise || 'm/s in the last 30 minutes'", "max_wind_time"),
    ("pressure_change_anomaly IS NOT NULL", "'Pressure fluctuation'", "min_pressure || 'hPa'",
     "'Sudden drop of ' || pressure_drop || 'hPa in the last 30 minutes'", "min_pressure_time"),
    ("humidity_change_anomaly IS NOT NULL", "'Humidity fluctuation'", "max_humidity || '%'",
     "'Sudden increase of ' || humidity_rise || '% in the last 30 minutes'", "max_humid_time"),
    ("visibility_change_anomaly IS NOT NULL", "'Visibility fluctuation'", "min_visibility || 'meter'",
     "'Sudden drop to below 2000 meter in the last 30 minutes'", "min_visibility_time"),
]
MILLIS = "strftime({}, '%Y-%m-%dT%H:%M:%S.%g')"
_entries = [
    f"CASE WHEN {on} THEN {{'metric': {metric}, 'value': {value}, 'message': {message}, "
    f"'detected': CAST(NULL AS VARCHAR)}} END"
    for on, metric, value, message in THRESHOLD_ITEMS
] + [
    f"CASE WHEN {on} THEN {{'metric': {metric}, 'value': {value}, 'message': {message}, "
    f"'detected': {MILLIS.format(time)}}} END"
    for on, metric, value, message, time in CHANGE_ITEMS
]
ITEMS = "items AS (\n  SELECT *, [x FOR x IN [" + ",\n    ".join(_entries) + """] IF x IS NOT NULL] AS anomalies
  FROM timed
)"""

TITLED = """
news AS (
  SELECT city, alert_type, alert_time, id, string_agg(anomaly, ',' ORDER BY anomaly) AS new_anomalies
  FROM kept GROUP BY city, alert_type, alert_time, id
),
titled AS (
  SELECT i.*, n.new_anomalies,
         CASE i.alert_type WHEN 'threshold' THEN 'WEATHER WARNING: Exceeding Safety Limits'
              ELSE 'WEATHER WARNING: Unusual Volatility' END AS title
  FROM items i JOIN news n
    ON i.city = n.city AND i.alert_type = n.alert_type AND i.alert_time = n.alert_time
   AND i.id IS NOT DISTINCT FROM n.id
)"""

BODY = """'<html><body><h2>' || title || '</h2><ul><li>City: ' || city || ', ' || country
  || '</li><li>Alert type: ' || upper(alert_type) || ' ALERT</li>'
  || CASE WHEN alert_type = 'threshold' THEN '<li>Time detected: ' || {at} || 'Z</li>' ELSE '' END
  || '</ul><ul>'
  || array_to_string(['<li><b>' || x.metric || '</b>: ' || x.value || ', ' || x.message
       || CASE WHEN alert_type = 'change' THEN ', at ' || x.detected || 'Z' ELSE '' END
       || '</li>' FOR x IN anomalies], '')
  || '</ul></body></html>'""".format(at=MILLIS.format("event_timestamp"))

PAYLOADS = """
flat AS (
  SELECT id, city, CASE WHEN k % 7 <> 0 THEN country END AS country,
         CASE WHEN k % 11 <> 0 THEN weather_main END AS weather_main,
         CASE WHEN k % 11 <> 0 THEN weather_description END AS weather_description,
         round(CAST(CAST(temperature AS FLOAT) AS DOUBLE), 6) AS temperature,
         pressure, humidity, visibility,
         CASE WHEN k % 5 <> 0 THEN wind_speed END AS wind_speed,
         CAST(floor(epoch(event_timestamp)) AS BIGINT) AS dt,
         '2024-02-01T00:00:00.000000' AS ingested_at
  FROM r
)"""

MATCHES = """
legs AS (
  SELECT o.*, unnest(range(2)) AS leg FROM orders o WHERE o_orderpriority <> '1-URGENT'
),
matches AS (
  SELECT o_orderkey * 2 + leg AS id,
         strftime(o_orderdate + leg * INTERVAL 7 DAY, '%Y-%m-%d') || 'T15:00:00Z' AS "utcDate",
         CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'TIMED' END AS status,
         CAST(leg + 1 AS INTEGER) AS matchday,
         'Team ' || (o_custkey + leg) AS home, 'Team ' || (o_custkey + 1 - leg) AS away,
         CAST(o_custkey % 5 AS INTEGER) AS home_goals,
         CAST((o_custkey + 1) % 4 AS INTEGER) AS away_goals,
         CAST(NULL AS INTEGER) AS penalty_goals, '2024-02-01T00:00:00.000000' AS ingested_at
  FROM legs
)"""

CLOSED = "window_start + INTERVAL 30 MINUTE <= (SELECT max(event_timestamp) FROM r) - INTERVAL 2 MINUTE"


CLOSED_ALERTS = ALERTS.replace("FROM alerts\n)", f"""FROM (
    SELECT * FROM alerts WHERE alert_type = 'threshold' OR {CLOSED})
)""")


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


_rounded_alerts = "SELECT * REPLACE (round(temperature, 6) AS temperature, round(max_temp, 6) AS max_temp, round(min_temp, 6) AS min_temp)"
_rounded_changes = "SELECT * REPLACE (round(max_temp, 6) AS max_temp, round(min_temp, 6) AS min_temp)"
_rounded_flags = "SELECT * REPLACE (round(temperature, 6) AS temperature)"
_late = "visibility > 2000 AND event_timestamp < TIMESTAMP '2024-01-20 00:00:00'"

_raw_rows = """
SELECT city, country, weather_main, weather_description, round(temperature, 6) AS temperature,
       CAST(pressure AS INTEGER) AS pressure, CAST(humidity AS INTEGER) AS humidity,
       CAST(visibility AS INTEGER) AS visibility, wind_speed,
       strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS record_timestamp,
       strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month, strftime(event_timestamp, '%d') AS day"""

ORACLES = {
    "change_alerts": _with(READINGS, CHANGES) + f"{_rounded_changes} FROM changes",
    "threshold_alerts": _with(READINGS, THRESHOLDS) + f"{_rounded_flags} FROM thresholds",
    "threshold_flags": _with(READINGS, FLAGGED) + f"{_rounded_flags} FROM flagged",
    "sliding_window_stats": _with(READINGS, STATS) + """
SELECT city, country, window_start, window_end, round(avg_temp, 6) AS avg_temp,
       round(avg_pressure, 6) AS avg_pressure, round(avg_wind_speed, 6) AS avg_wind_speed,
       round(avg_humidity, 6) AS avg_humidity, round(avg_vis, 6) AS avg_vis, min_wind, min_humidity
FROM stats""",
    "window_extremes": _with(READINGS, STATS) + """
SELECT city, country, window_start, round(max_temp, 6) AS max_temp, max_temp_time,
       round(min_temp, 6) AS min_temp, min_temp_time, max_pressure, max_pressure_time, min_pressure,
       min_pressure_time, max_wind, max_wind_time, max_humidity, max_humidity_time,
       min_visibility, min_visibility_time
FROM stats""",
    "change_features": _with(READINGS, FEATURES) + """
SELECT city, country, window_start, round(temp_rise, 6) AS temp_rise,
       round(temp_fall, 6) AS temp_fall, pressure_drop, wind_rise, humidity_rise,
       temp_change_anomaly, pressure_change_anomaly, wind_change_anomaly,
       humidity_change_anomaly, visibility_change_anomaly
FROM labelled""",
    "all_alerts": _with(READINGS, ALERTS) + f"{_rounded_alerts} FROM alerts",
    "alert_dispatch": _with(READINGS, ALERTS)
    + "SELECT alert_type, city, count(*) AS n_alerts FROM alerts GROUP BY alert_type, city",
    "alert_anomalies_exploded": _with(READINGS, ALERTS, RAISED) + "SELECT * FROM raised",
    "alert_suppression": _with(READINGS, ALERTS, RAISED, CHAIN, recursive=True)
    + "SELECT * FROM kept",
    "event_suppression": """
WITH RECURSIVE e AS (SELECT event_type, ts, event_id FROM events),
c AS (
  SELECT event_type, min(ts) AS t FROM e GROUP BY event_type
  UNION ALL
  SELECT c.event_type, (SELECT min(e.ts) FROM e WHERE e.event_type = c.event_type
                          AND e.ts >= c.t + INTERVAL 1800 SECOND)
  FROM c WHERE c.t IS NOT NULL
)
SELECT e.event_type, e.ts, e.event_id
FROM c JOIN e ON e.event_type = c.event_type AND e.ts = c.t
QUALIFY row_number() OVER (PARTITION BY e.event_type, e.ts ORDER BY e.event_id) = 1""",
    "alert_enrichment": _with(READINGS, ALERTS, ITEMS) + """
SELECT alert_type, city, country, event_timestamp, window_start, id,
       CAST(position - 1 AS INTEGER) AS position, anomalies[position].metric AS metric,
       anomalies[position].value AS value, anomalies[position].message AS message,
       anomalies[position].detected AS detected
FROM (SELECT *, unnest(range(1, len(anomalies) + 1)) AS position FROM items)""",
    "alert_notifications": _with(READINGS, ALERTS, RAISED, CHAIN, ITEMS, TITLED, recursive=True)
    + f"""
SELECT alert_type, city, country, alert_time, id, new_anomalies,
       CAST(len(anomalies) AS INTEGER) AS n_anomalies, title || ': ' || city AS subject,
       {BODY} AS body, 'ops@example.org, desk@example.org' AS recipients
FROM titled""",
    "alert_payload_json": _with(READINGS, ALERTS) + f"{_rounded_alerts} FROM alerts",
    "stream_threshold_alerts": _with(READINGS, THRESHOLDS) + """
SELECT event_timestamp, id, city, country, round(temperature, 6) AS temperature,
       pressure, visibility, wind_speed, temp_anomaly, pressure_anomaly, visibility_anomaly,
       wind_anomaly
FROM thresholds""",
    "stream_change_alerts": _with(READINGS, CHANGES) + f"""
SELECT city, country, window_start, round(max_temp, 6) AS max_temp,
       round(min_temp, 6) AS min_temp, max_temp_time, min_temp_time,
       temp_rise, temp_fall, temp_change_anomaly, max_wind, wind_rise, wind_change_anomaly,
       min_pressure, pressure_drop, pressure_change_anomaly, max_humidity, humidity_rise,
       humidity_change_anomaly, min_visibility, visibility_change_anomaly
FROM changes WHERE {CLOSED}""",
    "stream_alert_suppression": _with(READINGS, CLOSED_ALERTS, RAISED, CHAIN, recursive=True)
    + "SELECT * FROM kept",
    "stream_notifications": _with(READINGS, CLOSED_ALERTS, RAISED, CHAIN, ITEMS, TITLED, recursive=True)
    + """
SELECT alert_type, city, country, alert_time, id, new_anomalies,
       CAST(len(anomalies) AS INTEGER) AS n_anomalies, title || ': ' || city AS subject,
       'ops@example.org, desk@example.org' AS recipients
FROM titled""",
    "stream_match_feed": _with(MATCHES) + """
SELECT CASE WHEN status = 'FINISHED' THEN 'football_history' ELSE 'football_live' END AS topic,
       CAST(id AS VARCHAR) AS key, status, "utcDate"
FROM matches""",
    "stream_reading_feed": _with(READINGS, PAYLOADS) + """
SELECT * EXCLUDE (ingested_at), make_timestamp(dt * 1000000) AS event_timestamp FROM flat""",
    "stream_late_data": _with(
        READINGS,
        f"""
first_mark AS (SELECT max(event_timestamp) - INTERVAL 2 MINUTE AS mark FROM r WHERE {_late}),
last_mark AS (SELECT max(event_timestamp) - INTERVAL 2 MINUTE AS mark FROM r)""",
        STATS.replace("GROUP BY city", f"""
  WHERE ({_late}) OR window_start + INTERVAL 30 MINUTE > (SELECT mark FROM first_mark)
  GROUP BY city"""),
    ) + """
SELECT city, country, window_start, round(avg_temp, 6) AS avg_temp, min_wind,
       round(max_temp, 6) AS max_temp, max_temp_time
FROM stats WHERE window_end <= (SELECT mark FROM last_mark)""",
    "payload_flatten": _with(READINGS, PAYLOADS) + "SELECT * FROM flat",
    "event_times": """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS dt, date_trunc('second', ts) AS event_timestamp
FROM events""",
    "city_allow_list": _with(READINGS) + """
SELECT id, city, country, round(temperature, 6) AS temperature, event_timestamp FROM r
WHERE (city = 'click' AND country = 'US') OR (city = 'error' AND country = 'VN')
   OR (city = 'signup' AND country = 'US')""",
    "match_flatten": _with(MATCHES) + "SELECT * FROM matches",
    "match_router": _with(MATCHES) + """
SELECT id, status, CASE WHEN status = 'FINISHED' THEN 'football_history' ELSE 'football_live' END
         AS topic
FROM matches""",
    "match_date_window": _with(MATCHES) + """
SELECT 'live' AS part, id, "utcDate", status FROM matches
WHERE CAST(substr("utcDate", 1, 10) AS DATE) BETWEEN DATE '1998-06-15' AND DATE '1998-06-16'
UNION ALL
SELECT 'history' AS part, id, "utcDate", status FROM matches
WHERE CAST(substr("utcDate", 1, 10) AS DATE) BETWEEN DATE '1998-05-16' AND DATE '1998-06-15'
  AND status = 'FINISHED'""",
    "match_counts": _with(MATCHES) + """
SELECT count(*) AS total, count(*) FILTER (status IS DISTINCT FROM 'FINISHED') AS live,
       count(*) FILTER (status = 'FINISHED') AS finished
FROM matches""",
    "required_fields_check": _with(READINGS, PAYLOADS, MATCHES) + """
SELECT 'weather' AS data_name, count(*) AS records_count, 'PASS' AS status,
       true AS has_required_fields, '' AS failed_conditions FROM flat
UNION ALL
SELECT 'weather_without_nulls', count(*), 'PASS', lacking = 0,
       CASE WHEN lacking = 0 THEN '' ELSE 'Missing one or more required fields: city, country, '
            || 'humidity, ingested_at, pressure, temperature, visibility' END
FROM (SELECT *, count(*) FILTER (country IS NULL OR pressure IS NULL OR humidity IS NULL) OVER ()
        AS lacking FROM flat)
GROUP BY lacking
UNION ALL
SELECT 'historical_football', count(*), 'PASS', true, '' FROM matches
UNION ALL
SELECT 'live_football', 0, 'PASS (Zero allowed)', true, ''
UNION ALL
SELECT 'historical_football_none', 0, 'FAIL (Zero Count)', false,
       'FAIL (Zero Count), Missing one or more required fields: awayTeam, homeTeam, id, '
       || 'ingested_at, score, utcDate'""",
    "landing_partitions": _with(READINGS) + """
SELECT strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month,
       strftime(event_timestamp, '%d') AS day,
       CASE WHEN strftime(event_timestamp, '%Y-%m-%d') = '2024-01-05' THEN upper(city) ELSE city END
         AS city,
       count(*) AS n_rows, round(max(temperature), 6) AS max_temp
FROM r GROUP BY 1, 2, 3, 4""",
    "raw_table_scan": _with(READINGS) + f"{_raw_rows} FROM r",
    "raw_table_day": _with(READINGS) + f"{_raw_rows} FROM r WHERE strftime(event_timestamp, '%Y-%m-%d') = '2024-01-17'",
    "partition_inventory": _with(READINGS) + """
SELECT strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month,
       strftime(event_timestamp, '%d') AS day, count(*) AS n_rows, true AS files_agree, true AS bytes_agree
FROM r GROUP BY 1, 2, 3""",
    "payload_rejects": _with(READINGS) + """
SELECT id, CASE WHEN id % 17 = 0 THEN 'not an object' WHEN id % 13 = 0 THEN 'wrong type' ELSE '' END AS reason
FROM r""",
    "match_history_feed": _with(MATCHES) + """
SELECT 'football_history' AS topic, CAST(id AS VARCHAR) AS key, status, "utcDate" FROM matches
WHERE CAST(substr("utcDate", 1, 10) AS DATE) BETWEEN DATE '1998-05-16' AND DATE '1998-06-15'
  AND status = 'FINISHED'""",
    "daily_batch": _with(READINGS, PAYLOADS) + """
SELECT strftime(make_timestamp(dt * 1000000), '%d') AS day, city, count(*) AS n_rows, max(temperature) AS top
FROM flat
WHERE strftime(make_timestamp(dt * 1000000), '%Y-%m-%d') = '2024-01-06'
   OR strftime(make_timestamp(dt * 1000000), '%Y-%m-%d') = '2024-01-05' AND country IS DISTINCT FROM 'VN'
GROUP BY 1, 2
UNION ALL
SELECT '06', o_orderpriority, count(*), round(max(CAST(o_totalprice AS DOUBLE) + 1), 6) FROM orders GROUP BY 2""",
    "envelope_projection": _with(READINGS, PAYLOADS) + """
SELECT TIMESTAMP '2024-02-01 00:00:00' AS kafka_timestamp, CAST(NULL AS BIGINT) AS "offset",
       CAST(0 AS INTEGER) AS "partition", id, dt FROM flat""",
    "financial_table_scan": """
SELECT o_orderpriority AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS txn_date,
       round(CAST(o_totalprice AS DOUBLE), 6) AS "open", round(CAST(o_totalprice AS DOUBLE) + 2, 6) AS high,
       round(CAST(o_totalprice AS DOUBLE) - 2, 6) AS low, round(CAST(o_totalprice AS DOUBLE) + 1, 6) AS "close",
       CAST(o_custkey % 1000 AS INTEGER) AS volume, '2024-02-01T00:00:00.000000' AS record_timestamp,
       strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month
FROM orders""",
    "frame_strip": _with(READINGS, PAYLOADS)
    + "SELECT *, make_timestamp(dt * 1000000) AS event_timestamp FROM flat",
    "keyed_publish": _with(READINGS, PAYLOADS) + """
SELECT 'weather' AS topic, CAST(7 AS BIGINT) AS schema_id, CAST(id AS VARCHAR) AS key, city, visibility, dt FROM flat""",
}

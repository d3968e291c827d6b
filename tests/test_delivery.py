"""Enriched alerts and notification rows."""

from rows import reading, readings

from gustline.operators.alerts import explode_anomalies, of_type, raised_anomalies, unite
from gustline.operators.changes import change_alerts
from gustline.operators.notifications import enrich, render
from gustline.operators.thresholds import threshold_alerts
from gustline.plans.delivery import deliver
from gustline.schemas import ALERT


def alerts(spark, rows):
    r = readings(spark, rows)
    return unite(threshold_alerts(r), change_alerts(r))


def items(frame, kind, minute=None):
    rows = of_type(enrich(frame), kind)
    if minute is not None:
        rows = rows.filter(f"minute(window_start) = {minute}")
    return [tuple(i) for i in rows.first().anomalies]


def test_threshold_items(spark):
    frame = alerts(spark, [reading(temperature=-0.5, pressure=1033, visibility=900, wind_speed=10.0)])
    assert items(frame, "threshold") == [
        ("Temperature", "-0.5°C", "Below the safety threshold", None),
        ("Pressure", "1033hPa", "Exceeding the safety threshold", None),
        ("Visibility", "900meter", "Below the safety threshold", None),
        ("Wind Speed", "10.0m/s", "Exceeding the safety threshold", None),
    ]
    warm = alerts(spark, [reading(temperature=38.0, pressure=995)])
    assert [i[2] for i in items(warm, "threshold")] == [
        "Exceeding the safety threshold", "Below the safety threshold"]
    freezing = alerts(spark, [reading(temperature=0.0)])
    assert items(freezing, "threshold")[0][2] == "Below the safety threshold"


def test_change_items_in_order(spark):
    frame = alerts(spark, [
        reading(minute=1, temperature=10.0, wind_speed=1.0, pressure=1012, humidity=40, visibility=9000),
        reading(minute=3, temperature=20.0, wind_speed=9.5, pressure=1010, humidity=60, visibility=1900),
    ])
    first, last = "2024-03-01T00:01:00.000Z", "2024-03-01T00:03:00.000Z"
    assert items(frame, "change", 0) == [
        ("Temperature fluctuation", "20.0°C", "Sudden increase of 5.0°C in the last 30 minutes", last),
        ("Wind speed fluctuation", "9.5m/s", "Sudden increase of 8.5m/s in the last 30 minutes", last),
        ("Pressure fluctuation", "1010hPa", "Sudden drop of 2hPa in the last 30 minutes", last),
        ("Humidity fluctuation", "60%", "Sudden increase of 20% in the last 30 minutes", last),
        ("Visibility fluctuation", "1900meter", "Sudden drop to below 2000 meter in the last 30 minutes", last),
    ]
    falling = alerts(spark, [reading(minute=1, temperature=8.0), reading(minute=2, temperature=20.0),
                             reading(minute=3, temperature=20.0), reading(minute=4, temperature=20.0)])
    assert items(falling, "change", 0)[0] == (
        "Temperature fluctuation", "20.0°C", "Sudden increase of 3.0°C in the last 30 minutes",
        "2024-03-01T00:04:00.000Z")
    drop = alerts(spark, [reading(minute=1, temperature=4.0)] + [
        reading(minute=m, temperature=10.0) for m in (2, 3, 4)])
    assert items(drop, "change", 0)[0] == (
        "Temperature fluctuation", "4.0°C", "Sudden decrease of 4.5°C in the last 30 minutes", first)


def test_subject_body_and_recipients(spark):
    frame = spark.createDataFrame([("threshold", None, None), ("change", "Ha Noi", "VN"), (None, "X", "Y")],
                                  "alert_type STRING, city STRING, country STRING")
    missing = [f for f in ALERT if f.name not in frame.columns]
    for f in missing:
        frame = frame.selectExpr("*", f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}")
    a, b, c = render(enrich(frame), "a@example.org,b@example.org").collect()
    assert a.subject == "WEATHER WARNING: Exceeding Safety Limits: Unknown"
    assert b.subject == "WEATHER WARNING: Unusual Volatility: Ha Noi"
    assert c.subject == "ALERT: X"
    assert "THRESHOLD ALERT" in a.body and "Time detected" in a.body
    assert "Ha Noi, VN" in b.body and "CHANGE ALERT" in b.body and "Time detected" not in b.body
    assert "City Weather Alert" in c.body and "UNKNOWN ALERT" in c.body
    assert a.recipients == "a@example.org, b@example.org"


def test_raised_lists_follow_the_type(spark):
    frame = alerts(spark, [reading(temperature=40.0, wind_speed=12.0)])
    assert frame.columns == ALERT.fieldNames()
    row = of_type(frame, "threshold").select(raised_anomalies().alias("r")).first()
    assert row.r == ["temp_anomaly", "wind_anomaly"]
    other = frame.selectExpr("'other' AS alert_type", "* EXCEPT (alert_type)").select(frame.columns)
    assert explode_anomalies(other).count() == 0


def test_one_notification_per_alert_with_news(spark):
    frame = alerts(spark, [
        reading(id=1, minute=0, temperature=40.0, pressure=1012),
        reading(id=1, minute=0, temperature=40.0, pressure=1012),   # published twice
        reading(id=1, minute=10, temperature=40.0, wind_speed=11.0, pressure=1012),
        reading(id=1, minute=20, temperature=40.0, pressure=1012),
    ])
    sent = of_type(deliver(frame, "a@example.org"), "threshold").orderBy("alert_time").collect()
    assert [(r.alert_time.minute, r.new_anomalies, r.n_anomalies) for r in sent] == [
        (0, "temp_anomaly", 1), (10, "wind_anomaly", 2)]
    assert "Temperature" in sent[1].body and "Wind Speed" in sent[1].body

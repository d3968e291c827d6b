from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from rows import DAY, reading, readings

from gustline.operators.changes import change_alerts, change_features
from gustline.operators.thresholds import flag_thresholds, threshold_alerts
from gustline.operators.windows import _stream_stats, window_stats
from gustline.plans import given
from gustline.schemas import CHANGE_ALERT_COLUMNS, THRESHOLD_ALERT_COLUMNS


@pytest.mark.parametrize(
    "metric, value, flag, raised",
    [
        ("temperature", 0.0, "temp_anomaly", True), ("temperature", 0.1, "temp_anomaly", False),
        ("temperature", 38.0, "temp_anomaly", True), ("temperature", 37.9, "temp_anomaly", False),
        ("pressure", 995, "pressure_anomaly", True), ("pressure", 996, "pressure_anomaly", False),
        ("pressure", 1033, "pressure_anomaly", True), ("pressure", 1032, "pressure_anomaly", False),
        ("visibility", 1000, "visibility_anomaly", True), ("visibility", 1001, "visibility_anomaly", False),
        ("wind_speed", 10.0, "wind_anomaly", True), ("wind_speed", 9.9, "wind_anomaly", False),
        ("temperature", None, "temp_anomaly", False), ("wind_speed", None, "wind_anomaly", False),
    ],
)
def test_threshold_limits(spark, metric, value, flag, raised):
    frame = readings(spark, [reading(**{metric: value})])
    assert flag_thresholds(frame).first()[flag] is raised
    assert threshold_alerts(frame).count() == int(raised)


def test_threshold_alert_of_nulls(spark):
    nothing = dict.fromkeys(["temperature", "pressure", "humidity", "visibility", "wind_speed"])
    frame = readings(spark, [reading(**nothing)])
    assert threshold_alerts(frame).columns == THRESHOLD_ALERT_COLUMNS
    assert threshold_alerts(frame).count() == 0


def test_threshold_filter_reaches_the_scan_without_shuffle(spark, folder):
    readings(spark, [reading()]).write.parquet(folder)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = threshold_alerts(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(temperature,0.0)" in plan
    assert "GreaterThanOrEqual(pressure,1033)" in plan
    assert "Exchange" not in plan


def one_window(frame, minute=0):
    """The window that starts at the given minute."""
    start = DAY + timedelta(minutes=minute)
    return change_features(window_stats(frame)).filter(F.col("time_window.start") == start).first()


def test_each_reading_is_in_six_windows(spark):
    stats = window_stats(readings(spark, [reading(minute=7)]))
    starts = sorted(r.start for r in stats.select("time_window.start").collect())
    assert starts == [DAY + timedelta(minutes=m) for m in range(-20, 10, 5)]


def test_ties_take_the_latest_maximum_and_the_earliest_minimum(spark):
    frame = readings(spark, [reading(minute=m, temperature=t) for m, t in
                             [(1, 9.0), (2, 9.0), (3, 1.0), (4, 1.0)]])
    row = one_window(frame)
    assert row.max_temp_info.event_timestamp == DAY + timedelta(minutes=2)
    assert row.min_temp_info.event_timestamp == DAY + timedelta(minutes=3)


def test_a_null_reading_hides_the_timed_minimum_only(spark):
    frame = readings(spark, [
        reading(minute=1, temperature=10.0, pressure=1000, visibility=9000, humidity=40),
        reading(minute=8, temperature=None, pressure=None, visibility=None, humidity=None),
        reading(minute=9, temperature=1.0, pressure=1010, visibility=1500, humidity=80),
    ])
    row = one_window(frame)
    assert row.min_temp_info.temperature is None and row.temp_fall is None
    assert row.pressure_drop is None and row.visibility_change_anomaly is None
    assert row.max_temp_info.temperature == 10.0 and row.min_humidity == 40
    assert row.humidity_change_anomaly == "rise rapidly"


def test_a_metric_without_values(spark):
    row = one_window(readings(spark, [reading(minute=1, humidity=None), reading(minute=2, humidity=None)]))
    assert row.avg_humidity is None and row.humidity_change_anomaly is None


@pytest.mark.parametrize(
    "metric, values, label, text",
    [
        ("temperature", [10.0, 10.0, 14.5], "temp_change_anomaly", "rise rapidly"),
        ("temperature", [10.0, 10.0, 14.4], "temp_change_anomaly", None),
        ("temperature", [10.0, 10.0, 5.5], "temp_change_anomaly", "fall rapidly"),
        ("temperature", [0.0, 10.0], "temp_change_anomaly", "rise rapidly"),
        ("pressure", [1000, 1002], "pressure_change_anomaly", "drop/unstable"),
        ("pressure", [1000, 1001], "pressure_change_anomaly", None),
        ("wind_speed", [1.0, 9.0], "wind_change_anomaly", "rise rapidly"),
        ("wind_speed", [1.0, 8.9], "wind_change_anomaly", None),
        ("humidity", [45, 55], "humidity_change_anomaly", "rise rapidly"),
        ("humidity", [46, 55], "humidity_change_anomaly", None),
        ("humidity", [0, 0], "humidity_change_anomaly", None),
        ("visibility", [9000, 1999], "visibility_change_anomaly", "drop/unstable"),
        ("visibility", [9000, 2000], "visibility_change_anomaly", None),
        ("visibility", [8001, 1999], "visibility_change_anomaly", None),
    ],
)
def test_change_limits(spark, metric, values, label, text):
    frame = readings(spark, [reading(minute=m, **{metric: v}) for m, v in enumerate(values)])
    assert one_window(frame)[label] == text


def test_quiet_windows_give_no_alert(spark):
    frame = readings(spark, [reading(minute=m) for m in range(10)])
    assert change_alerts(frame).columns == CHANGE_ALERT_COLUMNS
    assert change_alerts(frame).count() == 0


def test_panes_agree_with_plain_sliding_windows(spark):
    """The two-step plan for bounded input against one sliding aggregation."""
    frame = given.readings(spark, "/root/testdata/sf0.01")
    frame = frame.withColumn("humidity", F.when(F.col("humidity") > 90, None).otherwise(F.col("humidity")))
    names = [c for c in window_stats(frame).columns if c != "time_window"]

    def flat(stats):
        columns = [F.round(c, 9).alias(c) if c.startswith("avg") else F.col(c) for c in names]
        return stats.select("time_window.start", "time_window.end", *columns)

    ours, plain = flat(window_stats(frame)), flat(_stream_stats(frame))
    assert ours.count() == plain.count()
    assert ours.exceptAll(plain).count() == 0


def test_window_plan_shuffles_panes_only(spark, folder):
    given.readings(spark, "/root/testdata/sf0.001").write.parquet(folder)
    plan = change_alerts(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    below_second = plan.split("REPARTITION_BY_COL")[1]
    assert "partial_max" in below_second and "sequence" not in below_second

"""Sudden changes within a sliding window."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.functions import rules
from gustline.operators.windows import EVENT_TIME, WATERMARK, window_stats
from gustline.schemas import CHANGE_ALERT_COLUMNS


def change_features(stats: DataFrame) -> DataFrame:
    """Window statistics with distances and labels."""
    return stats.withColumns(rules.change_features()).withColumns(rules.change_labels())


def change_alerts(readings: DataFrame) -> DataFrame:
    """One row per place and window with at least one label.

    In a stream a row comes once, when the watermark has passed the end of its window.
    """
    if readings.isStreaming:
        readings = readings.withWatermark(EVENT_TIME, WATERMARK)
    return labelled_alerts(window_stats(readings))


def labelled_alerts(stats: DataFrame) -> DataFrame:
    """The alerts of window statistics, however they were made."""
    labelled = change_features(stats).filter(rules.any_label())
    extremes = {
        "window_start": "time_window.start",
        "max_temp": "max_temp_info.temperature",
        "max_temp_time": f"max_temp_info.{EVENT_TIME}",
        "min_temp": "min_temp_info.temperature",
        "min_temp_time": f"min_temp_info.{EVENT_TIME}",
        "max_wind": "max_wind_info.wind_speed",
        "max_wind_time": f"max_wind_info.{EVENT_TIME}",
        "min_pressure": "min_pressure_info.pressure",
        "min_pressure_time": f"min_pressure_info.{EVENT_TIME}",
        "max_humidity": "max_humidity_info.humidity",
        "max_humid_time": f"max_humidity_info.{EVENT_TIME}",
        "min_visibility": "min_vis_info.visibility",
        "min_visibility_time": f"min_vis_info.{EVENT_TIME}",
    }
    named = labelled.withColumns({name: F.col(path) for name, path in extremes.items()})
    return named.withColumn("alert_type", F.lit("change")).select(CHANGE_ALERT_COLUMNS)

"""Rule tables for the two detectors and the columns made from them."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag -> (metric, alert at or below, alert at or above).
THRESHOLDS = {
    "temp_anomaly": ("temperature", 0, 38),
    "pressure_anomaly": ("pressure", 995, 1033),
    "visibility_anomaly": ("visibility", 1000, None),
    "wind_anomaly": ("wind_speed", None, 10),
}

# Limits and labels of a change within one window.
RISE, FALL, UNSTABLE = "rise rapidly", "fall rapidly", "drop/unstable"
TEMP_CHANGE, PRESSURE_CHANGE, WIND_CHANGE, HUMIDITY_SHARE = 3, 2, 8, 0.2
CLEAR_VISIBILITY, POOR_VISIBILITY = 5000, 2000

THRESHOLD_ANOMALIES = list(THRESHOLDS)
CHANGE_ANOMALIES = [
    "temp_change_anomaly", "wind_change_anomaly", "pressure_change_anomaly",
    "humidity_change_anomaly", "visibility_change_anomaly",
]


def outside(metric: str, low, high) -> Column:
    """Plain comparison, so that a filter on it reaches a columnar scan."""
    bounds = []
    if low is not None:
        bounds.append(F.col(metric) <= low)
    if high is not None:
        bounds.append(F.col(metric) >= high)
    return reduce(or_, bounds)


def threshold_flags() -> dict[str, Column]:
    """One boolean per rule; a missing metric raises no flag."""
    return {
        flag: F.coalesce(outside(*rule), F.lit(False)) for flag, rule in THRESHOLDS.items()
    }


def any_threshold() -> Column:
    return reduce(or_, (outside(*rule) for rule in THRESHOLDS.values()))


def change_features() -> dict[str, Column]:
    """Distances within a window; null wherever one of the two sides is null."""
    return {
        "temp_rise": F.col("max_temp_info.temperature") - F.col("avg_temp"),
        "temp_fall": F.col("avg_temp") - F.col("min_temp_info.temperature"),
        "pressure_drop": F.col("max_pressure_info.pressure") - F.col("min_pressure_info.pressure"),
        "wind_rise": F.col("max_wind_info.wind_speed") - F.col("min_wind"),
        "humidity_rise": F.col("max_humidity_info.humidity") - F.col("min_humidity"),
    }


def change_labels() -> dict[str, Column]:
    """One label per metric, null when nothing unusual happened. A rise wins over a fall."""
    humid = F.col("avg_humidity") != 0
    share = F.try_divide(F.col("humidity_rise"), F.col("avg_humidity"))
    cleared = F.col("avg_vis") > CLEAR_VISIBILITY
    poor = F.col("min_vis_info.visibility") < POOR_VISIBILITY
    return {
        "temp_change_anomaly": F.when(F.col("temp_rise") >= TEMP_CHANGE, RISE).when(
            F.col("temp_fall") >= TEMP_CHANGE, FALL
        ),
        "pressure_change_anomaly": F.when(F.col("pressure_drop") >= PRESSURE_CHANGE, UNSTABLE),
        "wind_change_anomaly": F.when(F.col("wind_rise") >= WIND_CHANGE, RISE),
        "humidity_change_anomaly": F.when(humid & (share >= HUMIDITY_SHARE), RISE),
        "visibility_change_anomaly": F.when(cleared & poor, UNSTABLE),
    }


def any_label() -> Column:
    return reduce(or_, (F.col(label).isNotNull() for label in CHANGE_ANOMALIES))

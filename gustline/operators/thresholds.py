"""Readings outside fixed limits."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.functions import rules
from gustline.schemas import THRESHOLD_ALERT_COLUMNS


def flag_thresholds(readings: DataFrame) -> DataFrame:
    """Tag every reading with the four flags."""
    tagged = readings.withColumns(
        {"alert_type": F.lit("threshold"), **rules.threshold_flags()}
    )
    return tagged.select(THRESHOLD_ALERT_COLUMNS)


def threshold_alerts(readings: DataFrame) -> DataFrame:
    """Readings with at least one flag.

    The filter names the metrics, not the flags, so a parquet scan can skip row groups.
    """
    return flag_thresholds(readings.filter(rules.any_threshold()))

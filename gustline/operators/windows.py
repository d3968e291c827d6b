"""Sliding-window statistics per place: averages and extremes with their times."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Length, slide and lateness of the window, and what it computes.
WINDOW_MINUTES, SLIDE_MINUTES = 30, 5
WATERMARK = "2 minutes"
EVENT_TIME = "event_timestamp"

MEANS = {
    "avg_temp": "temperature",
    "avg_pressure": "pressure",
    "avg_wind_speed": "wind_speed",
    "avg_humidity": "humidity",
    "avg_vis": "visibility",
}
LATEST_MAXIMA = {
    "max_temp_info": "temperature",
    "max_pressure_info": "pressure",
    "max_wind_info": "wind_speed",
    "max_humidity_info": "humidity",
}
EARLIEST_MINIMA = {
    "min_temp_info": "temperature",
    "min_pressure_info": "pressure",
    "min_vis_info": "visibility",
}
PLAIN_MINIMA = {"min_wind": "wind_speed", "min_humidity": "humidity"}


def _timed(metric: str) -> Column:
    # Struct order decides ties by time and puts a null metric first, so a window with
    # a null reading has a null minimum. max_by/min_by would do neither.
    return F.struct(metric, EVENT_TIME)


def _extremes() -> list[Column]:
    return (
        [F.max(_timed(metric)).alias(name) for name, metric in LATEST_MAXIMA.items()]
        + [F.min(_timed(metric)).alias(name) for name, metric in EARLIEST_MINIMA.items()]
        + [F.min(metric).alias(name) for name, metric in PLAIN_MINIMA.items()]
    )


def window_stats(readings: DataFrame) -> DataFrame:
    """Fourteen aggregates per city, country and `time_window`."""
    return _stream_stats(readings) if readings.isStreaming else _pane_stats(readings)


def _stream_stats(readings: DataFrame) -> DataFrame:
    window = F.window(EVENT_TIME, f"{WINDOW_MINUTES} minutes", f"{SLIDE_MINUTES} minutes")
    means = [F.avg(metric).alias(name) for name, metric in MEANS.items()]
    return readings.groupBy("city", "country", window.alias("time_window")).agg(
        *means, *_extremes()
    )


def _pane_stats(readings: DataFrame) -> DataFrame:
    """The same result in two steps, for bounded input.

    A sliding window copies each reading into six windows before the map-side combine, and
    struct extremes make that combine a sort. Here readings are first combined, uncopied,
    into slide-long panes; only pane rows are copied. Panes are placed by place and day of
    the window before the copying, so the second aggregation needs no further shuffle and a
    place that holds most of the readings still spreads over its days.
    """
    reach = WINDOW_MINUTES - SLIDE_MINUTES
    sums = [F.sum(F.col(metric).cast("double")).alias(f"{name}_sum") for name, metric in MEANS.items()]
    counts = [F.count(metric).alias(f"{name}_n") for name, metric in MEANS.items()]
    pane = F.window(EVENT_TIME, f"{SLIDE_MINUTES} minutes").start.alias("pane")
    panes = readings.groupBy("city", "country", pane).agg(*sums, *counts, *_extremes())

    first_start = F.expr(f"pane - INTERVAL {reach} MINUTES")
    days = F.array_distinct(F.array(F.to_date("pane"), F.to_date(first_start)))
    placed = panes.withColumn("day", F.explode(days)).repartition("city", "country", "day")
    starts = F.sequence(first_start, F.col("pane"), F.expr(f"INTERVAL {SLIDE_MINUTES} MINUTES"))
    spread = placed.withColumn("start", F.explode(starts)).filter(
        F.to_date("start") == F.col("day")
    )

    means = [
        F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name) for name in MEANS
    ]
    merged = (
        [F.max(name).alias(name) for name in LATEST_MAXIMA]
        + [F.min(name).alias(name) for name in [*EARLIEST_MINIMA, *PLAIN_MINIMA]]
    )
    stats = spread.groupBy("city", "country", "day", "start").agg(*means, *merged)
    end = F.expr(f"start + INTERVAL {WINDOW_MINUTES} MINUTES")
    return stats.select(
        "city",
        "country",
        F.struct("start", end.alias("end")).alias("time_window"),
        *MEANS,
        *LATEST_MAXIMA,
        *EARLIEST_MINIMA,
        *PLAIN_MINIMA,
    )

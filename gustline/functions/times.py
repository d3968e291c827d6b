"""Event time and ingestion time columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of a time.
ALERT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
INGESTED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DISPLAY_OFFSET = "+07:00"


def event_time(epoch_seconds: str | Column = "dt") -> Column:
    """Epoch seconds to a timestamp, without passing through local clock text."""
    return F.timestamp_seconds(epoch_seconds)


def ingested_at(at: Column | None = None) -> Column:
    """One ISO text per batch or micro-batch; pass `at` to fix it."""
    return F.date_format(F.current_timestamp() if at is None else at, INGESTED_AT_FORMAT)


def alert_time_text(time: str | Column) -> Column:
    """A time as it is written in an alert's JSON."""
    return F.date_format(time, ALERT_TIME_FORMAT)


def display_clock(time: str | Column) -> Column:
    """Wall clock of the operators' display offset."""
    return F.date_format(F.from_utc_timestamp(time, DISPLAY_OFFSET), "HH:mm:ss")

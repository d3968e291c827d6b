"""Streaming sinks; every query has its own checkpoint folder."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gustline.sources.envelopes import KAFKA_WRITE, _file_envelopes, alert_envelopes

# Fixed value: the topic of both alert kinds.
ALERT_TOPIC = "weather-alert"


def _writer(frame: DataFrame, checkpoint: str, available_now: bool, name: str | None):
    writer = frame.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return writer.trigger(availableNow=True) if available_now else writer


def write_alerts(
    alerts: DataFrame,
    checkpoint: str,
    kind: str = "kafka",
    servers: str | None = None,
    folder: str | None = None,
    topic: str = ALERT_TOPIC,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Append alerts as JSON messages to Kafka, or as envelope rows to a folder."""
    messages = alert_envelopes(alerts, topic)
    if kind == "files":
        writer = _writer(_file_envelopes(messages), checkpoint, available_now, name)
        return writer.format("parquet").option("path", folder).start()
    if kind != "kafka":
        raise ValueError(f"unknown transport {kind!r}")
    settings = {"kafka.bootstrap.servers": servers, **KAFKA_WRITE}
    return _writer(messages, checkpoint, available_now, name).format("kafka").options(**settings).start()


def write_rows(
    rows: DataFrame, checkpoint: str, folder: str, available_now: bool = False, name: str | None = None
) -> StreamingQuery:
    """Append the rows themselves to a parquet folder."""
    return _writer(rows, checkpoint, available_now, name).format("parquet").option("path", folder).start()


def write_console(
    rows: DataFrame, checkpoint: str, output_mode: str = "append", available_now: bool = False
) -> StreamingQuery:
    """Print whole rows; for watching a stream while developing."""
    writer = _writer(rows, checkpoint, available_now, None).outputMode(output_mode)
    return writer.format("console").option("truncate", False).start()

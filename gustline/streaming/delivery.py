"""Alert messages to notification rows, as a stream."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gustline.operators.alerts import explode_anomalies
from gustline.plans.delivery import notify_whole
from gustline.streaming.jobs import state_settings
from gustline.streaming.suppression import suppress_repeats_stream


def start_notifications(
    alerts: DataFrame,
    checkpoint: str,
    folder: str,
    recipients: str = "",
    clock: str = "event",
    available_now: bool = False,
) -> StreamingQuery:
    """Suppress repeats and write the notifications of each batch below `folder`.

    All anomalies of one alert come in one batch, so a batch can be gathered by alert. A batch
    that is run again overwrites its own folder.
    """
    emitted = suppress_repeats_stream(explode_anomalies(alerts, whole=True), clock=clock)

    def write(batch: DataFrame, number: int) -> None:
        sent = notify_whole(batch, recipients)
        sent.write.mode("overwrite").parquet(f"{folder}/notifications/batch={number}")

    writer = emitted.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    with state_settings(alerts.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()

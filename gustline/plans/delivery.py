"""From alerts to notification rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.operators.alerts import identify, raise_each
from gustline.operators.notifications import enrich, render
from gustline.operators.suppression import suppress_repeats
from gustline.sources.shared import write_stage

def _text(found: DataFrame, recipients: str) -> DataFrame:
    rendered = render(enrich(found), recipients)
    return rendered.select(
        "alert_type", "city", "country", "alert_time", "id", "new_anomalies",
        F.size("anomalies").alias("n_anomalies"), "subject", "body", "recipients",
    )


def notify(known: DataFrame, emitted: DataFrame, recipients: str = "") -> DataFrame:
    """One notification per alert with an emitted anomaly.

    `known` are alerts with their uid (`alerts.identify`). The body lists every anomaly of the
    alert, `new_anomalies` those that were emitted. The uid is made of all fields of an alert, so alerts published
    twice share it and give one notification.
    """
    news = emitted.groupBy("alert_uid").agg(
        F.array_join(F.sort_array(F.collect_set("anomaly")), ",").alias("new_anomalies")
    )
    found = known.join(news, "alert_uid").dropDuplicates(["alert_uid"])
    return _text(found, recipients)


def notify_whole(emitted: DataFrame, recipients: str = "") -> DataFrame:
    """The notifications of emitted rows that hold their whole alert: one aggregation, no join."""
    alert = [name for name in emitted.columns if name not in ("anomaly", "alert_uid")]
    found = emitted.groupBy("alert_uid").agg(
        F.first(F.struct(*alert)).alias("alert"),
        F.array_join(F.sort_array(F.collect_set("anomaly")), ",").alias("new_anomalies"),
    )
    return _text(found.select("alert.*", "new_anomalies"), recipients)


def deliver(alerts: DataFrame, recipients: str = "") -> DataFrame:
    """Suppress repeats and render the rest.

    The alerts are written with their uid, which is so computed once, and read by the suppression
    and by the last join. That join is one of the written alerts with what was emitted; its keys are
    short and the emitted rows few, so Spark can broadcast them below its limit. Jobs start while the result is built.
    """
    known = write_stage(identify(alerts), "alerts")
    emitted = write_stage(suppress_repeats(raise_each(known)).select("alert_uid", "anomaly"), "emitted")
    return notify(known, emitted, recipients)

"""Both alert kinds as one record, and the anomalies raised in each."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.rules import CHANGE_ANOMALIES, THRESHOLD_ANOMALIES
from gustline.operators.windows import WINDOW_MINUTES
from gustline.schemas import ALERT

ANOMALIES = {"threshold": THRESHOLD_ANOMALIES, "change": CHANGE_ANOMALIES}


def unite(thresholds: DataFrame, changes: DataFrame) -> DataFrame:
    """Threshold and change alerts in one frame; absent fields are null."""
    both = thresholds.unionByName(changes, allowMissingColumns=True)
    return both.select(ALERT.fieldNames())


def of_type(alerts: DataFrame, alert_type: str) -> DataFrame:
    """The alerts one handler takes; other types stay with nobody."""
    return alerts.filter(F.col("alert_type") == alert_type)


def alert_time() -> Column:
    """The event time of a reading, or the end of the window for a change."""
    window_end = F.col("window_start") + F.expr(f"INTERVAL {WINDOW_MINUTES} MINUTES")
    return F.when(F.col("alert_type") == "threshold", F.col("event_timestamp")).when(
        F.col("alert_type") == "change", window_end
    )


def identify(alerts: DataFrame) -> DataFrame:
    """Add `alert_time` and `alert_uid`; equal alerts share a uid."""
    uid = F.xxhash64(*[F.col(name) for name in alerts.columns])
    return alerts.withColumns({"alert_time": alert_time(), "alert_uid": uid})


def _raised(name: str) -> Column:
    # True for a set flag and for a label with text, as in the consumer's truth test.
    boolean = ALERT[name].dataType.simpleString() == "boolean"
    return F.col(name) if boolean else F.col(name) != ""


def raised_anomalies() -> Column:
    """Names of the anomalies an alert raises, from the list of its own type."""
    lists = {
        kind: F.array_compact(F.array(*[F.when(_raised(name), F.lit(name)) for name in names]))
        for kind, names in ANOMALIES.items()
    }
    return F.when(F.col("alert_type") == "threshold", lists["threshold"]).when(
        F.col("alert_type") == "change", lists["change"]
    )


def raise_each(identified: DataFrame, whole: bool = False) -> DataFrame:
    """One row per raised anomaly of alerts that have their time and uid already."""
    raised = identified.withColumn("anomaly", F.explode(raised_anomalies()))
    if whole:
        return raised
    return raised.select(
        "city", "country", "alert_type", "anomaly", "alert_time", "id", "alert_uid"
    )


def explode_anomalies(alerts: DataFrame, whole: bool = False) -> DataFrame:
    """One row per alert and raised anomaly, with the columns suppression needs.

    With `whole` all fields of the alert come along, for a stream that renders them later.
    """
    return raise_each(identify(alerts), whole)

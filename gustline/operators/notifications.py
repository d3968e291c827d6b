"""Alerts as notification rows: enriched anomalies, subject, body and recipients."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.text import number_text
from gustline.functions.times import alert_time_text

# Titles, metric names, units and messages.
TITLES = {
    "threshold": "WEATHER WARNING: Exceeding Safety Limits",
    "change": "WEATHER WARNING: Unusual Volatility",
}
NO_TITLE, NO_HEADING = "ALERT", "City Weather Alert"
ABOVE, BELOW = "Exceeding the safety threshold", "Below the safety threshold"
HIGH_PRESSURE = 1033
CELSIUS, HECTOPASCAL, METER, SPEED, PERCENT = "°C", "hPa", "meter", "m/s", "%"
LAST_WINDOW = "in the last 30 minutes"
VISIBILITY_MESSAGE = f"Sudden drop to below 2000 meter {LAST_WINDOW}"


def _item(raised: Column, metric: str, value: Column, message: Column, at: Column) -> Column:
    item = F.struct(
        F.lit(metric).alias("metric"),
        value.alias("value"),
        message.alias("message"),
        at.alias("timestamp"),
    )
    return F.when(raised, item)


def _threshold_items(alerts: DataFrame) -> list[Column]:
    def value(name: str, unit: str) -> Column:
        return F.concat(number_text(alerts.schema, name), F.lit(unit))

    untimed = F.lit(None).cast("string")
    warm = F.when(F.col("temperature") > 0, ABOVE).otherwise(BELOW)
    high = F.when(F.col("pressure") >= HIGH_PRESSURE, ABOVE).otherwise(BELOW)
    return [
        _item(F.col("temp_anomaly"), "Temperature", value("temperature", CELSIUS), warm, untimed),
        _item(F.col("pressure_anomaly"), "Pressure", value("pressure", HECTOPASCAL), high, untimed),
        _item(F.col("visibility_anomaly"), "Visibility", value("visibility", METER), F.lit(BELOW), untimed),
        _item(F.col("wind_anomaly"), "Wind Speed", value("wind_speed", SPEED), F.lit(ABOVE), untimed),
    ]


def _change_items(alerts: DataFrame) -> list[Column]:
    def sudden(kind: str, name: str, unit: str) -> Column:
        number = number_text(alerts.schema, name)
        return F.concat(F.lit(f"Sudden {kind} of "), number, F.lit(f"{unit} {LAST_WINDOW}"))

    def item(label: str, metric: str, value: str, unit: str, time: str, message: Column, on=True):
        raised = (F.col(label) != "") & on
        text = F.concat(number_text(alerts.schema, value), F.lit(unit))
        return _item(raised, f"{metric} fluctuation", text, message, alert_time_text(time))

    rising = F.col("temp_change_anomaly") == "rise rapidly"
    return [
        item("temp_change_anomaly", "Temperature", "max_temp", CELSIUS, "max_temp_time",
             sudden("increase", "temp_rise", CELSIUS), rising),
        item("temp_change_anomaly", "Temperature", "min_temp", CELSIUS, "min_temp_time",
             sudden("decrease", "temp_fall", CELSIUS), ~rising),
        item("wind_change_anomaly", "Wind speed", "max_wind", SPEED, "max_wind_time",
             sudden("increase", "wind_rise", SPEED)),
        item("pressure_change_anomaly", "Pressure", "min_pressure", HECTOPASCAL, "min_pressure_time",
             sudden("drop", "pressure_drop", HECTOPASCAL)),
        item("humidity_change_anomaly", "Humidity", "max_humidity", PERCENT, "max_humid_time",
             sudden("increase", "humidity_rise", PERCENT)),
        item("visibility_change_anomaly", "Visibility", "min_visibility", METER, "min_visibility_time",
             F.lit(VISIBILITY_MESSAGE)),
    ]


def enrich(alerts: DataFrame) -> DataFrame:
    """Add `anomalies`, one entry per raised anomaly, and the `timestamp` text of the alert."""
    threshold = F.col("alert_type") == "threshold"
    listed = (
        F.when(threshold, F.array_compact(F.array(*_threshold_items(alerts))))
        .when(F.col("alert_type") == "change", F.array_compact(F.array(*_change_items(alerts))))
    )
    return alerts.withColumns(
        {
            "timestamp": F.when(threshold, alert_time_text("event_timestamp")),
            "anomalies": listed,
        }
    )


def _title(otherwise: str) -> Column:
    titles = F.when(F.col("alert_type") == "threshold", TITLES["threshold"])
    return titles.when(F.col("alert_type") == "change", TITLES["change"]).otherwise(otherwise)


def subject() -> Column:
    return F.concat(_title(NO_TITLE), F.lit(": "), F.coalesce("city", F.lit("Unknown")))


def body() -> Column:
    """HTML text; the time stands in the head of a threshold alert, in the items of a change."""
    kind = F.coalesce("alert_type", F.lit("UNKNOWN"))

    def line(label: str, *parts: Column) -> Column:
        return F.concat(F.lit(f"<li>{label}: "), *parts, F.lit("</li>"))

    def item(entry: Column) -> Column:
        at = F.concat(F.lit(", at "), F.coalesce(entry["timestamp"], F.lit("")))
        return F.concat(
            F.lit("<li><b>"), F.coalesce(entry["metric"], F.lit("Unknown")), F.lit("</b>: "),
            F.coalesce(entry["value"], F.lit("N/A")), F.lit(", "),
            F.coalesce(entry["message"], F.lit("")),
            F.when(kind == "change", at).otherwise(""), F.lit("</li>"),
        )

    place = [F.coalesce("city", F.lit("Unknown")), F.lit(", "), F.coalesce("country", F.lit(""))]
    detected = line("Time detected", F.coalesce("timestamp", F.lit("")))
    items = F.array_join(F.transform(F.coalesce("anomalies", F.array()), item), "")
    return F.concat(
        F.lit("<html><body><h2>"), _title(NO_HEADING), F.lit("</h2><ul>"),
        line("City", *place),
        line("Alert type", F.upper(kind), F.lit(" ALERT")),
        F.when(kind == "threshold", detected).otherwise(""),
        F.lit("</ul><ul>"), items, F.lit("</ul></body></html>"),
    )


def render(enriched: DataFrame, recipients: str | Column = "") -> DataFrame:
    """Add `subject`, `body` and the `recipients` line from a comma-separated list."""
    listed = F.lit(recipients) if isinstance(recipients, str) else recipients
    line = F.array_join(F.split(listed, ","), ", ")
    return enriched.withColumns({"subject": subject(), "body": body(), "recipients": line})

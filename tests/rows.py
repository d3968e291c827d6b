"""Hand-written readings."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

DAY = datetime(2024, 3, 1)
METRICS = dict(temperature=20.0, pressure=1010, humidity=50, visibility=9000, wind_speed=3.0)
LAYOUT = (
    "id BIGINT, city STRING, country STRING, weather_main STRING, weather_description STRING, "
    "temperature DOUBLE, pressure BIGINT, humidity BIGINT, visibility BIGINT, wind_speed DOUBLE, "
    "event_timestamp TIMESTAMP"
)


def reading(id=1, city="Ha Noi", country="VN", minute=0.0, **metrics):
    at = DAY + timedelta(minutes=minute)
    values = {**METRICS, **metrics}
    return (id, city, country, "Clear", "clear sky", values["temperature"], values["pressure"],
            values["humidity"], values["visibility"], values["wind_speed"], at)


def readings(spark, rows):
    return spark.createDataFrame(rows, LAYOUT)


def naive(frame, *names):
    return frame.select([F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n)
                         for n, t in frame.select(*names).dtypes])

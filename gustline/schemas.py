"""Record layouts, stated once and used by every reader, writer and test."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

BINARY, BOOLEAN, TEXT, TIME = BinaryType(), BooleanType(), StringType(), TimestampType()
DOUBLE, FLOAT, INT, LONG = DoubleType(), FloatType(), IntegerType(), LongType()


def record(required: tuple[str, ...] = (), **fields: DataType) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in fields.items()])


# Field names and types of the record contracts.

READING = record(
    required=("ingested_at",),
    id=LONG, city=TEXT, country=TEXT, weather_main=TEXT, weather_description=TEXT,
    temperature=FLOAT, pressure=LONG, humidity=LONG, visibility=LONG, wind_speed=FLOAT,
    dt=LONG, ingested_at=TEXT,
)

# A later layout of the readings, as a registry would hold it beside the first: fewer fields, one more, wider numbers.
READING_V2 = record(
    id=LONG, city=TEXT, country=TEXT, temperature=DOUBLE, humidity=LONG, dt=LONG, ingested_at=TEXT, station=TEXT,
)

READING_PAYLOAD = record(
    id=LONG, name=TEXT, sys=record(country=TEXT),
    weather=ArrayType(record(main=TEXT, description=TEXT)),
    main=record(temp=FLOAT, pressure=LONG, humidity=LONG),
    visibility=LONG, wind=record(speed=FLOAT), dt=LONG,
)

TEAM = record(id=LONG, name=TEXT, shortName=TEXT, tla=TEXT, crest=TEXT)
GOALS = record(home=INT, away=INT)
MATCH_PAYLOAD = record(
    area=record(id=LONG, name=TEXT, code=TEXT, flag=TEXT),
    competition=record(id=LONG, name=TEXT, code=TEXT, type=TEXT, emblem=TEXT),
    season=record(id=LONG, startDate=TEXT, endDate=TEXT, currentMatchday=INT, winner=TEXT),
    id=LONG, utcDate=TEXT, status=TEXT, matchday=INT, stage=TEXT, group=TEXT, lastUpdated=TEXT,
    homeTeam=TEAM, awayTeam=TEAM,
    score=record(
        winner=TEXT, duration=TEXT, fullTime=GOALS, halfTime=GOALS, regularTime=GOALS,
        extraTime=GOALS, penalties=GOALS,
    ),
    odds=record(msg=TEXT),
    referees=ArrayType(record(id=LONG, name=TEXT, type=TEXT, nationality=TEXT)),
)
MATCH = StructType([*MATCH_PAYLOAD, StructField("ingested_at", TEXT, False)])

ENVELOPE = record(
    key=BINARY, value=BINARY, topic=TEXT, partition=INT, offset=LONG, timestamp=TIME
)

THRESHOLD_ALERT_COLUMNS = [
    "event_timestamp", "alert_type", "id", "city", "country", "weather_main",
    "weather_description", "temperature", "pressure", "humidity", "visibility", "wind_speed",
    "temp_anomaly", "pressure_anomaly", "visibility_anomaly", "wind_anomaly",
]
CHANGE_ALERT_COLUMNS = [
    "alert_type", "city", "country", "window_start",
    "max_temp", "max_temp_time", "min_temp", "min_temp_time", "temp_rise", "temp_fall",
    "temp_change_anomaly",
    "max_wind", "max_wind_time", "wind_rise", "wind_change_anomaly",
    "min_pressure", "min_pressure_time", "pressure_drop", "pressure_change_anomaly",
    "max_humidity", "max_humid_time", "humidity_rise", "humidity_change_anomaly",
    "min_visibility", "min_visibility_time", "visibility_change_anomaly",
]

# Both alert kinds share one topic; a field the other kind does not have is null.
ALERT = record(
    alert_type=TEXT, city=TEXT, country=TEXT,
    event_timestamp=TIME, id=LONG, weather_main=TEXT, weather_description=TEXT,
    temperature=DOUBLE, pressure=LONG, humidity=LONG, visibility=LONG, wind_speed=DOUBLE,
    temp_anomaly=BOOLEAN, pressure_anomaly=BOOLEAN, visibility_anomaly=BOOLEAN,
    wind_anomaly=BOOLEAN,
    window_start=TIME,
    max_temp=DOUBLE, max_temp_time=TIME, min_temp=DOUBLE, min_temp_time=TIME,
    temp_rise=DOUBLE, temp_fall=DOUBLE, temp_change_anomaly=TEXT,
    max_wind=DOUBLE, max_wind_time=TIME, wind_rise=DOUBLE, wind_change_anomaly=TEXT,
    min_pressure=LONG, min_pressure_time=TIME, pressure_drop=LONG, pressure_change_anomaly=TEXT,
    max_humidity=LONG, max_humid_time=TIME, humidity_rise=LONG, humidity_change_anomaly=TEXT,
    min_visibility=LONG, min_visibility_time=TIME, visibility_change_anomaly=TEXT,
)

# A line of the log of loads: which folder holds a table's day since when, in microseconds.
LOAD = record(load=TEXT, at=LONG, date=TEXT, table=TEXT, location=TEXT)

# Raw tables; the partition columns follow the folder layout of sources.landing.
RAW_TABLES = {
    "weather_data": record(
        city=TEXT, country=TEXT, weather_main=TEXT, weather_description=TEXT,
        temperature=DOUBLE, pressure=INT, humidity=INT, visibility=INT, wind_speed=DOUBLE,
        record_timestamp=TEXT,
    ),
    "financial_data": record(
        symbol=TEXT, txn_date=TEXT, open=DOUBLE, high=DOUBLE, low=DOUBLE, close=DOUBLE,
        volume=INT, record_timestamp=TEXT,
    ),
}

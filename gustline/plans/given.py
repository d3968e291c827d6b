"""The given tables seen as readings, payloads and matches."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from gustline.functions.times import event_time

PLACES = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A pattern, because the file source takes a plain path for a folder.
    layout = table(spark, sf_dir, name).schema
    return spark.readStream.schema(layout).parquet(f"{sf_dir}/{name}.parque[t]")


def as_readings(events: DataFrame) -> DataFrame:
    """Events as readings: the type is the city, the value and the number in the properties
    give the metrics, and time counts in epoch seconds."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    us = F.col("event_type").isin("click", "view", "purchase")
    return events.withColumn("k", k).select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("city"),
        F.when(us, "US").otherwise("VN").alias("country"),
        F.when(F.col("k") < 50, "Clear").otherwise("Clouds").alias("weather_main"),
        F.concat(F.lit("cover "), F.col("k")).alias("weather_description"),
        (F.col("value") / 5 - 2).alias("temperature"),
        F.nullif(985 + F.col("k") % 60, F.lit(1000)).alias("pressure"),
        F.nullif(F.col("k"), F.lit(13)).alias("humidity"),
        (10000 - F.col("k") * 100).alias("visibility"),
        (F.col("k") % 15).cast("double").alias("wind_speed"),
        event_time(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("event_timestamp"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def reading_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table_stream(spark, sf_dir, "events"))


def reading_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as nested JSON texts; some lack a part, some have an empty list."""
    r = readings(spark, sf_dir).withColumn("k", F.col("visibility") / -100 + 100)
    sky = F.struct(F.col("weather_main").alias("main"), F.col("weather_description").alias("description"))
    payload = F.struct(
        "id",
        F.col("city").alias("name"),
        F.when(F.col("k") % 7 != 0, F.struct("country")).alias("sys"),
        F.when(F.col("k") % 11 != 0, F.array(sky)).otherwise(F.array()).alias("weather"),
        F.struct(F.col("temperature").alias("temp"), "pressure", "humidity").alias("main"),
        "visibility",
        F.when(F.col("k") % 5 != 0, F.struct(F.col("wind_speed").alias("speed"))).alias("wind"),
        F.unix_seconds("event_timestamp").alias("dt"),
    )
    return r.select(F.to_json(payload).alias("value"))


def spoiled_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading payloads with their id, every seventeenth cut off and every thirteenth with a word for its time."""
    payloads = reading_payloads(spark, sf_dir).withColumn("id", F.get_json_object("value", "$.id").cast("bigint"))
    cut = F.expr("substring(value, 1, length(value) - 5)")
    worded = F.regexp_replace("value", r'"dt":\d+', '"dt":"noon"')
    spoiled = F.when(F.col("id") % 17 == 0, cut).when(F.col("id") % 13 == 0, worded).otherwise(F.col("value"))
    return payloads.select("id", spoiled.alias("value"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of the second raw table, dated by the month's first day."""
    price = F.col("o_totalprice").cast("double")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("txn_date"),
        price.alias("open"), (price + 2).alias("high"), (price - 2).alias("low"), (price + 1).alias("close"),
        (F.col("o_custkey") % 1000).cast("int").alias("volume"),
        F.lit("2024-02-01T00:00:00.000000").alias("record_timestamp"),
        F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("date"),
    )


def match_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as polls: two legs of one match, or none for an urgent order."""
    return _polls(spark, sf_dir).select("value")


def spoiled_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls with their number, every seventeenth cut off, every thirteenth with a word for its first id, and every
    eleventh, if it has matches, with a number behind them."""
    cut = F.expr("substring(value, 1, length(value) - 5)")
    worded = F.regexp_replace("value", r'^\{"matches":\[\{"id":\d+', '{"matches":[{"id":"none"')
    more = F.regexp_replace("value", r"\}\]\}$", "},5]}")
    by = F.col("poll")
    spoiled = F.when(by % 17 == 0, cut).when(by % 13 == 0, worded).when(by % 11 == 0, more).otherwise(F.col("value"))
    return _polls(spark, sf_dir).select("poll", spoiled.alias("value"))


def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").when(
        F.col("o_orderstatus") == "O", "TIMED"
    )

    def team(key) -> Column:
        return F.struct(key.alias("id"), F.concat(F.lit("Team "), key).alias("name"))

    def leg(number: int) -> Column:
        home = F.col("o_custkey")
        away = home + 1
        kickoff = F.date_add(F.to_date("o_orderdate"), 7 * number)
        goals = F.struct((home % 5).alias("home"), (away % 4).alias("away"))
        return F.struct(
            (F.col("o_orderkey") * 2 + number).alias("id"),
            F.concat(kickoff.cast("string"), F.lit("T15:00:00Z")).alias("utcDate"),
            status.alias("status"),
            F.lit(number + 1).alias("matchday"),
            team(home if number == 0 else away).alias("homeTeam"),
            team(away if number == 0 else home).alias("awayTeam"),
            F.struct(goals.alias("fullTime")).alias("score"),
        )

    legs = F.array(leg(0), leg(1))
    matches = F.when(F.col("o_orderpriority") == "1-URGENT", F.filter(legs, lambda _: F.lit(False)))
    return o.select(F.col("o_orderkey").alias("poll"), F.to_json(F.struct(matches.otherwise(legs).alias("matches"))).alias("value"))


def comparable(frame: DataFrame) -> DataFrame:
    """Times without zone, and averages without the noise of the order of summing."""

    def plain(field):
        if isinstance(field.dataType, TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, DoubleType):
            return F.round(field.name, PLACES).alias(field.name)
        return F.col(field.name)

    return frame.select([plain(field) for field in frame.schema])

"""Raw reading payloads to flat readings."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gustline.functions.times import event_time, ingested_at
from gustline.schemas import READING, READING_PAYLOAD

# The places polled.
PLACES = [
    ("New York", "US"),
    ("Los Angeles", "US"),
    ("Chicago", "US"),
    ("Ha Noi", "VN"),
    ("Ho Chi Minh City", "VN"),
]


CORRUPT, PARSED = "_corrupt", "_parsed"
# Why a payload is rejected.
NOT_JSON, WRONG_TYPE = "not an object", "wrong type"


def parse_payloads(raw: DataFrame, at: Column | None = None, value: str = "value") -> DataFrame:
    """The payloads with all their columns, the `reading` each makes, and the `reason` why it makes none.

    A missing key at any depth gives null. A payload that is no JSON object or has a field of a wrong type is
    rejected. Every text is parsed once: what a generator makes cannot be copied into the filters and projections above it.
    """
    layout = StructType([*READING_PAYLOAD.fields, StructField(CORRUPT, StringType())])
    text = F.col(value).cast("string")
    parsed = F.from_json(text, layout, {"columnNameOfCorruptRecord": CORRUPT})
    paths = {
        "id": "id",
        "city": "name",
        "country": "sys.country",
        "temperature": "main.temp",
        "pressure": "main.pressure",
        "humidity": "main.humidity",
        "visibility": "visibility",
        "wind_speed": "wind.speed",
        "dt": "dt",
    }
    sky = F.get(f"{PARSED}.weather", F.lit(0))
    columns = {name: F.col(f"{PARSED}.{path}") for name, path in paths.items()}
    columns["weather_main"] = sky["main"]
    columns["weather_description"] = sky["description"]
    columns["ingested_at"] = ingested_at(at)
    reading = F.struct(*[columns[name].alias(name) for name in READING.fieldNames()])
    bad = F.col(PARSED).isNull() | F.col(f"{PARSED}.{CORRUPT}").isNotNull()
    reason = F.when(bad, F.when(is_object(text), WRONG_TYPE).otherwise(NOT_JSON))
    made = raw.select("*", F.explode(F.array(parsed)).alias(PARSED))
    return made.select(*raw.columns, reading.alias("reading"), reason.alias("reason"))


def is_object(text: Column) -> Column:
    return F.coalesce(F.json_object_keys(text).isNotNull(), F.lit(False))


def count_outcomes(parsed: DataFrame) -> dict:
    """How many parsed payloads, or elements of polls, there are, and how many of them were rejected."""
    return parsed.agg(F.count("*").alias("n"), F.count("reason").alias("n_rejected")).first().asDict()


def payload_rejects(raw: DataFrame, value: str = "value") -> DataFrame:
    """The payloads that make no reading, with all their columns and a `reason`."""
    return parse_payloads(raw, value=value).filter("reason IS NOT NULL").drop("reading")


def flatten_payloads(raw: DataFrame, at: Column | None = None, value: str = "value") -> DataFrame:
    """One reading per JSON object; a missing key at any depth gives null.

    Rejected payloads make no reading: `payload_rejects` returns them.
    """
    return parse_payloads(raw, at, value).filter("reason IS NULL").select("reading.*")


def with_event_time(readings: DataFrame) -> DataFrame:
    return readings.withColumn("event_timestamp", event_time("dt"))


def in_places(readings: DataFrame, places: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """Readings of the allowed (city, country) pairs.

    A short list becomes a predicate the scan can use; a DataFrame becomes a semi join whose
    strategy Spark picks by the size of that side.
    """
    if isinstance(places, DataFrame):
        return readings.join(places, ["city", "country"], "left_semi")
    pairs = ((F.col("city") == city) & (F.col("country") == country) for city, country in places)
    return readings.filter(reduce(or_, pairs, F.lit(False)))

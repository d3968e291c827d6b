"""Record checks: row count and required keys."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Required keys, the sets that may be empty, and the texts of a result.
READING_KEYS = (
    "city", "country", "temperature", "pressure", "humidity", "visibility", "ingested_at",
)
MATCH_KEYS = ("id", "utcDate", "homeTeam", "awayTeam", "score", "ingested_at")
MAY_BE_EMPTY = ("live_football", "recent_finish_football")
PASS, PASS_EMPTY, FAIL_EMPTY = "PASS", "PASS (Zero allowed)", "FAIL (Zero Count)"
MISSING = "Missing one or more required fields: "


class ValidationError(ValueError):
    """A data set failed its check."""


def lacks_keys(required: Iterable[str], value: str = "value") -> Column:
    """Whether a JSON record lacks one of the keys; a key with a null value is present."""
    keys = F.json_object_keys(F.col(value).cast("string"))
    wanted = F.array(*[F.lit(key) for key in sorted(required)]).cast("array<string>")
    return F.coalesce(F.size(F.array_except(wanted, keys)) != 0, F.lit(True))


def judge_counts(counted: DataFrame, required: Iterable[str]) -> DataFrame:
    """Status, key check and failed conditions for rows of data_name, records_count and `lacking`.

    No record at all has no required key.
    """
    required = sorted(required)
    empty = F.col("records_count") == 0
    complete = (F.col("lacking") == 0) & ~empty if required else F.lit(True)
    when_empty = F.when(F.col("data_name").isin(*MAY_BE_EMPTY), PASS_EMPTY).otherwise(FAIL_EMPTY)
    missing = F.lit(MISSING + ", ".join(required))
    return counted.select(
        "data_name",
        "records_count",
        F.when(empty, when_empty).otherwise(PASS).alias("status"),
        complete.alias("has_required_fields"),
    ).withColumn(
        "failed_conditions",
        F.concat_ws(
            ", ",
            F.when(F.startswith("status", F.lit("FAIL")), F.col("status")),
            F.when(~F.col("has_required_fields"), missing),
        ),
    )


def check_records(
    records: DataFrame, data_name: str, required: Iterable[str] = (), value: str = "value"
) -> DataFrame:
    """One row: count, status, whether every JSON record has all keys, failed conditions."""
    required = tuple(required)
    counted = records.agg(
        F.count("*").alias("records_count"),
        (F.count_if(lacks_keys(required, value)) if required else F.lit(0)).alias("lacking"),
    )
    return judge_counts(counted.withColumn("data_name", F.lit(data_name)), required)


def check_groups(
    records: DataFrame, names: dict[str, str], group: str, required: Iterable[str] = (), value: str = "value"
) -> DataFrame:
    """The checks of several sets that lie in one frame, by one aggregation: `names` maps the
    values of the column `group` to the names of their sets. Absent sets count zero records."""
    required = tuple(required)
    lacking = F.count_if(lacks_keys(required, value)) if required else F.lit(0)
    counted = records.groupBy(F.col(group).alias("_set")).agg(F.count("*").alias("n"), lacking.alias("l"))
    wanted = records.sparkSession.createDataFrame(list(names.items()), "_set string, data_name string")
    counted = wanted.join(counted, "_set", "left").select(
        "data_name", F.coalesce("n", F.lit(0)).alias("records_count"), F.coalesce("l", F.lit(0)).alias("lacking")
    )
    return judge_counts(counted, required)


def failures(checked: DataFrame) -> list[str]:
    """What failed in a frame of checks, which has a row for each set."""
    return [f"{r.data_name}: {r.failed_conditions}" for r in checked.filter("failed_conditions <> ''").collect()]


def validate(
    records: DataFrame, data_name: str, required: Iterable[str] = (), value: str = "value"
) -> dict:
    """The check's row as a dict; raises when a condition failed."""
    checked = check_records(records, data_name, required, value)
    result = checked.withColumn("timestamp", F.current_timestamp()).first().asDict()
    failed = result.pop("failed_conditions")
    if failed:
        raise ValidationError(f"the set {data_name} did not pass: {failed}")
    return result

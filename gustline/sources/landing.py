"""Landing raw records in day folders, and what lies there."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ["year", "month", "day"]


def day_folder(root: str, date: str) -> str:
    return f"{root}/year={date[0:4]}/month={date[5:7]}/day={date[8:10]}"


def land_day(records: DataFrame, root: str, date: str) -> None:
    """Write the records of one ISO date as JSON, replacing that day only."""
    records.write.mode("overwrite").json(day_folder(root, date))


def with_partitions(records: DataFrame, date: str = "date") -> DataFrame:
    """Add year, month and day texts cut from an ISO date text."""
    parts = {"year": (1, 4), "month": (6, 2), "day": (9, 2)}
    return records.withColumns(
        {name: F.substring(date, start, length) for name, (start, length) in parts.items()}
    )


def land_days(records: DataFrame, root: str, date: str = "date") -> None:
    """Write many days at once, replacing the days that occur in the records.

    The rebalance hint gathers a day in few files and lets Spark split a day that is too big
    for one task.
    """
    placed = with_partitions(records, date).drop(date)
    placed = placed.hint("rebalance", *PARTITIONS)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITIONS).json(root)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per landed day, from the listing alone: no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, "
                "year STRING, month STRING, day STRING")
        .load(root)
    )
    return files.groupBy(*PARTITIONS).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
    )

"""Days of raw tables in versioned folders: written aside, then committed for all tables of a load at once.

A load writes each table's day to a folder of its own. One row per table, in one file of the log of loads, is the commit:
who reads the log sees all of a load or nothing of it. A load may replace one day or many. Then the catalog follows, by the location of
the day's partition; where that was cut short, `follow` does it again from the log.
"""

from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustline.schemas import LOAD
from gustline.sources.tables import literal

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
#: Names the days within the folder of a load of many days.
DAY_KEY = "load_day"


def write_day(records: DataFrame, root: str, date: str) -> str:
    """Write the records of one ISO date as JSON beside the table's folder, which no reader looks at; returns the new folder."""
    location = f"{root}-versions/{date}/{uuid4().hex}"
    records.write.json(location)
    return location


def write_days(records: DataFrame, root: str, date: str = "date") -> dict[str, str]:
    """Write the records of many ISO dates in one pass, each day to a folder of its own; returns the new folders by date.

    The rebalance hint gathers a day in few files and splits a day that is too big for one task. A record
    without an ISO date fails the write. Without records there are no folders.
    """
    folder = f"{root}-versions/days-{uuid4().hex}"
    day = F.when(F.col(date).rlike(ISO_DATE), F.col(date)).otherwise(F.raise_error(F.lit("a record has no ISO date")))
    records.withColumn(DAY_KEY, day).drop(date).hint("rebalance", DAY_KEY).write.partitionBy(DAY_KEY).json(folder)
    spark = records.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [found.getPath().getName() for found in store.listStatus(path) if found.isDirectory()]
    return {name.removeprefix(f"{DAY_KEY}="): f"{folder}/{name}" for name in sorted(names)}


def commit(spark: SparkSession, log: str, date: str, locations: dict[str, str]) -> None:
    """Make the folders the day's versions of their tables, all at once."""
    commit_days(spark, log, {table: {date: location} for table, location in locations.items()})


def commit_days(spark: SparkSession, log: str, locations: dict[str, dict[str, str]]) -> None:
    """Make the folders, by table and date, the versions of their days, all at once."""
    load = uuid4().hex
    found = sorted((load, date, table, location) for table, days in locations.items() for date, location in days.items())
    if not found:
        return
    rows = spark.createDataFrame(found, "load STRING, date STRING, table STRING, location STRING")
    stamped = rows.withColumn("at", F.unix_micros(F.current_timestamp())).select(LOAD.fieldNames())
    # A folder for each load: writers at the same time do not clear each other's unfinished files.
    stamped.coalesce(1).write.json(f"{log}/{found[0][1]}-{load}")


def loads(spark: SparkSession, log: str) -> DataFrame:
    """All versions that were committed: load, at, date, table, location."""
    return spark.read.schema(LOAD).option("recursiveFileLookup", True).json(log)


def current(spark: SparkSession, log: str) -> DataFrame:
    """The version that counts, of each table and date: that of the last load."""
    last = Window.partitionBy("table", "date").orderBy(F.desc("at"), F.desc("load"))
    return loads(spark, log).withColumn("nth", F.row_number().over(last)).where("nth = 1").drop("nth")


def follow(spark: SparkSession, log: str, database: str, date: str | Iterable[str] | None = None) -> int:
    """Point the tables' partitions at their versions, of one date, of several or, in a new catalog, of all; returns how many."""
    rows = current(spark, log)
    if date is not None:
        rows = rows.where(F.col("date").isin([date] if isinstance(date, str) else list(date)))
    versions = rows.select("table", "date", "location").collect()
    for table, day, location in versions:
        name, where = f"`{database}`.`{table}`", f"PARTITION (year='{day[0:4]}', month='{day[5:7]}', day='{day[8:10]}')"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {where} LOCATION {literal(location)}")
        spark.sql(f"ALTER TABLE {name} {where} SET LOCATION {literal(location)}")
    for table in {row.table for row in versions}:
        spark.catalog.refreshTable(f"`{database}`.`{table}`")
    return len(versions)


def remove_old(spark: SparkSession, log: str, root: str, date: str, older_than_seconds: int = 86_400) -> list[str]:
    """Delete the folders of a date that no committed version names and that have lain for a while; returns them.

    A load that is still writing, and a reader that began before the last commit, are left alone for that time.
    """
    def tail(location: str) -> str:
        return "/".join(location.rstrip("/").rsplit("/", 2)[-2:])

    kept = {tail(row.location) for row in current(spark, log).where(F.col("date") == date).collect()}
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{root}-versions")
    store = base.getFileSystem(spark._jsc.hadoopConfiguration())

    def children(path) -> list:
        return list(store.listStatus(path)) if store.exists(path) else []

    versions = children(spark._jvm.org.apache.hadoop.fs.Path(base, date))
    for load in children(base):
        if load.getPath().getName().startswith("days-"):
            versions += [found for found in children(load.getPath()) if found.getPath().getName() == f"{DAY_KEY}={date}"]
    latest = spark._jvm.java.lang.System.currentTimeMillis() - 1000 * older_than_seconds
    removed = []
    for found in versions:
        name = tail(found.getPath().toString())
        if name not in kept and found.getModificationTime() <= latest:
            store.delete(found.getPath(), True)
            removed.append(name)
    return sorted(removed)

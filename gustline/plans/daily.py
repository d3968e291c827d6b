"""The daily batch: read raw payloads, check, land, register."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.operators.quality import READING_KEYS, ValidationError, validate
from gustline.operators.readings import count_outcomes, parse_payloads
from gustline.schemas import RAW_TABLES
from gustline.sources import tables, versions
from gustline.sources.shared import write_stage

# Folder of each raw table.
FOLDERS = {"weather_data": "weather", "financial_data": "stock"}
# The log of loads, beside the tables' folders.
LOADS = "loads"


def raw_readings(readings: DataFrame, *more: Column) -> DataFrame:
    """Readings in the columns and types of the raw table, and what else is asked for."""
    stamped = readings.withColumn("record_timestamp", F.col("ingested_at"))
    return stamped.select(
        *[F.col(field.name).cast(field.dataType) for field in RAW_TABLES["weather_data"]], *more
    )


def _create(spark: SparkSession, out_dir: str, database: str) -> None:
    tables.create_raw_database(spark, f"{out_dir}/{database}", database)
    for name, folder in FOLDERS.items():
        tables.create_raw_table(spark, name, f"{out_dir}/{folder}", database)


def land_sets(
    spark: SparkSession, sets: dict[str, DataFrame], date: str, out_dir: str, database: str = tables.RAW_DATABASE
) -> None:
    """Replace one ISO date of the raw tables, named by their folders, all together or not at all.

    Every set is written to a new folder first. Only when all are there does one commit make them the
    day's versions, and the catalog's partitions move to them. A load that fails before leaves the old day as it was;
    its folders are garbage for `versions.remove_old`. What was committed by a load that broke off before the
    catalog followed comes in with the next load of the date, or with `versions.follow`.
    """
    _create(spark, out_dir, database)
    written = {
        name: versions.write_day(sets[folder], f"{out_dir}/{folder}", date) for name, folder in FOLDERS.items() if folder in sets
    }
    versions.commit(spark, f"{out_dir}/{LOADS}", date, written)
    versions.follow(spark, f"{out_dir}/{LOADS}", database, date)


def land_history(
    spark: SparkSession, sets: dict[str, DataFrame], out_dir: str, database: str = tables.RAW_DATABASE, date: str = "date"
) -> list[str]:
    """Replace, in each raw table, all days that occur in its set, of all tables together or not at all; returns the days.

    `date` names the column with the ISO date, which is not landed. Days that do not occur stay as they are. Each set is
    written in one pass; what `land_sets` says of loads that break off holds here.
    """
    _create(spark, out_dir, database)
    written = {
        name: versions.write_days(sets[folder], f"{out_dir}/{folder}", date) for name, folder in FOLDERS.items() if folder in sets
    }
    days = sorted({day for found in written.values() for day in found})
    versions.commit_days(spark, f"{out_dir}/{LOADS}", written)
    if days:
        versions.follow(spark, f"{out_dir}/{LOADS}", database, days)
    return days


def run_batch(
    spark: SparkSession,
    raw_dir: str,
    date: str,
    out_dir: str,
    database: str = tables.RAW_DATABASE,
    at: datetime | None = None,
    stock: bool = False,
    most_rejects: int | None = None,
) -> dict:
    """Load one ISO date; running it again replaces that date.

    Reads `<raw_dir>/weather/<date>*` as reading payloads, one JSON text per line, and, with
    `stock`, `<raw_dir>/stock/<date>*` as rows of the other raw table. Returns the checks' results by set
    name. Payloads that make no reading are not landed; more of them than `most_rejects` fail the load, and so does a set
    without rows. Nothing is landed unless all sets pass.
    """
    raw = spark.read.text(f"{raw_dir}/weather/{date}*")
    parsed = write_stage(parse_payloads(raw, at=None if at is None else F.lit(at)), "readings")
    counted = count_outcomes(parsed)
    if most_rejects is not None and counted["n_rejected"] > most_rejects:
        raise ValidationError(f"{counted['n_rejected']} of {counted['n']} payloads of {date} make no reading")
    readings = parsed.filter("reason IS NULL").select("reading.*")
    records = readings.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    results = {"weather": {**validate(records, "weather", READING_KEYS), "rejected": counted["n_rejected"]}}
    sets = {"weather": raw_readings(readings)}
    if stock:
        sets["stock"] = spark.read.schema(RAW_TABLES["financial_data"]).json(f"{raw_dir}/stock/{date}*")
        values = sets["stock"].select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        results["stock"] = validate(values, "stock", [f.name for f in RAW_TABLES["financial_data"]])

    land_sets(spark, sets, date, out_dir, database)
    return results

"""Catalog entries over landed raw records."""

from pyspark.sql import SparkSession

from gustline.schemas import RAW_TABLES

# The raw database (a fixed value) and a note on it.
RAW_DATABASE = "bronze_db"
RAW_COMMENT = "Records as they came, by day"


def literal(text: str) -> str:
    """The text as a SQL string, whatever characters it holds."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_raw_database(spark: SparkSession, location: str, database: str = RAW_DATABASE) -> None:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name) COMMENT {literal(RAW_COMMENT)} LOCATION {literal(location)}",
        args={"name": f"`{database}`"},
    )


def create_raw_table(
    spark: SparkSession, name: str, location: str, database: str = RAW_DATABASE, like: str | None = None
) -> str:
    """An external JSON table over the day folders; returns its full name."""
    fields = RAW_TABLES[like or name]
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) "
        f"({columns}, year STRING, month STRING, day STRING) "
        f"USING json PARTITIONED BY (year, month, day) LOCATION {literal(location)}",
        args={"name": f"`{database}`.`{name}`"},
    )
    return f"{database}.{name}"


def add_day(spark: SparkSession, table: str, date: str) -> None:
    """Register the folder of one ISO date, without listing the others."""
    year, month, day = date[0:4], date[5:7], date[8:10]
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (year='{year}', month='{month}', day='{day}')")
    spark.catalog.refreshTable(table)


def discover_partitions(spark: SparkSession, table: str) -> None:
    """Register the folders that were landed since the last call."""
    spark.sql(f"MSCK REPAIR TABLE {table}")

"""Folders that polls of the services land in as texts, one payload to a line."""

from pyspark.sql import DataFrame, SparkSession

from gustline.sources.envelopes import TRIGGER_LIMITS


def read_payloads(spark: SparkSession, folder: str, archive: str | None = None, **options: str) -> DataFrame:
    """The payloads of a folder as a stream; each file is read once.

    Without `archive` files stay where they are and are listed again by every trigger. With it they move there, with their whole
    path below it, when the trigger after the one that read them begins: what a query has to read again
    after it broke off still lies in the folder, and the files of the last trigger stay until the next. The archive must be
    at least two folders deep, on the same file system, and not within the folder. Several queries must not share a folder that is
    archived. One trigger reads no more files than `TRIGGER_LIMITS` say, unless the options give another limit.
    """
    moved = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    return spark.readStream.options(**{**TRIGGER_LIMITS["files"], **moved, **options}).text(folder)


def archived_payloads(spark: SparkSession, archive: str) -> DataFrame:
    """The payloads of all files that were archived."""
    return spark.read.option("recursiveFileLookup", True).text(archive)

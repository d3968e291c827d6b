"""What a suppression query remembers, read from its checkpoint."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.streaming.suppression import AT


def held_emissions(spark: SparkSession, checkpoint: str, time: str = "alert_time", batch: int | None = None) -> DataFrame:
    """The keys in the state and the time of each one's last emission, as of the last committed batch or the given one.

    Reads the state files of all partitions as a table, whether the query runs or not. State that expires holds keys as texts.
    """
    reader = spark.read.format("statestore").option("stateVarName", "last")
    reader = reader if batch is None else reader.option("batchId", batch)
    held = reader.load(checkpoint)
    if "list_element" in held.columns:
        return held.select("list_element.*").withColumn(AT, F.timestamp_micros(AT)).withColumnRenamed(AT, time)
    return held.select("key.*", F.timestamp_micros("value.at").alias(time))

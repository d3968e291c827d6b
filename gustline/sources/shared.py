"""Places and written stages in the folder all executors share."""

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
IN_ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Where none is set, a run in one process gets a temporary
    one; any other is refused, since its executors would each write to their own disk."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not IN_ONE_PROCESS.fullmatch(spark.sparkContext.master):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gustline-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/gustline-{name}-{uuid4().hex}"


def write_stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read more than once and return the written table.

    Unlike a cached frame it outlives lost executors, and each reader loads only its columns.
    """
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

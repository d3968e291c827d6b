"""Starting and draining the alert streams."""

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gustline.operators.changes import change_alerts
from gustline.operators.thresholds import threshold_alerts
from gustline.sources.sinks import write_alerts

DETECTORS = {"threshold_detect": threshold_alerts, "change_detect": change_alerts}
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHUFFLES = "spark.sql.shuffle.partitions"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful query fixes in its checkpoint when it first starts.

    State is spread over a fixed number of partitions for the life of the query: the given
    number, or else the session's shuffle partitions, however many cores there are just now.
    """
    partitions = partitions or int(spark.conf.get(SHUFFLES))
    wanted = {STATE_STORE: ROCKSDB, SHUFFLES: str(partitions)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def start_detectors(
    readings: DataFrame, checkpoints: str, folder: str | None = None,
    names: Iterable[str] = tuple(DETECTORS), **sink
) -> dict[str, StreamingQuery]:
    """Start the named detectors, both unless told, over one source, each with its own checkpoint.

    On Kafka both append to the alert topic; in files each has a folder below `folder`,
    since a folder's commit log belongs to one query.
    """
    started = {}
    with state_settings(readings.sparkSession):
        for name in names:
            detect = DETECTORS[name]
            target = {"folder": f"{folder}/{name}"} if folder else {}
            started[name] = write_alerts(detect(readings), f"{checkpoints}/{name}", **target, **sink)
    return started


def run_detectors(readings: DataFrame, checkpoints: str, **sink) -> None:
    """Run both detectors until one of them stops or fails."""
    start_detectors(readings, checkpoints, **sink)
    readings.sparkSession.streams.awaitAnyTermination()


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries that were started on the data available now."""
    for query in queries:
        query.awaitTermination()


def delivered(query: StreamingQuery) -> list[dict]:
    """Rows in and out of the triggers that the query's progress still holds, with the time of each."""
    return [
        {
            "batch": progress["batchId"],
            "at": progress["timestamp"],
            "rows_in": progress["numInputRows"],
            "rows_out": max(0, progress["sink"].get("numOutputRows", 0)),
        }
        for progress in map(_plain_progress, query.recentProgress)
    ]


def _plain_progress(progress) -> dict:
    return progress if isinstance(progress, dict) else json.loads(progress.json)

"""Accounts of what streams read, sent and dropped, which outlive the progress a query holds."""

import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

#: Name of the metrics that `counted` adds.
SENT = "sent"
LAYOUT = "query STRING, batch BIGINT, at STRING, rows_in BIGINT, rows_out BIGINT, rows_late BIGINT"
#: Rows that wait until they are written.
HELD = 100


def counted(rows: DataFrame) -> DataFrame:
    """The rows of a stream, which are counted as they pass; put it in front of the sink."""
    return rows.observe(SENT, F.count("*").alias("n"))


class Accounts(StreamingQueryListener):
    """Writes a row for every trigger of the session's streams to a folder: what came in, what went out, what was late.

    Rows out are those that `counted` saw, or else what the sink tells. Late rows are those that Spark dropped behind a watermark.
    Add it with `spark.streams.addListener`; `settle` waits until a query is accounted for.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.held, self.ended = spark, folder, [], set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        sent = p.observedMetrics.get(SENT)
        out = sent["n"] if sent is not None else max(0, p.sink.numOutputRows)
        late = sum(operator.numRowsDroppedByWatermark for operator in p.stateOperators)
        self.held.append((str(p.id), p.batchId, p.timestamp, p.numInputRows, out, late))
        if len(self.held) >= HELD:
            self.write()

    def onQueryTerminated(self, event) -> None:
        self.write()
        self.ended.add(str(event.runId))

    def write(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, LAYOUT).coalesce(1).write.json(f"{self.folder}/{uuid4().hex}")

    def settle(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until all triggers of a query that has ended are written."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError("the accounts of a query did not arrive")
            time.sleep(0.05)


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each trigger of each query; of a batch that was run again, the last run counts."""
    rows = spark.read.schema(LAYOUT).option("recursiveFileLookup", True).json(folder)
    others = [c for c in rows.columns if c not in ("query", "batch", "at")]
    last = rows.groupBy("query", "batch").agg(F.max(F.struct("at", *others)).alias("last"))
    return last.select("query", "batch", "last.*")

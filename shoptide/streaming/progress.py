"""What every batch of every stream did: rows, rows dropped as late, state and time, as a table."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "run_id string, query string, batch bigint, at string, input_rows bigint, late_rows bigint, state_rows bigint, "
    "state_bytes bigint, millis bigint"
)
ENDS = "run_id string, error string"


class ProgressLog(StreamingQueryListener):
    """Keeps a row for each batch until :meth:`flush` writes them; register it by ``spark.streams.addListener``.

    Of rows that are not written, the newest ``most`` stay, so a log nobody flushes has a bound.
    """

    def __init__(self, most: int = 100_000):
        self.most, self.lock = most, Lock()
        self.rows: list[tuple] = []
        self.ended: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        row = (
            str(p.runId),
            p.name,
            p.batchId,
            p.timestamp,
            p.numInputRows,
            sum(s.numRowsDroppedByWatermark for s in state),
            sum(s.numRowsTotal for s in state),
            sum(s.memoryUsedBytes for s in state),
            p.durationMs.get("triggerExecution"),
        )
        with self.lock:
            self.rows = [*self.rows, row][-self.most :]

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended = [*self.ended, (str(event.runId), event.exception)][-self.most :]

    def _taken(self, name: str) -> list[tuple]:
        with self.lock:
            rows = getattr(self, name)
            setattr(self, name, [])
        return rows

    def flush(self, spark: SparkSession, path: str) -> None:
        """Append what has been kept to ``<path>/batches`` and ``<path>/ends``."""
        for name, folder, schema in (("rows", "batches", PROGRESS), ("ended", "ends", ENDS)):
            if rows := self._taken(name):
                spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{folder}")


def batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(f"{path}/batches")

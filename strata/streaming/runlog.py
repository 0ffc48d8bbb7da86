"""A stream's progress, epoch by epoch, as a table.

``ProgressLog`` is a listener on the session's streams. Spark reports every epoch to it
(rows read, duration, state rows and sizes); when the run has ended, the reports of that
run are written as one Parquet folder. The reports are numbers per epoch, so what the
driver holds does not grow with the data.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "run_id string, epoch long, input_rows long, batch_millis long, "
    "state_rows long, state_rows_updated long, state_rows_dropped long, state_memory_bytes long"
)


class ProgressLog(StreamingQueryListener):
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self._news = threading.Condition()

    @classmethod
    def attached(cls, spark: SparkSession) -> "ProgressLog":
        log = cls(spark)
        spark.streams.addListener(log)
        return log

    def onQueryStarted(self, event) -> None:  # noqa: N802 (the listener's interface)
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        state = p.stateOperators
        row = (
            str(p.runId), p.batchId, p.numInputRows, p.batchDuration, sum(s.numRowsTotal for s in state),
            sum(s.numRowsUpdated for s in state), sum(s.numRowsDroppedByWatermark for s in state),
            sum(s.memoryUsedBytes for s in state),
        )
        with self._news:
            self.rows.append(row)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._news:
            self.ended.add(str(event.runId))
            self._news.notify_all()

    def write(self, run_id: str, path: str, timeout: float = 30.0) -> None:
        """Wait for the last report of the run, write all of them, and stop listening."""
        with self._news:
            self._news.wait_for(lambda: run_id in self.ended, timeout)
            rows = [r for r in self.rows if r[0] == run_id]
        self.spark.streams.removeListener(self)
        table = self.spark.createDataFrame(rows, SCHEMA)
        table.write.mode("overwrite").parquet(f"{path}/run={run_id}")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per epoch over all runs (of a replayed epoch the largest figures)."""
    rows = spark.read.schema(SCHEMA + ", run string").parquet(path)
    figures = [c for c in rows.columns if c not in ("run_id", "epoch", "run")]
    return rows.groupBy("epoch").agg(*[F.max(c).alias(c) for c in figures])

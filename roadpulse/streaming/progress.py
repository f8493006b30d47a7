"""What the streaming queries report, kept as a table instead of passing by."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from roadpulse.config import FeedConfig
from roadpulse.sinks import ensure_dir

PROGRESS = (
    "stage string, query_id string, batch_id long, reported timestamp, input_rows long, "
    "watermark timestamp, late_rows long, state_rows long, counts map<string,long>"
)
#: Reports that are held before they are written; all are when a query ends.
HELD_REPORTS = 50
#: Seconds to wait for the last report of a query that has ended.
PATIENCE = 30


class ProgressLog(StreamingQueryListener):
    """Writes a row per micro-batch of named queries: rows, watermark, dropped and observed counts.

    Rows are written by the driver, a small JSON file for many of them, which is named anew and never
    changed. A process that dies loses those it holds. A micro-batch that is tried again reports again;
    ``read_progress`` takes the last report.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows: list[str] = []
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.name:
            return
        observed = {
            f"{name}.{key}": value
            for name, row in progress.observedMetrics.items()
            for key, value in row.asDict().items()
        }
        row = {
            "stage": progress.name.rsplit(".", 1)[0],
            "query_id": str(progress.id),
            "batch_id": progress.batchId,
            "reported": progress.timestamp,
            "input_rows": progress.numInputRows,
            "watermark": progress.eventTime.get("watermark"),
            "late_rows": sum(x.numRowsDroppedByWatermark for x in progress.stateOperators),
            "state_rows": sum(x.numRowsTotal for x in progress.stateOperators),
            "counts": observed,
        }
        with self.lock:
            self.rows.append(json.dumps(row))
            full = len(self.rows) >= HELD_REPORTS
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self._ending(str(event.runId)).set()

    def _ending(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def wait_for(self, query: StreamingQuery) -> None:
        """Until the reports of a query that has ended are written."""
        self._ending(str(query.runId)).wait(PATIENCE)

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if not rows:
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{uuid.uuid4().hex}.json")
        file = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, False)
        try:
            file.write(bytearray("\n".join(rows).encode()))
        finally:
            file.close()


@contextmanager
def progress_log(spark: SparkSession, config: FeedConfig) -> Iterator[ProgressLog | None]:
    """Keep the reports of the queries inside, if the settings say so."""
    if not config.log_progress:
        yield None
        return
    ensure_dir(spark, config.metrics_path)
    log = ProgressLog(spark, config.metrics_path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
        log.flush()


def read_progress(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """One row per stage and micro-batch; a table without reports is empty."""
    ensure_dir(spark, config.metrics_path)
    rows = spark.read.schema(PROGRESS).json(config.metrics_path)
    last = F.row_number().over(Window.partitionBy("query_id", "batch_id").orderBy(F.desc("reported")))
    return rows.withColumn("_last", last).where("_last = 1").drop("_last")

"""Ingest metrics: a row per micro-batch, taken from the progress Spark reports."""

from __future__ import annotations

import json
import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from runledger.streaming.ingest import OBSERVED, OBSERVED_LINES

METRICS = "query_id STRING, batch_id BIGINT, records BIGINT, inserted BIGINT, skipped BIGINT, rejected BIGINT, insert_seconds DOUBLE"


def _row(progress: dict) -> tuple | None:
    """None for a batch without records and refused lines.  Progress is reported for successful batches only."""
    observed = progress.get("observedMetrics") or {}
    records, inserted, skipped = ((observed.get(OBSERVED) or {}).get(c) or 0 for c in ("records", "inserted", "skipped"))
    rejected = (observed.get(OBSERVED_LINES) or {}).get("rejected") or 0
    if not records and not rejected:
        return None
    seconds = progress["durationMs"].get("addBatch", 0) / 1000 if inserted else None
    return progress["id"], progress["batchId"], records, inserted, skipped, rejected, seconds


def progress_metrics(spark: SparkSession, progresses: list) -> DataFrame:
    """Metrics of the given progress reports, such as ``query.recentProgress``."""
    rows = [r for r in (_row(json.loads(p.json)) for p in progresses) if r]
    return spark.createDataFrame(rows, METRICS)


class IngestMetrics(StreamingQueryListener):
    """Appends the metrics of all ingest queries of a session to a Parquet path.

    Each batch is written as soon as Spark reports it, so what a lost driver can lose is the report under
    way.  A larger ``flush_every`` makes fewer files and can lose as many reports.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 1):
        self._spark, self._path, self._flush_every, self._rows = spark, path, flush_every, []
        self._ended = defaultdict(threading.Event)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = _row(json.loads(event.progress.json))
        if row:
            self._rows.append(row)
        if len(self._rows) >= self._flush_every:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()
        self._ended[str(event.runId)].set()

    def wait(self, query, seconds: float = 60) -> bool:
        """Wait until all reports of a query that has stopped are written; False if they were not in time."""
        return self._ended[str(query.runId)].wait(seconds)

    def flush(self):
        rows = list(self._rows)
        if rows:
            self._spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(self._path)
            del self._rows[: len(rows)]  # only now, so that a failed write is tried again


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)


def insert_durations(metrics: DataFrame) -> DataFrame:
    """Metrics of batches that wrote rows, for a histogram over ``insert_seconds``."""
    return metrics.filter(F.col("insert_seconds").isNotNull())

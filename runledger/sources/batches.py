"""What is known of each micro-batch: one small file per batch, beside the rows.

A batch is noted as begun before its rows are written and as done after.  So a batch that
comes again is known by its own record, whatever else has been appended or deleted since, and the
table itself is asked only after a crash between the two.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions import json_text
from runledger.session import get_text, put_text

RECORDS = "batch_id BIGINT, n BIGINT, digest STRING, files BIGINT, stream STRING, before BIGINT, done BOOLEAN"


@dataclass(frozen=True)
class BatchRecord:
    """``digest`` covers run, phase, time, event and body of all rows; no order or partitioning changes it.

    ``before`` is the id before the first of those that the batch gave to its rows, if it gave them.
    """

    batch_id: int
    n: int
    digest: str
    files: int | None = None
    stream: str | None = None
    before: int | None = None
    done: bool = False

    @property
    def last_id(self) -> int | None:
        return None if self.before is None else self.before + self.n

    @property
    def content(self) -> tuple:
        return self.n, self.digest

    def finished(self) -> "BatchRecord":
        return replace(self, done=True)


def digest_sum() -> Column:
    """Aggregate over log rows that tells their content."""
    texts = [F.coalesce(c, F.lit("\0")) for c in ("agentic_run_id", "phase", "event", json_text(F.col("body")))]
    time = F.coalesce(F.unix_micros(F.col("timestamp").cast("timestamp")), F.lit(-1))
    return F.coalesce(F.sum(F.xxhash64(*texts, time).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def stream_id(spark: SparkSession) -> str | None:
    """Id of the streaming query that calls; the same after a restart from its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _path(folder: str, batch_id: int) -> str:
    return f"{folder}/_batches/{batch_id}.json"


def read_record(spark: SparkSession, folder: str, batch_id: int) -> BatchRecord | None:
    text = get_text(spark, _path(folder, batch_id))
    return None if text is None else BatchRecord(**json.loads(text))


def write_record(spark: SparkSession, folder: str, record: BatchRecord) -> None:
    put_text(spark, _path(folder, record.batch_id), json.dumps(asdict(record)) + "\n")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all batches."""
    return spark.read.schema(RECORDS).json(f"{folder}/_batches")

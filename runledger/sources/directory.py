"""The run directory: how many rows each run has in each era, and the ids between which they lie.

A small plain table beside the log table.  Each append and delete adds rows to it, a delete negative ones; reading
sums them up.  Counts of one run, of all runs and of a prefix, which is a range of its order, read nothing else.

Before a writer changes the log it leaves a mark, which it takes away when the directory is up to date.  Who
finds a mark knows that another one broke off, and counts the eras it was at again.  Readers see the state after
the last change that ended.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.session import get_text, put_text, remove

RUNS_DDL = "agentic_run_id STRING, era BIGINT, n BIGINT, first_id BIGINT, last_id BIGINT"
DELTA_FILES = 4


def runs_table(table: str) -> str:
    return f"{table}_runs"


def ensure_runs(spark: SparkSession, table: str) -> bool:
    """Create the directory of a log table unless there is one; whether it is new."""
    if spark.catalog.tableExists(runs_table(table)):
        return False
    spark.sql(f"CREATE TABLE IF NOT EXISTS {runs_table(table)} ({RUNS_DDL}) USING parquet")
    return True


def run_counts(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Rows for the directory from log rows with ``agentic_run_id, era, id``."""
    return rows.groupBy("agentic_run_id", "era").agg(
        (F.lit(sign) * F.count(F.lit(1))).cast("bigint").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


def add_runs(counted: DataFrame, table: str) -> None:
    counted.coalesce(DELTA_FILES).sortWithinPartitions("agentic_run_id").write.insertInto(runs_table(table))


def scan_runs(spark: SparkSession, table: str) -> DataFrame:
    """``agentic_run_id, era, n, first_id, last_id`` of all runs.

    A run that lost rows and got new ones in the same era may have a first id that is gone; ids never lie outside.
    """
    name = runs_table(table)
    spark.catalog.refreshTable(name)  # another session may have written
    summed = spark.table(name).groupBy("agentic_run_id", "era").agg(
        F.sum("n").alias("n"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")
    )
    return summed.where("n > 0")


def replace_runs(spark: SparkSession, table: str, runs: DataFrame, folder: str) -> None:
    """Put ``runs`` in the directory's place, in order of the run, by one change of the catalog.

    They are written below ``folder``, that of the log table, so that they go when it goes.
    """
    name, fresh = runs_table(table), f"{folder}/_runs/{uuid.uuid4().hex}"
    runs.repartitionByRange("agentic_run_id").sortWithinPartitions("agentic_run_id", "era").write.parquet(fresh)
    old = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(name)
    remove(spark, old)


def recount_runs(spark: SparkSession, table: str, logs: DataFrame, folder: str, eras: list | None = None) -> None:
    """Count the runs of ``logs``, the whole table, again: all, or in the eras between two, the others staying as they are."""
    if eras is None:
        counted = run_counts(logs.select("agentic_run_id", "era", "id"))
    else:
        inside = F.col("era").between(*eras)
        fresh = run_counts(logs.where(inside).select("agentic_run_id", "era", "id"))
        counted = scan_runs(spark, table).where(~inside).unionByName(fresh)
    replace_runs(spark, table, counted, folder)


@contextmanager
def changing(spark: SparkSession, table: str, folder: str, logs, eras: list | None = None) -> Iterator[bool]:
    """Around a change of the log and of its directory; gives whether the directory is to be counted anew at the end.

    ``eras`` are the first and last that the change can touch, None for any. ``logs()`` gives the table as it is then.
    """
    path = f"{folder}/_changing"
    left = get_text(spark, path)
    if left is not None:
        before = json.loads(left)
        eras = None if before is None or eras is None else [min(before[0], eras[0]), max(before[1], eras[1])]
    put_text(spark, path, json.dumps(eras))
    yield left is not None
    if left is not None:
        recount_runs(spark, table, logs(), folder, eras)
    remove(spark, path)

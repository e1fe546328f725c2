"""Filters on the log table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.operators.rules import parse_after


def bucket_of(run_id: Column, buckets: int) -> Column:
    """The hash partition a run lives in."""
    return F.pmod(F.xxhash64(run_id), F.lit(buckets)).cast("int")


def era_of(row_id: Column, era_ids: int) -> Column:
    """The range partition an id lies in."""
    return F.call_function("div", row_id, F.lit(era_ids))


def table_setting(logs: DataFrame, column: str) -> int | None:
    """The number of buckets, or of ids in an era, that a scan of the log table carries
    along in its column metadata; None for other DataFrames."""
    return logs.schema[column].metadata.get("setting") if column in logs.columns else None


def table_of(logs: DataFrame) -> str | None:
    """Name of the log table that a DataFrame is a scan of; None for others."""
    return logs.schema["era"].metadata.get("table") if "era" in logs.columns else None


def eras_of_run(logs: DataFrame, run_id: str, after: int = 0) -> list[int] | None:
    """Eras that the log table has of a run's bucket, from the cursor's on, in order; None for other DataFrames.

    The catalog tells, no file is read.
    """
    name, buckets, era_ids = table_of(logs), table_setting(logs, "bucket"), table_setting(logs, "era")
    if not (name and buckets and era_ids):
        return None
    spark = logs.sparkSession
    bucket = spark.sql("SELECT 1").select(bucket_of(F.lit(run_id), buckets)).first()[0]
    era = F.regexp_extract("partition", "era=([0-9]+)", 1).cast("bigint")
    listed = spark.sql(f"SHOW PARTITIONS {name} PARTITION (bucket = {bucket})").select(era.alias("era")).collect()
    return sorted(r["era"] for r in listed if r["era"] >= after // era_ids)


def for_run(logs: DataFrame, run_id: str) -> DataFrame:
    """Rows of one run.  On the log table only the run's bucket is read."""
    match = F.col("agentic_run_id") == F.lit(run_id)
    if buckets := table_setting(logs, "bucket"):
        match = (F.col("bucket") == bucket_of(F.lit(run_id), buckets)) & match
    return logs.filter(match)


def in_buckets_of(logs: DataFrame, runs: DataFrame) -> DataFrame:
    """On the log table, rows in the buckets of the listed runs; other DataFrames as they are.

    Gathers bucket numbers on the driver, of which there are as many as buckets at most.
    """
    buckets = table_setting(logs, "bucket")
    if not buckets:
        return logs
    listed = runs.select(bucket_of(F.col("agentic_run_id"), buckets)).distinct().collect()
    return logs if len(listed) == buckets else logs.filter(F.col("bucket").isin([r[0] for r in listed]))


def for_phase(logs: DataFrame, phase: str | None = None) -> DataFrame:
    """Rows of one phase; no filter if ``phase`` is missing or empty."""
    return logs.filter(F.col("phase") == F.lit(phase)) if phase else logs


def after_id(logs: DataFrame, after=0) -> DataFrame:
    """Rows beyond the cursor.  On the log table earlier eras are not read."""
    after = F.lit(parse_after(after)).cast("bigint")
    beyond = F.col("id") > after
    if era_ids := table_setting(logs, "era"):
        beyond = (F.col("era") >= era_of(after, era_ids)) & beyond
    return logs.filter(beyond)


def up_to_id(logs: DataFrame, last: Column) -> DataFrame:
    """Rows up to an id.  On the log table later eras are not read."""
    within = F.col("id") <= last
    if era_ids := table_setting(logs, "era"):
        within = (F.col("era") <= era_of(last, era_ids)) & within
    return logs.filter(within)


def for_run_prefix(logs: DataFrame, prefix: str) -> DataFrame:
    return logs.filter(F.startswith("agentic_run_id", F.lit(prefix)))

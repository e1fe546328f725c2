"""The log table: create, scan, append, delete.

A Parquet table partitioned by a hash bucket of the run id and by the era, a
range of ids; sorted by run and id within each file.  That replaces the run
index: a query for one run reads one bucket, from the cursor's era on, and
row-group statistics skip other runs and other ids.  Deleting a run rewrites
only the eras of its bucket that it has rows in, so that a small run that
shares its bucket with a huge one does not cost a rewrite of the huge one.
One writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runledger.operators.filters import after_id, bucket_of, era_of, in_buckets_of, up_to_id
from runledger.operators.ids import ARRIVAL_COLUMNS, BATCH_SPAN, RECORD_KEY, arrival_blocks, assign_arrival_ids, assign_ids, first_id
from runledger.operators.purge import purge_runs
from runledger.operators.rules import check_identifier, require_run_id
from runledger.schema import DEFAULT_SCHEMA, DEFAULT_TABLE, TABLE_COLUMNS, TABLE_DDL
from runledger.session import get_text, put_text, remove, setting, write_through
from runledger.sources.batches import BatchRecord, digest_sum, read_record, stream_id, write_record
from runledger.sources.directory import add_runs, changing, ensure_runs, recount_runs, replace_runs, run_counts, scan_runs
from runledger.streaming.retry import Permanent

_BUCKETS, _ERA_IDS = "runledger.buckets", "runledger.era_ids"

# A row group whose runs fit a dictionary is told by that not to have a run that its range would allow; one
# of more runs by a Bloom filter, which is written for such only and takes less than two bytes a run.
FILE_OPTIONS = {
    "parquet.bloom.filter.enabled#agentic_run_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}

# batch_id of rows that no micro-batch wrote.
NO_BATCH = -1

# Ids in an era: those of 8192 micro-batches, some six days of one a minute.
ERA_IDS = 8192 * BATCH_SPAN

# Changes of the catalog under way at a time, and emptied partitions that one of them drops.
SWITCHES_AT_ONCE = 8
DROPS_AT_ONCE = 100


def ensure_table(
    spark: SparkSession,
    schema: str = DEFAULT_SCHEMA,
    table: str = DEFAULT_TABLE,
    buckets: int = 64,
    era_ids: int = ERA_IDS,
    location: str | None = None,
) -> str:
    """Create schema and table unless they exist, and return the table's full name.

    ``buckets`` and ``era_ids`` count for a new table only.  Choose them so that
    a bucket of an era holds some GB; it may have any number of files, so a huge
    run is still read and written by many tasks.  Tables filled with ids of the
    caller's own want a smaller era.  ``location`` is that of a new schema.
    """
    schema, table = check_identifier(schema), check_identifier(table)
    name = f"{schema}.{table}"
    below = "" if location is None else f" LOCATION '{_escaped(location)}'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{below}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({TABLE_DDL}) USING parquet "
        f"OPTIONS ({', '.join(f"'{k}' = '{v}'" for k, v in FILE_OPTIONS.items())}) PARTITIONED BY (bucket, era) "
        f"TBLPROPERTIES ('{_BUCKETS}' = '{int(buckets)}', '{_ERA_IDS}' = '{int(era_ids)}')"
    )
    if ensure_runs(spark, name) and _partitions(spark, name):
        recount_runs(spark, name, scan_logs(spark, name), _location(spark, name))  # a log from before there were directories
    return name


def _escaped(text: str) -> str:
    """Text as it stands in an SQL string."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def table_settings(spark: SparkSession, table: str) -> tuple[int, int]:
    """Number of buckets, and of ids in an era."""
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if not {_BUCKETS, _ERA_IDS} <= set(properties):
        raise ValueError(f"{table} was not made by ensure_table")
    return int(properties[_BUCKETS]), int(properties[_ERA_IDS])


def scan_logs(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now.  Its settings ride along in the metadata of the partition
    columns, where the filters find them."""
    spark.catalog.refreshTable(table)  # another session may have written
    buckets, era_ids = table_settings(spark, table)
    return spark.table(table).select(
        *TABLE_COLUMNS[:-2],
        F.col("bucket").alias("bucket", metadata={"setting": buckets}),
        F.col("era").alias("era", metadata={"setting": era_ids, "table": table}),
    )


def _lay_out(rows: DataFrame, buckets: int, era_ids: int) -> DataFrame:
    """Rows as the table stores them: together by partition, sorted by run and id.

    The rebalance hint makes adaptive execution split a partition that holds a
    hot run over many tasks and put small partitions together, so neither one
    huge task nor a file per task and partition comes out.
    """
    placed = rows.withColumns(
        {"bucket": bucket_of(F.col("agentic_run_id"), buckets), "era": era_of(F.col("id"), era_ids)}
    ).select(*TABLE_COLUMNS)
    return placed.hint("rebalance", F.col("bucket"), F.col("era")).sortWithinPartitions(
        "bucket", "era", "agentic_run_id", "id"
    )


def last_id(spark: SparkSession, table: str) -> int:
    """Largest id in the table, 0 if it is empty.  Only the latest era is read."""
    era = F.regexp_extract("partition", "era=([0-9]+)", 1).cast("bigint")
    latest = spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(era)).first()[0]
    if latest is None:
        return 0
    return scan_logs(spark, table).filter(F.col("era") == latest).agg(F.max("id")).first()[0] or 0


def append_logs(df: DataFrame, table: str, batch_id: int = NO_BATCH, order_cols: list | None = None) -> None:
    """Append log rows in one job, all or none.  No rows, no files.

    Rows need ``agentic_run_id, phase, timestamp, event, body`` and either
    ``id`` or a total order to number them by, after the largest id so far.
    They are worked out once, and not kept: however many they are, their runs are counted in the
    eras they were written to, by run and id alone.
    """
    spark = df.sparkSession
    if "id" not in df.columns:
        if not order_cols:
            raise ValueError("rows without id need order_cols")
        df = assign_ids(df, order_cols, last_id(spark, table))
    if df.isEmpty():
        return
    _, era_ids = table_settings(spark, table)
    folder, seen = _location(spark, table), Observation()
    with changing(spark, table, folder, lambda: scan_logs(spark, table)) as anew:
        _write(df.observe(seen, F.min("id").alias("first"), F.max("id").alias("last")), table, batch_id)
        if not anew:
            eras = [seen.get["first"] // era_ids, seen.get["last"] // era_ids]
            with _many_folders(spark):
                recount_runs(spark, table, scan_logs(spark, table), folder, eras)


def _write(rows: DataFrame, table: str, batch_id: int) -> None:
    laid_out = _lay_out(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), *table_settings(rows.sparkSession, table))
    with _many_folders(rows.sparkSession):
        laid_out.write.insertInto(table)


@contextmanager
def _many_folders(spark: SparkSession) -> Iterator[None]:
    """Settings for work on partitions that may be many and small, where each file costs more than its bytes.

    All tasks share the files, however few bytes these have, and folders are listed by some tasks per core, not by one each.
    """
    listing = str(8 * spark.sparkContext.defaultParallelism)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k"):
        with setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", listing):
            yield


def _append(rows: DataFrame, table: str, folder: str, record: BatchRecord) -> None:
    """Write the rows of a batch, which can be read twice, and add their runs to the directory."""
    spark = rows.sparkSession
    _, era_ids = table_settings(spark, table)
    with changing(spark, table, folder, lambda: scan_logs(spark, table), _eras_of(spark, table, record)) as anew:
        _write(rows, table, record.batch_id)
        if not anew:
            add_runs(run_counts(rows.withColumn("era", era_of(F.col("id"), era_ids))), table)


def append_batch(df: DataFrame, batch_id: int, table: str) -> int:
    """Append one micro-batch of extracted rows once, and return the number of rows.

    A batch may come again after a crash.  Its record (see :mod:`runledger.sources.batches`) says
    whether it is in the table: if it is, the batch is skipped, even where its rows have been deleted since.
    If another batch was written under its id, as when a second stream writes to the
    table, this fails before anything is written.  Where the record says only that the batch was
    begun, its rows in the table decide: all of them, none, or, which is an error, some.

    Rows without ids need the file columns of a scan, and get ids in the order of arrival within
    the range of the batch.  A batch that its range does not hold goes on in the next one, and the batches after it
    begin behind it.  Rows that were moved since the scan also need ``_key``,
    one for each; within a file block they go by time, then by that.
    """
    # The session of the batch: another one could see a stale list of files.
    spark = df.sparkSession
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    blocks, n_files = None, None
    own_ids = "id" not in kept.columns
    try:
        # A micro-batch is written by an ordinary query; streams turn this off for their own.
        with setting(spark, "spark.sql.adaptive.enabled", "true"):
            if not own_ids:
                n, digest = kept.agg(F.count(F.lit(1)), digest_sum()).first()
            elif not set(ARRIVAL_COLUMNS) <= set(kept.columns):
                raise ValueError("a batch needs ids or the file columns of scan_otlp_logs")
            elif RECORD_KEY in kept.columns:
                n, digest, n_files = kept.agg(F.count(F.lit(1)), digest_sum(), F.count_distinct("file_path")).first()
            else:
                blocks = arrival_blocks(kept, digest_sum().alias("_digest")).persist(StorageLevel.MEMORY_AND_DISK)
                sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("_n", "_digest")]
                n, digest, n_files, torn = blocks.agg(*sums, F.count_distinct("file_path"), F.count_if("_torn")).first()
                if torn:
                    raise ValueError("rows were moved since the scan, so their order of arrival is lost")
            folder = _location(spark, table)
            known = read_record(spark, folder, batch_id)
            before = _before(spark, folder, batch_id, known) if own_ids else None
            record = BatchRecord(batch_id, n, str(digest), n_files, stream_id(spark), before)
            if n == 0:
                if before is not None and before > first_id(batch_id):
                    write_record(spark, folder, record.finished())  # the next batch has to know where to begin
                return 0
            if _is_there(spark, table, folder, record, known):
                return n
            rows = kept
            if blocks is not None:
                rows = assign_arrival_ids(kept, blocks, before)
            elif own_ids:
                rows = assign_ids(kept, [*ARRIVAL_COLUMNS, "timestamp", RECORD_KEY], before)
            _append(rows, table, folder, record)
            write_record(spark, folder, record.finished())
            return n
    finally:
        if blocks is not None:
            blocks.unpersist()
        kept.unpersist()


def _before(spark: SparkSession, folder: str, batch_id: int, known: BatchRecord | None) -> int:
    """The id that a batch's ids follow: that of its first try, else the end of what lies before its range and the last batch."""
    if known is not None and known.before is not None:
        return known.before
    last = read_record(spark, folder, batch_id - 1)
    reached = last.last_id if last is not None and last.last_id is not None else 0
    return max(first_id(batch_id), reached)


def _eras_of(spark: SparkSession, table: str, record: BatchRecord) -> list[int] | None:
    """First and last era of the ids that a batch gives to its rows; None where they came with ids."""
    if record.before is None:
        return None
    era_ids = table_settings(spark, table)[1]
    return [(record.before + 1) // era_ids, record.last_id // era_ids]


def _is_there(spark: SparkSession, table: str, folder: str, record: BatchRecord, known: BatchRecord | None) -> bool:
    """Whether the batch is in the table already, by what is known of it; if not, it is noted as begun."""
    if known is not None and known.done:
        if known.content == record.content:
            return True
        of = "" if known.stream == record.stream else f", written by stream {known.stream}"
        raise Permanent(f"micro-batch {record.batch_id} has {record.n} rows, but {known.n} others are in {table}{of}")
    if known is not None:
        there = scan_logs(spark, table).filter(F.col("batch_id") == record.batch_id)
        if known.before is not None:
            # Its ids are known, so only the eras they lie in are looked at.
            there = up_to_id(after_id(there, known.before), F.lit(known.last_id))
        n, digest = there.agg(F.count(F.lit(1)), digest_sum()).first()
        if (n, str(digest)) == record.content:
            with changing(spark, table, folder, lambda: scan_logs(spark, table), _eras_of(spark, table, known)):
                pass  # counts again what the crash may have kept from the directory
            write_record(spark, folder, record.finished())
            return True
        if n:
            raise Permanent(f"micro-batch {record.batch_id} has {record.n} rows, but {n} others or fewer are in {table}")
    write_record(spark, folder, record)
    return False


def delete_run(spark: SparkSession, table: str, run_id: str) -> int:
    """Delete all rows of a run, of all phases, and return how many; 0 for an unknown run.

    Rewrites the run's bucket in the eras it has rows in, and nothing else (see :func:`_rewrite`).
    """
    require_run_id(run_id)
    _require_managed(spark, table)
    buckets, _ = table_settings(spark, table)
    bucket = spark.range(1).select(bucket_of(F.lit(run_id), buckets)).first()[0]
    in_bucket = _with_files(scan_logs(spark, table)).filter(F.col("bucket") == bucket)
    mine = F.coalesce(F.col("agentic_run_id") == F.lit(run_id), F.lit(False))
    with _many_folders(spark):
        return _rewrite(spark, table, in_bucket.withColumn("_gone", mine))


def purge_table(spark: SparkSession, table: str, runs: DataFrame) -> DataFrame:
    """Delete all rows of the listed runs (``agentic_run_id``) and return ``agentic_run_id, deleted``, 0 for unknown runs.

    However many runs are listed, each bucket and era that has rows of them is rewritten
    once. NULL and empty run ids are ignored. The counts are those before the delete.
    """
    _require_managed(spark, table)
    with _many_folders(spark):
        listed = write_through(runs.select("agentic_run_id").where("agentic_run_id <> ''").distinct(), "purge")
        logs = scan_logs(spark, table)
        counts = write_through(purge_runs(logs, listed)[1].select("agentic_run_id", "deleted"), "purged")
        known = counts.where("deleted > 0").select("agentic_run_id", F.lit(True).alias("_gone"))
        marked = _with_files(in_buckets_of(logs, known)).join(known, "agentic_run_id", "left")
        _rewrite(spark, table, marked.withColumn("_gone", F.coalesce("_gone", F.lit(False))))
    return counts


def _require_managed(spark: SparkSession, table: str) -> None:
    if spark.catalog.getTable(table).tableType != "MANAGED":
        raise ValueError(f"{table} is external, so its emptied partitions would come back")


def _rewrite(spark: SparkSession, table: str, marked: DataFrame) -> int:
    """Take the rows with ``_gone`` out of the table, and return how many they are.

    ``marked`` are rows of whole partitions, with their files. What stays of the partitions that lose rows
    is written to a new folder below the table, whose leading underscore hides it from
    scans, and counted again; then each partition is switched to its new files by one
    change of the catalog. So other runs' rows can be read at any time, and after a crash the
    partitions not yet switched are as before: the same delete again finishes it. What a crash
    leaves behind are files that no scan reads.
    """
    sizes = _sizes(marked, gone=F.count_if("_gone"), left=F.count_if(~F.col("_gone")))
    # One row per partition that loses rows.
    hit = sizes.where("gone > 0").orderBy("bucket", "era").select("bucket", "era", "folder", "gone", "left").collect()
    folder = _location(spark, table)
    if not hit and get_text(spark, f"{folder}/_changing") is None:
        return 0
    # Two numbers for each deleted run and era, counted while the rows are there.
    gone = marked.where(_inside([(row["bucket"], row["era"]) for row in hit]) & F.col("_gone"))
    lost = write_through(run_counts(gone.select("agentic_run_id", "era", "id"), -1), "lost")
    with changing(spark, table, folder, lambda: scan_logs(spark, table)) as anew:
        _switch(spark, table, folder, marked.where(~F.col("_gone")), hit)
        if not anew:
            add_runs(lost, table)
    return sum(row["gone"] for row in hit)


def _switch(spark: SparkSession, table: str, folder: str, rows: DataFrame, hit: list, keep_old: bool = False) -> None:
    """Put ``rows`` in the place of what the partitions ``hit`` hold: of each its bucket, era, folder, and number of rows ``left``.

    ``keep_old`` leaves the files that were there for who is still reading them.
    """
    buckets, era_ids = table_settings(spark, table)
    old = {(row["bucket"], row["era"]): unquote(row["folder"]) for row in hit}
    staying = [(row["bucket"], row["era"]) for row in hit if row["left"]]
    fresh = f"{folder}/_rewritten/{uuid.uuid4().hex}"
    if staying:
        survivors = _lay_out(rows.where(_inside(staying)), buckets, era_ids)
        survivors.write.options(**FILE_OPTIONS).partitionBy("bucket", "era").parquet(fresh)
        written = spark.read.schema(survivors.schema).parquet(fresh).count()
        if written != (kept := sum(row["left"] for row in hit)):
            raise RuntimeError(f"{written} rows were written where {kept} stay, so {table} was left as it is")

    def switch(place: tuple[int, int]) -> None:
        bucket, era = place
        there = _escaped(f"{fresh}/bucket={bucket}/era={era}")
        spark.sql(f"ALTER TABLE {table} PARTITION (bucket = {bucket}, era = {era}) SET LOCATION '{there}'")
        if not keep_old:
            remove(spark, old[place])

    def drop(places: list[tuple[int, int]]) -> None:
        named = ", ".join(f"PARTITION (bucket = {bucket}, era = {era})" for bucket, era in places)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")
        for place in places:
            remove(spark, old[place])

    emptied = [(row["bucket"], row["era"]) for row in hit if not row["left"]]
    dropped = [emptied[at : at + DROPS_AT_ONCE] for at in range(0, len(emptied), DROPS_AT_ONCE)]
    # The driver is done with a statement in milliseconds; several at once, as there may be very many.
    with ThreadPoolExecutor(SWITCHES_AT_ONCE) as pool:
        for done in (pool.map(switch, staying), pool.map(drop, dropped)):
            for _ in done:
                pass
    if keep_old and hit:
        put_text(spark, f"{folder}/_replaced/{time.time_ns()}.json", json.dumps(list(old.values())))
    spark.catalog.refreshTable(table)


def _inside(places: list[tuple[int, int]]) -> Column:
    """Whether a row is in one of the partitions (bucket, era); of none if there are none.

    Plain comparisons of the partition columns, so that no other partition is read; eras without a gap are one range.
    """
    if not places:
        return F.lit(False)
    by_bucket: dict[int, list[int]] = {}
    for bucket, era in sorted(places):
        by_bucket.setdefault(bucket, []).append(era)
    eras = {
        bucket: f"BETWEEN {es[0]} AND {es[-1]}" if es[-1] - es[0] == len(es) - 1 else f"IN ({', '.join(map(str, es))})"
        for bucket, es in by_bucket.items()
    }
    return F.expr(" OR ".join(f"(bucket = {bucket} AND era {within})" for bucket, within in eras.items()))


def _with_files(logs: DataFrame) -> DataFrame:
    """Rows of the table with the file each is in, as a URI, and its size."""
    return logs.withColumns({"_file": F.col("_metadata.file_path"), "_bytes": F.col("_metadata.file_size")})


def _sizes(rows: DataFrame, **counts: Column) -> DataFrame:
    """``bucket, era, folder, files, bytes`` and the counts of partitions that have rows, by one look at rows with their files.

    The folder is written as in a URI.
    """
    files = rows.groupBy("bucket", "era", "_file", "_bytes").agg(*[count.alias(name) for name, count in counts.items()])
    return files.groupBy("bucket", "era").agg(
        F.min(F.regexp_replace("_file", "/[^/]*$", "")).alias("folder"),
        F.count(F.lit(1)).alias("files"), F.sum("_bytes").alias("bytes"), *[F.sum(name).alias(name) for name in counts],
    )


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    """Folder of the table or of one partition."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").where("col_name = 'Location'")
    # Of a partition its own folder comes first, then the table's.
    return about.first()["data_type"].rstrip("/")


def _partitions(spark: SparkSession, table: str) -> list[tuple[int, int]]:
    """Bucket and era of all partitions; their number does not depend on how many batches wrote them."""
    part = F.regexp_extract("partition", "bucket=([0-9]+)/era=([0-9]+)", 1).cast("int")
    era = F.regexp_extract("partition", "bucket=([0-9]+)/era=([0-9]+)", 2).cast("bigint")
    return [(r[0], r[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").select(part, era).collect()]


def compact_table(spark: SparkSession, table: str, target_bytes: int = 256 << 20, open_eras: int = 1) -> list[tuple[int, int]]:
    """Put the small files of closed eras together, and return the partitions (bucket, era) that were rewritten.

    The last ``open_eras`` eras are still written to and left alone.  A partition is rewritten if it has more files than its
    bytes fill at ``target_bytes`` each.  Its rows are written to a new folder, counted, and put in place by
    one change of the catalog.  Who reads meanwhile sees every row once: the old files stay until :func:`drop_replaced`.
    The run directory is put in order too.
    """
    _require_managed(spark, table)
    there = _partitions(spark, table)
    closed = set(sorted({era for _, era in there})[: -open_eras or None])
    places = [(bucket, era) for bucket, era in there if era in closed]
    folder = _location(spark, table)
    hit = []
    with _many_folders(spark), setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes)):
        if places:
            logs = scan_logs(spark, table)
            most = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes))
            # One row per partition that is rewritten.
            small = _sizes(_with_files(logs.where(_inside(places))), left=F.count(F.lit(1))).where(F.col("files") > most)
            hit = small.select("bucket", "era", "folder", "left").collect()
        if hit:
            _switch(spark, table, folder, logs, hit, keep_old=True)
    replace_runs(spark, table, scan_runs(spark, table), folder)
    return sorted((row["bucket"], row["era"]) for row in hit)


def drop_replaced(spark: SparkSession, table: str, older_than: float = 24 * 3600) -> int:
    """Remove the files that compactions of at least ``older_than`` seconds ago replaced, and return the number of folders.

    Give readers that began before the compaction the time to end.
    """
    folder = f"{_location(spark, table)}/_replaced"
    lists = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = lists.getFileSystem(spark._jsc.hadoopConfiguration())
    n = 0
    for status in fs.listStatus(lists) if fs.exists(lists) else []:
        path = status.getPath()
        if int(path.getName().removesuffix(".json")) <= time.time_ns() - older_than * 1e9:
            for old in json.loads(get_text(spark, path.toString())):
                remove(spark, old)
                n += 1
            remove(spark, path.toString())
    return n

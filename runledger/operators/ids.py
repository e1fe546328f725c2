"""Row ids, positions within a run, and batches.

None of these sorts or numbers a whole group in one task.  A run may hold a
third of all rows, so positions are counted in slices of the id range first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runledger.session import write_through

# At most this many rows of a run are numbered by one task.
SLICE_WIDTH = 1 << 18

# Ids set aside for one micro-batch, see first_id().
BATCH_SPAN = 1 << 32

# The order in which files, and blocks of a file, count as having arrived.
ARRIVAL_COLUMNS = ["file_modification_time", "file_path", "file_block_start"]


# What tells a record from others; only rows that were moved since the scan have it.
RECORD_KEY = "_key"


def first_id(batch_id: int) -> int:
    """Largest id that lies before the ids of a micro-batch.

    Each micro-batch owns a fixed range of ids.  So ids ascend over batches, a
    replayed batch gets the ids it had, and no batch has to look up the
    largest id of a 100 TB table first.  Gaps in ids are allowed.  A batch of more
    rows takes the ranges that follow too, and its record tells the next one.
    """
    return batch_id * BATCH_SPAN


def _task_position() -> Column:
    return F.monotonically_increasing_id()


def assign_ids(df: DataFrame, order_cols: list, start: int = 0, partitions: int | None = None) -> DataFrame:
    """Add ``id``: ``start + 1 …`` without gaps, in the order of ``order_cols``.

    The order must be total.  One range shuffle, which is even whatever the
    keys look like, then a position per partition; adding the sizes of the
    partitions before needs only one number per partition.  The sorted rows are
    written out in between because range bounds are sampled: running the plan
    twice could draw other bounds and give an id twice.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    placed = write_through(ranged.withColumn("_place", _task_position()), "ids")

    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    # One row per range partition, n in all: small whatever the data.
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    position = F.col("_place") - F.shiftleft(F.col("_part"), 33)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.lit(start) + F.col("_before") + position + 1).cast("bigint").alias("id"))
    )


def arrival_blocks(batch: DataFrame, *more: Column) -> DataFrame:
    """``batch`` by the file blocks its rows came from: the rows in each, the rows before
    it, and where its first row stands in its task.  One row per block; ``_torn`` says
    that its rows are no longer together, because something moved them since the scan.
    ``more`` are further aggregates of a block."""
    blocks = batch.withColumn("_place", _task_position()).groupBy(*ARRIVAL_COLUMNS)
    together = F.max("_place") - F.min("_place") + 1 == F.count(F.lit(1))
    sizes = blocks.agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"), (~together).alias("_torn"), *more)
    order = W.orderBy(*ARRIVAL_COLUMNS).rowsBetween(W.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))


def assign_arrival_ids(batch: DataFrame, blocks: DataFrame, start: int = 0) -> DataFrame:
    """Add ``id`` to rows as they come from a file scan: ``start + 1 …`` without gaps, in
    order of file time, file path, and place in the file.

    Rows of a file block are read in order by one task, so the place in the
    task less that of the block's first row is the place in the block; the rows
    in the blocks before give the rest.  Rows are neither sorted nor shuffled
    if ``blocks`` (see :func:`arrival_blocks`) is broadcast.  ``batch`` must be
    the persisted batch of a streaming query, whose blocks are fixed.
    """
    found = F.coalesce(F.col("_before"), F.raise_error(F.lit("a file block changed while ids were assigned")))
    keep = [c for c in batch.columns if c not in ARRIVAL_COLUMNS]
    return (
        batch.withColumn("_place", _task_position())
        .join(blocks, ARRIVAL_COLUMNS, "left")
        .select(*keep, (F.lit(start) + found + F.col("_place") - F.col("_first") + 1).cast("bigint").alias("id"))
    )


def positions(logs: DataFrame, slice_width: int = SLICE_WIDTH, first: int | None = None) -> DataFrame:
    """Add ``position``: 1, 2, … within each run in id order; with ``first``, only that many per run.

    Rows are numbered per slice of a run, and the sizes of its earlier slices are added.  A slice is what the
    run has in an era (``era``, which the log table has; else in all); only where that is more than ``slice_width``
    rows is it cut finer, by ranges of ids.  So no task sorts more rows than that of one run, and however many
    batches wrote a table, there are not more sizes than runs and eras, and few more.
    With ``first``, rows too far back in their slice are dropped before the shuffle.
    """
    era = F.col("era") if "era" in logs.columns else F.lit(0).cast("bigint")
    keyed = logs.withColumn("_era", era)
    keys = ["agentic_run_id", "_era"]
    sizes = write_through(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    whole = F.lit(-1).cast("bigint")
    fine = F.call_function("div", F.col("id"), F.lit(slice_width))
    # At most one entry per ``slice_width`` rows.
    over = sizes.filter(F.col("_n") > slice_width).select(*keys, F.lit(True).alias("_over"))
    if over.isEmpty():
        keyed = keyed.withColumn("_slice", whole)
        sizes = sizes.withColumn("_slice", whole)
    else:
        keyed = keyed.join(over, keys, "left").withColumn("_slice", F.when(F.col("_over"), fine).otherwise(whole)).drop("_over")
        cut = keyed.filter("_slice >= 0").groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        sizes = sizes.filter(F.col("_n") <= slice_width).withColumn("_slice", whole).unionByName(cut)
    keys.append("_slice")
    earlier = W.partitionBy("agentic_run_id").orderBy("_era", "_slice").rowsBetween(W.unboundedPreceding, -1)
    # Only later slices of long runs have an offset, so this side stays short and
    # Spark may choose to broadcast it; it is not hinted.
    offsets = sizes.withColumn("_before", F.sum("_n").over(earlier)).filter(F.col("_before") > 0).select(*keys, "_before")
    in_slice = F.row_number().over(W.partitionBy(*keys).orderBy("id"))
    numbered = keyed.withColumn("_in_slice", in_slice)
    if first is not None:
        numbered = numbered.filter(F.col("_in_slice") <= first)
    placed = numbered.join(offsets, keys, "left").select(
        *logs.columns, (F.coalesce("_before", F.lit(0)) + F.col("_in_slice")).cast("bigint").alias("position")
    )
    return placed if first is None else placed.filter(F.col("position") <= first)


def assign_batches(df: DataFrame, size: int = 100) -> DataFrame:
    """Add ``batch``: every ``size`` consecutive ids form one."""
    return df.withColumn("batch", F.call_function("div", F.col("id") - 1, F.lit(size)))


def assign_slots(df: DataFrame, ts_col: str = "timestamp", width: str = "1 second") -> DataFrame:
    """Add ``slot``: start of the time slot a row falls into."""
    return df.withColumn("slot", F.window(ts_col, width)["start"])

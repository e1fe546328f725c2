"""Classes of texts that share buckets: compared within them by the Jaccard of their sets, in groups of bounded size."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import write_through
from runledger.llm.components import components

GROUP, HUBS = 256, 32
COLUMNS_AT_ONCE = 4096
CELLS = 1 << 24
SetsOf = Callable[[pa.Array], Iterator[np.ndarray]]


def links_between(sets: list[np.ndarray], least: float) -> np.ndarray:
    """For every set the first one that a chain of links leads to, where sets of a Jaccard of ``least`` or more are linked.

    Shared elements are counted for all pairs at once, as products of columns, some thousand elements at a time.
    """
    k = len(sets)
    sizes = np.array([len(s) for s in sets])
    elements, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.full(len(elements), -1)
    column[count > 1] = np.arange((count > 1).sum())
    doc, column = np.repeat(np.arange(k), sizes), column[place]
    order = np.argsort(column, kind="stable")
    order = order[np.searchsorted(column[order], 0) :]
    doc, column = doc[order], column[order]
    both = np.zeros((k, k), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, (low, low + COLUMNS_AT_ONCE))
        part = np.zeros((k, COLUMNS_AT_ONCE), np.float32)
        part[doc[a:b], column[a:b] - low] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes - both.astype(float)
    linked = (both > 0) & (both >= (least - 1e-9) * union)  # a Jaccard of just ``least`` counts however it is rounded
    linked |= np.eye(k, dtype=bool)
    label = np.arange(k)
    while True:
        after = np.where(linked, label, k).min(1)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _link(batches: Iterator[pa.RecordBatch], sets_of: SetsOf, least: float) -> Iterator[pa.RecordBatch]:
    """Rows in order of key and chunk; of every group the links that hold its classes together come out."""
    now, nodes, sets = None, [], []

    def flush():
        label = links_between(sets, least) if len(sets) > 1 else np.zeros(1, np.int64)
        at = np.flatnonzero(label != np.arange(len(label)))
        own = np.array(nodes, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(own[label[at]])], ["node", "hub"])

    for batch in batches:
        keys, chunks, ids = (batch.column(k).to_numpy() for k in range(3))
        for key, chunk, node, own in zip(keys, chunks, ids, sets_of(batch.column(3)), strict=True):
            if (key, chunk) != now:
                if nodes:
                    yield flush()
                now, nodes, sets = (key, chunk), [], []
            nodes.append(node)
            sets.append(own)
    if nodes:
        yield flush()


def _groups(members: DataFrame) -> DataFrame:
    """``key``, ``chunk``, ``node`` from ``key``, ``n`` (its members), ``node``.

    A bucket of up to GROUP texts is one group. A larger one is dealt into chunks, other ones
    for each key; every chunk also gets the HUBS texts of the bucket that are in the largest
    buckets, as the text that others were copied from is.
    """
    chunks = _dealt(F.col("n"))
    chunk = F.pmod(F.xxhash64("node", "key"), chunks)
    dealt = members.select("key", chunk.alias("chunk"), "node")
    large = members.where(F.col("n") > GROUP)
    central = large.groupBy("node").agg(F.sum("n").alias("weight"))
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("weight"), "node"))
    hubs = large.join(central, "node").select("key", "n", "node", first.alias("nr")).where(F.col("nr") <= HUBS)
    spread = hubs.select("key", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), "node")
    return dealt.unionByName(spread).distinct()


def _dealt(n: Column) -> Column:
    return F.ceil(n / GROUP).cast("long")


def _cells(members: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """Groups that bring together the texts of a large bucket that are in different classes so far.

    The texts outside a bucket's largest class meet all texts of the bucket whose sets are of a size
    that leaves a link possible: sizes have levels such that linked sets are at most one level apart,
    and the texts of two levels meet in blocks, so no group has more than about twice GROUP texts.
    """
    level = F.floor(F.log("size") / (1e-6 - math.log(least))).cast("int")
    label = F.coalesce("label", "node").alias("label")
    large = members.where(F.col("n") > GROUP).join(labels, "node", "left").select("key", "node", label, level.alias("level"))
    large = write_through(large, "large-buckets")
    classes = large.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = classes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("classes"))
    split = largest.where("classes > 1").select("key", F.col("most.label").alias("most"))
    rows = large.join(split, "key").select("key", "node", "level", (F.col("label") != F.col("most")).alias("outside"))
    sizes = rows.groupBy("key", "level").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("left"))
    near = sizes.where("left > 0").select("key", "level", _dealt(F.col("left")).alias("parts"))
    near = near.withColumn("other", F.explode(F.array(*[F.col("level") + d for d in (-1, 0, 1)])))
    pairs = near.join(sizes.select("key", F.col("level").alias("other"), _dealt(F.col("n")).alias("chunks")), ["key", "other"])

    def place(of: str) -> Column:
        return F.pmod(F.xxhash64("node", "key"), F.col(of))

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    outside = rows.where("outside").join(pairs, ["key", "level"])
    outside = outside.select("key", "level", "other", "chunks", "node", place("parts").alias("part"), every("chunks").alias("chunk"))
    met = rows.select("key", F.col("level").alias("other"), "node").join(pairs, ["key", "other"])
    met = met.select("key", "level", "other", "chunks", "node", every("parts").alias("part"), place("chunks").alias("chunk"))
    cell = (F.col("part") * F.col("chunks") + F.col("chunk")).alias("chunk")
    return outside.unionByName(met).select(F.xxhash64("key", "level", "other").alias("key"), cell, "node").distinct()


def likely(rows: DataFrame, wanted: DataFrame, on: str = "node") -> DataFrame:
    """The ``rows`` whose number ``on`` may be in ``wanted``: all that are there, and few others, without a shuffle.

    The numbers mark CELLS bits, and every task gets the 64-bit words that have any, 2^18 rows at most however many
    numbers there are. A full table passes everything, so what reads this joins with ``wanted`` behind it; no
    semi join, as the optimizer would put that first.
    """
    cell = F.pmod(on, F.lit(CELLS))
    word, bit = F.shiftright(cell, 6).cast("int"), F.expr(f"shiftleft(1L, cast(pmod({on}, {CELLS}) & 63 AS int))")
    marked = wanted.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    few = F.broadcast(write_through(marked, "cells"))
    met = rows.withColumn("word", word).join(few, "word")
    return met.where(bit.bitwiseAND(F.col("bits")) != 0).select(*rows.columns)


def classes(rows: DataFrame, texts: DataFrame, sets_of: SetsOf, least: float) -> DataFrame:
    """``node``, ``label`` of the texts that are linked to another one; the label is the least node of the class.

    ``rows`` are ``node``, ``key`` (a bucket), ``size`` (of the node's set); ``texts`` are ``node``, ``text``, a node
    repeated at will; ``sets_of`` gives the sets of an array of texts. Every two texts that share a
    bucket and have a Jaccard of ``least`` or more come into one class. Buckets of the same texts count once.
    Large buckets are compared in chunks that share hubs, which joins nearly all; then what is
    in different classes still is compared in blocks, whole. Only links that hold classes together come out.
    """
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who"))
    once = buckets.where("n > 1").groupBy("n", "who").agg(F.min("key").alias("key"))
    once = write_through(once.select("key", "n"), "bucket-keys")
    members = write_through(likely(rows, once, "key").join(once, "key"), "buckets")

    def linked(groups: DataFrame) -> DataFrame:
        groups = write_through(groups, "groups")
        wanted = likely(texts, groups).groupBy("node").agg(F.first("text").alias("text"))
        dealt = groups.join(wanted, "node").select("key", "chunk", "node", "text")
        dealt = dealt.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "node")
        return dealt.mapInArrow(lambda b: _link(b, sets_of, least), "node long, hub long")

    labels = write_through(components(linked(_groups(members))), "linked")
    if members.where(F.col("n") > GROUP).isEmpty():
        return labels
    cells = write_through(_cells(members, labels, least), "cells")
    if cells.isEmpty():
        return labels
    return components(labels.toDF("node", "hub").unionByName(linked(cells)))

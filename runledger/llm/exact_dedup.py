"""Exact copies by progressive refinement: length, then hash of a prefix, then hash of the whole.

Texts of a length that no other has are told apart at once, then those whose first bytes no other text of
that length has; only the rest is hashed as a whole. What a level leaves is marked in a table of at most CELLS cells,
which every task gets: a row whose cell is not marked is unique for sure, one in a marked cell goes on to the next, exact
level. So texts are never shuffled, and a full table costs hashes, not results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import join_by_weight, packed, unpacked, write_through

PREFIX_BYTES = 64
CELLS = 1 << 20


def _body(text: Column) -> Column:
    """UTF-8 bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def _cell(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(CELLS)).cast("int")


def _cells(groups: DataFrame, *keys: str) -> DataFrame:
    """The cells of groups of more than one row, CELLS integers at most."""
    shared = groups.where("n > 1").select(_cell(*[F.col(k) for k in keys]).alias("cell")).distinct()
    return F.broadcast(write_through(shared, "cells"))


def refine(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``full``, the SHA-256 of its text where length and prefix did not tell it apart.

    Also ``length`` and ``place``, a number that no other row has. Written to the shared folder.
    """
    body = _body(F.col(text))
    # One scan gives both keys: a columnar file hands over the whole text for either.
    keys = docs.select(F.octet_length(body).alias("length"), F.xxhash64(F.substring(body, 1, PREFIX_BYTES)).alias("head"))
    groups = write_through(keys.groupBy("length", "head").agg(F.count(F.lit(1)).alias("n")), "prefixes")
    of_length = groups.groupBy("length").agg(F.sum("n").alias("n"))
    lengths, heads = _cells(of_length, "length"), _cells(groups, "length", "head")

    row = F.struct(*[F.col("row").getField(c).alias(c) for c in docs.columns if keep_text or c != text])
    size = F.octet_length("body")
    sized = packed(docs, body=body).select(row.alias("row"), "body", size.alias("length"), _cell(size).alias("cell"))
    sized = sized.join(lengths.select("cell", F.lit(True).alias("same_length")), "cell", "left")
    head = F.when(F.col("same_length"), _cell("length", F.xxhash64(F.substring("body", 1, PREFIX_BYTES))))
    headed = sized.drop("cell").withColumn("cell", head)
    headed = headed.join(heads.select("cell", F.lit(True).alias("same_head")), "cell", "left")
    full = F.when(F.col("same_head"), F.unhex(F.sha2("body", 256)))
    place = F.monotonically_increasing_id()
    return write_through(headed.select("row", "length", full.alias("full"), place.alias("place")), "refined")


def mark_copies(docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """All rows of ``docs`` with ``keep_id``, ``group_size`` and ``kept``; without the text if ``keep_text`` is false.

    Texts are equal when their bytes are; null is the empty text. One row of a group stays: that of the largest
    id, null ids last; of rows equal in id and text the one whose other columns hash highest, so
    that reruns differ only between rows that are equal in all. ``keep_id`` is the id of that row. An empty
    table gives an empty one. The new columns replace input columns of the same name. A third of all rows
    may be one text: groups are counted before the shuffle, and the largest are joined by broadcast.
    """
    rows = refine(docs, text, keep_text)
    names = [f.name for f in rows.schema["row"].dataType if f.name != text]
    others = F.xxhash64(F.to_json(F.struct(*[F.col("row").getField(n).alias(n) for n in names])))
    order = F.struct(F.col("row").getField(id_column).alias("id"), others.alias("others"), F.col("place").alias("place"))
    alike = rows.where("full IS NOT NULL").groupBy("full")
    groups = alike.agg(F.count(F.lit(1)).alias("n"), F.max(order).alias("best")).where("n > 1")
    groups = write_through(groups.select("full", "n", "best.id", F.col("best.place").alias("chosen")), "copies")

    own = F.col("row").getField(id_column)
    told = rows.where("full IS NULL").select("row", own.alias("id"), F.lit(1).cast("bigint").alias("n"), F.lit(True).alias("stays"))
    joined = join_by_weight(rows.where("full IS NOT NULL"), groups, "full", "n").select(
        "row",
        F.when(F.col("n").isNull(), own).otherwise(F.col("id")).alias("id"),
        F.coalesce("n", F.lit(1)).alias("n"),
        F.coalesce(F.col("chosen") == F.col("place"), F.lit(True)).alias("stays"),
    )
    found = told.unionByName(joined)
    return unpacked(found, keep_id=F.col("id"), group_size=F.col("n"), kept=F.col("stays"))


def drop_copies(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, see :func:`mark_copies`."""
    marked = mark_copies(docs.select(F.struct("*").alias("whole"), F.col(text).alias("t"), F.col(id_column).alias("i")), "t", "i")
    return marked.where("kept").select("whole.*")

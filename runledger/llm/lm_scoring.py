"""Scores by cross-entropy difference: how much better a model of chosen text predicts a document than one of all text.

Both models are interpolated n-gram models over the same tokens (UTF-8 bytes, A-Z in lower
case), the same n-grams and the same smoothing. All documents count for the
background; no n-gram is left out. Every n-gram's two losses are computed once, and
blocks of documents fetch those of the n-grams they have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import quoted, write_through
from runledger.llm.textbytes import parts

ORDER = 5
SMOOTHING = 8.0
BLOCK_BYTES = 24 << 20
CHUNK_BYTES = 1 << 20
_fold = np.arange(256, dtype=np.uint64)
_fold[65:91] += np.uint64(32)


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte the ORDER bytes that end with it as one number; zero bytes stand before a text."""
    out = np.zeros(len(data), np.uint64)
    into = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))  # place in its text
    folded = _fold[data]
    for k in range(ORDER):
        earlier = folded if k == 0 else np.concatenate((np.zeros(k, np.uint64), folded[:-k]))[: len(data)]
        out |= np.where(into >= k, earlier, np.uint64(0)) << np.uint64(8 * k)
    return out


def _added(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    sums = [np.bincount(place, np.concatenate([h[k] for h in held]), len(keys)).astype(np.int64) for k in (1, 2)]
    return keys, *sums


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of block; in each the chosen ids first, then its documents. Out come block, key, background, target."""
    held: list = []
    now, chosen = None, set()

    def flush():
        keys, background, target = _added(held)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), now, np.int32)), pa.array(keys.astype(np.int64)), pa.array(background), pa.array(target)],
            ["block", "key", "background", "target"],
        )

    for batch in batches:
        blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for low, high in zip([0, *edges], [*edges, len(blocks)], strict=True):
            part = batch.slice(low, high - low)
            if blocks[low] != now:
                if held:
                    yield flush()
                now, held, chosen = blocks[low], [], set()
            if kinds[low] == 0:
                chosen.update(part.column(2).to_pylist())
                continue
            target = np.array([x in chosen for x in part.column(2).to_pylist()], bool)
            for first, data, offsets in parts(part.column(3), CHUNK_BYTES):
                keys = grams(data, offsets)
                inside = np.repeat(target[first : first + len(offsets) - 1], np.diff(offsets))
                found, counts = np.unique(keys, return_counts=True)
                some, more = np.unique(keys[inside], return_counts=True)
                own = np.zeros(len(found), np.int64)
                own[np.searchsorted(found, some)] = more
                held.append((found, counts, own))
                if len(held) > 16:
                    held = [_added(held)]
    if held:
        yield flush()


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of block; in each the losses of its n-grams first, then its documents."""
    now, held, table = None, [], None
    for batch in batches:
        blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for low, high in zip([0, *edges], [*edges, len(blocks)], strict=True):
            part = batch.slice(low, high - low)
            if blocks[low] != now:
                now, held, table = blocks[low], [], None
            if kinds[low] == 0:
                held.append([part.column(k).to_numpy() for k in (2, 3, 4)])
                continue
            if table is None:
                columns = [np.concatenate(c) for c in zip(*held, strict=True)] or [np.zeros(0)] * 3
                order = np.argsort(columns[0].astype(np.uint64))
                table, held = [columns[0][order].astype(np.uint64), columns[1][order], columns[2][order]], []
            for first, data, offsets in parts(part.column(6), CHUNK_BYTES):
                n = len(offsets) - 1
                keys = grams(data, offsets)
                place = np.searchsorted(table[0], keys)
                doc = np.repeat(np.arange(n), np.diff(offsets))
                tokens = np.diff(offsets)
                sums = [np.bincount(doc, table[k][place], n) if len(doc) else np.zeros(n) for k in (1, 2)]
                with np.errstate(divide="ignore", invalid="ignore"):
                    means = [np.where(tokens > 0, s / tokens, 0.0) for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [part.column(5).slice(first, n), pa.array(tokens), *map(pa.array, means), pa.array(means[0] - means[1])],
                    ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
                )


def losses(counts: DataFrame) -> DataFrame:
    """``key``, ``target_loss``, ``background_loss`` (nats) of every n-gram, from ``key``, ``background``, ``target``.

    P_k(b | context) = (count + s P_(k-1)(b | shorter context)) / (count of context + s), down to
    single bytes with one added to each; contexts have at most 256 n-grams each.
    """
    level, models = None, ("target", "background")
    for k in range(1, ORDER + 1):
        mask = (1 << (8 * k)) - 1
        rows = counts.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(*[F.sum(m).alias(m) for m in models])
        context = Window.partitionBy(F.shiftright("key", 8))
        if k == 1:
            every = [((F.col(m) + 1) / (F.sum(m).over(context) + 256)).alias(f"{m}_p") for m in models]
            level = rows.select("key", *every)
            continue
        totals = rows.select("*", *[F.sum(m).over(context).alias(f"{m}_all") for m in models])
        shorter = level.withColumnRenamed("key", "short")
        met = totals.withColumn("short", F.col("key").bitwiseAND(F.lit(mask >> 8))).join(shorter, "short")
        level = met.select(
            "key", *[((F.col(m) + SMOOTHING * F.col(f"{m}_p")) / (F.col(f"{m}_all") + SMOOTHING)).alias(f"{m}_p") for m in models]
        )
        level = write_through(level, f"losses-{k}") if k >= ORDER - 1 else level
    return level.select("key", *[(-F.log(f"{m}_p")).alias(f"{m}_loss") for m in models])


def score(
    df: DataFrame, chosen: DataFrame, text: str = "text", doc_id: str = "doc_id", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_tokens, target_loss, background_loss (means per token) and ``score``, their difference.

    The lower the score the more the text is like that of ``chosen``, a table with the ids (``doc_id``) of the
    target's documents; nulls in it, repeats and ids of no document count for nothing. A null text counts
    as empty; a text without tokens scores 0. Equal rows get equal results; an empty table gives an empty
    one. Without a chosen document all n-grams have the same target loss by smoothing alone.
    Documents of one id are in one block; a block is read as a stream beside the n-grams it has.
    """
    kind = df.schema[doc_id].dataType.simpleString()
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    size = df.agg(F.sum(F.octet_length(body))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    rows = df.select(F.col(quoted(doc_id)).alias("doc_id"), body.alias("text")).withColumn("block", block)
    ids = chosen.select(F.col("doc_id").cast(kind)).where("doc_id is not null").distinct()
    marks = ids.select(block.alias("block"), F.lit(0).alias("kind"), "doc_id", F.lit(None).cast("string").alias("text"))
    both = marks.unionByName(rows.select("block", F.lit(1).alias("kind"), "doc_id", "text"))
    by_block = both.repartition(int(blocks), "block").sortWithinPartitions("block", "kind")
    # A block is whole in one partition, so each of its n-grams comes out once.
    counts = write_through(by_block.mapInArrow(_count, "block int, key long, background long, target long"), "gram-counts")
    model = losses(counts.groupBy("key").agg(F.sum("background").alias("background"), F.sum("target").alias("target")))
    none = F.lit(None)
    slices = counts.select("block", "key").join(model, "key").select(
        "block", F.lit(0).alias("kind"), "key", "target_loss", "background_loss", none.cast(kind).alias("doc_id"), none.cast("string").alias("text")
    )
    texts = rows.select(
        "block", F.lit(1).alias("kind"), none.cast("long").alias("key"), none.cast("double").alias("target_loss"),
        none.cast("double").alias("background_loss"), "doc_id", "text",
    )
    dealt = slices.unionByName(texts).repartition(int(blocks), "block").sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(
        _score, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, score double"
    )

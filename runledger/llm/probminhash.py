"""Near-duplicates by ProbMinHash: signatures whose agreement estimates the probability Jaccard of weighted shingles.

Every shingle sends exponential arrivals, at a rate that is its weight, to random
registers; a register keeps who came first, and shingles whose next arrival is later
than every register's first stop. Bands of registers put texts into buckets, in which they are compared
by the plain Jaccard of their sets. Where shingles are repeated unequally the probability Jaccard is below it, so
a second signature, with all weights 1, gives bands too: its agreement estimates the plain Jaccard itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.buckets import classes
from runledger.llm.common import digest_of, packed, quoted, unpacked, write_through
from runledger.llm.textbytes import mixed, parts, shingles, weighted

BANDS, ROWS = 32, 6
CHUNK_BYTES = 4 << 20
_U = np.uint64


def signatures(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """docs x registers: the shingle that arrived first; 0 in texts without shingles."""
    first = np.full(docs * registers, np.inf)
    who = np.zeros(docs * registers, _U)
    clock, state = np.zeros(len(doc)), hashes.copy()
    step = _U(0x9E3779B97F4A7C15)
    doc, weights = doc.copy(), weights.astype(float)
    while len(doc):
        state = state + step
        draw = mixed(state)
        clock = clock - np.log(((draw >> _U(11)).astype(float) + 0.5) / (1 << 53)) / weights
        at = doc * registers + (mixed(draw ^ step) % _U(registers)).astype(np.int64)
        better = clock < first[at]
        slot, when, what = at[better], clock[better], hashes[better]
        np.minimum.at(first, slot, when)
        won = first[slot] == when
        who[slot[won]] = what[won]
        table = first.reshape(docs, registers)
        still = clock < (table.max(1)[doc] if len(doc) >= docs else table[doc].max(1))
        doc, hashes, weights, clock, state = doc[still], hashes[still], weights[still], clock[still], state[still]
    return who.reshape(docs, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """docs x bands: one number for each band of a signature."""
    out = np.zeros((len(signature), bands), _U)
    out += mixed(np.arange(bands, dtype=_U))
    for k in range(rows):
        out = mixed(out ^ signature[:, k * bands : (k + 1) * bands])
    return out.astype(np.int64)


def both_keys(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, docs: int) -> np.ndarray:
    """docs x 2 BANDS: the keys of the weighted signature, then those of the signature with all weights 1.

    Both come from the same draws, so in a text that repeats no shingle they are the same; only others are drawn again.
    """
    keys = band_keys(signatures(doc, hashes, weights, docs, BANDS * ROWS))
    plain = keys.copy()
    repeats = np.zeros(docs, bool)
    repeats[doc[weights > 1]] = True
    if repeats.any():
        some = repeats[doc]
        number = np.cumsum(repeats) - 1
        again = signatures(number[doc[some]], hashes[some], np.ones(int(some.sum())), int(repeats.sum()), BANDS * ROWS)
        plain[repeats] = band_keys(again)
    return np.hstack((keys, plain))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, data, offsets in parts(batch.column(1), CHUNK_BYTES):
            n = len(offsets) - 1
            own = weighted(*shingles(data, offsets))
            keys = both_keys(*own, n)
            sizes = np.bincount(own[0], minlength=n)
            ends = np.concatenate(([0], np.cumsum(np.where(sizes > 0, keys.shape[1], 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[sizes > 0].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, n), pa.array(sizes), lists], ["node", "size", "keys"])


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted shingles of every text."""
    for _, data, offsets in parts(texts, CHUNK_BYTES):
        doc, hashes, _ = weighted(*shingles(data, offsets))
        ends = np.searchsorted(doc, np.arange(len(offsets)))
        for low, high in zip(ends[:-1], ends[1:], strict=True):
            yield hashes[low:high]


def near_classes(df: DataFrame, text: str = "text", least: float = 0.8) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``node``, ``label`` of every different text, and what gives a text's node.

    Signatures are banded, weighted and plain ones; texts that share a band's key form a bucket. All texts of a bucket, however
    large it is, are compared by the Jaccard of their sets of five-word shingles (see ``buckets.classes``). So weights
    decide which pairs are compared besides those of the plain bands, never whether a pair is linked.
    Texts without words are alike only if equal. Null texts count as empty.
    """
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    node_of = digest_of(df, F.col(quoted(text)))
    texts = df.select(node_of(F.col(quoted(text))).alias("node"), body.alias("text"))
    signed = texts.mapInArrow(_sign, "node long, size long, keys array<long>")
    signed = write_through(signed.groupBy("node").agg(F.first("size").alias("size"), F.first("keys").alias("keys")), "signatures")
    rows = signed.select("node", "size", F.explode(F.array_distinct("keys")).alias("key"))
    labels = signed.select("node").join(classes(rows, texts, shingle_sets, least), "node", "left")
    return labels.select("node", F.coalesce("label", "node").alias("label")), node_of


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = 0.8) -> DataFrame:
    """One row per document: its id as ``doc_id``, ``class_id`` (the least id in its class), ``node``, ``kept``.

    Documents are in a class if a chain of pairs with a similarity of ``least`` or more
    links them, or if their texts are equal. One document of each class is kept: that
    with the least id (a null comes first), of several texts with it the one with the
    least node, of equal rows the first. An empty table gives an empty one.
    """
    return _placed(df, text, doc_id, least)[0]


def _placed(df: DataFrame, text: str, doc_id: str, least: float) -> tuple[DataFrame, Callable[[Column], Column]]:
    labels, node_of = near_classes(df, text, least)
    labels = write_through(labels, "labels")
    rows = df.select(F.col(quoted(doc_id)).alias("id"), node_of(F.col(quoted(text))).alias("node"))
    counted = rows.groupBy("id", "node").agg(F.count(F.lit(1)).alias("n"))
    placed = write_through(counted.join(labels, "node"), "placed")
    firsts = placed.groupBy("label").agg(F.min(F.struct("id", "node")).alias("first"))
    winner = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("node") == F.col("first.node"))
    turns = placed.join(firsts, "label").withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    kept = (winner & (F.col("turn") == 1)).alias("kept")
    return turns.select(F.col("id").alias("doc_id"), F.col("first.id").alias("class_id"), "node", kept), node_of


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps: one of each class, with all columns."""
    placed, node_of = _placed(docs, text, doc_id, least)
    kept = placed.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("node").alias("kept_node"))
    # Copies of a text have ids of their own, so the pair of id and text spreads them.
    own = F.col("row").getField(text)
    rows = packed(docs).select("row", F.col("row").getField(doc_id).alias("id"), node_of(own).alias("node"))
    met = rows.join(kept, (F.col("node") == F.col("kept_node")) & F.col("id").eqNullSafe(F.col("kept_id")))
    return unpacked(met.dropDuplicates(["kept_node", "kept_id"]))

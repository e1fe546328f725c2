"""Passages of so many words that are found again, however few bytes they have.

A window of words is put into the bucket of its least run of GRAM words, by a hash;
windows that start side by side mostly share it, so a bucket gets one *run* of them. Runs
with a bucket of their own repeat nothing; equal runs repeat wholly. Only the windows of
different runs in one bucket are told apart one by one, by 128-bit digests of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import write_through
from runledger.llm.textbytes import BASE, CODES, INVERSE, mixed, parts, powers, words

GRAM = 16
CHUNK_BYTES = 1 << 20
PLACE_BITS = 21
MOST_WORDS = 1 << 20
_U = np.uint64
_CODES_2 = mixed(CODES) | _U(1)
_BASE_2 = int(mixed(np.array([BASE], _U))[0]) | 5
_INVERSE_2 = pow(_BASE_2, -1, 1 << 64)
_KINDS = ((CODES, BASE, INVERSE), (_CODES_2, _BASE_2, _INVERSE_2))


def _word_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
    """Prefix sums of a polynomial over the hashes of the words; ``_span`` reads hashes of runs of words from them."""
    codes, base, inverse = _KINDS[kind]
    prefix = np.zeros(len(data) + 1, _U)
    np.cumsum(codes[data] * powers(base, len(data)), out=prefix[1:])
    hashes = mixed((prefix[ends] - prefix[starts]) * powers(inverse, len(prefix))[starts])
    out = np.zeros(len(starts) + 1, _U)
    np.cumsum(hashes * powers(base, len(hashes)), out=out[1:])
    return out


def _span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
    return mixed((prefix[end] - prefix[start]) * powers(_KINDS[kind][2], len(prefix))[start])


def _starts(doc: np.ndarray, texts: int, n: int) -> np.ndarray:
    """For each word whether a window of ``n`` words of its text starts with it."""
    last = np.cumsum(np.bincount(doc, minlength=texts))  # one past a text's last word
    return np.arange(len(doc)) + n <= last[doc]


def word_runs(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """text, first byte, byte behind the last one, bucket and hash of each run of windows of ``n`` words."""
    doc, starts, ends = words(data, offsets)
    valid = _starts(doc, len(offsets) - 1, n)
    if not valid.any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
    gram = max(1, min(GRAM, n // 2))
    prefix = _word_sums(data, starts, ends, 0)
    at = np.arange(len(doc) - gram + 1)
    grams = _span(prefix, at, at + gram, 0)
    mask = _U((1 << PLACE_BITS) - 1)
    low = (grams & ~mask) | at.astype(_U)
    width, reach = n - gram + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    place = (low & mask).astype(np.int64)
    valid = valid[: len(place)]
    head = valid.copy()
    head[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    stop = valid.copy()
    stop[:-1] &= head[1:] | ~valid[1:]
    first, last = np.flatnonzero(head), np.flatnonzero(stop) + n  # words of a run
    return doc[first], starts[first], ends[last - 1], grams[place[first]], _span(prefix, first, last, 0)


def pieces(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts of at most CHUNK_BYTES together, or slices of a longer one, of whole words, that share n - 1 words with the next."""
    if len(data) <= CHUNK_BYTES:
        yield 0, data, offsets
        return
    low, size = 0, CHUNK_BYTES  # then it is one text
    while True:
        part = data[low : low + size]
        more = low + size < len(data)
        _, starts, ends = words(part, np.array([0, len(part)]))
        if more and len(starts) <= n + 1:  # the last word may go on
            size *= 2
            continue
        taken = min(len(starts) - more, MOST_WORDS)
        if taken == len(starts):
            yield low, part, np.array([0, len(part)])
            return
        yield low, part[: ends[taken - 1]], np.array([0, ends[taken - 1]])
        low, size = low + int(starts[taken - n + 1]), CHUNK_BYTES


_RUNS = "t long, bucket long, x long, low long, high long, again boolean, spans array<struct<low: long, high: long>>"


def _cut(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("low", pa.int64()), ("high", pa.int64())])
    for batch in batches:
        t = batch.column(0).to_numpy()
        for first, whole, whole_offsets in parts(batch.column(1), CHUNK_BYTES):
            for base, data, offsets in pieces(whole, whole_offsets, n):
                doc, low, high, bucket, x = word_runs(data, offsets, n)
                if not len(doc):
                    continue
                low, high = low - offsets[doc] + base, high - offsets[doc] + base
                # Equal runs of one text: its first one stands for them, and their places are settled here.
                order = np.lexsort((x, bucket, doc))
                new = np.ones(len(order), bool)
                new[1:] = False
                for k in (doc, bucket, x):
                    new[1:] |= k[order[1:]] != k[order[:-1]]
                group = np.empty(len(doc), np.int64)
                group[order] = np.cumsum(new) - 1
                leader = order[new][group]  # the sort is stable, so the first in the text
                many = np.bincount(group)[group] > 1
                lists: dict[int, list] = {}
                for i in np.flatnonzero(many):
                    own = lists.setdefault(int(leader[i]), [])
                    if own and low[i] <= own[-1]["high"]:
                        own[-1]["high"] = int(high[i])
                    else:
                        own.append({"low": int(low[i]), "high": int(high[i])})
                keep = np.flatnonzero(leader == np.arange(len(doc)))
                cols = [t[first + doc[keep]], bucket[keep].astype(np.int64), x[keep].astype(np.int64), low[keep], high[keep], many[keep]]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, cols), pa.array([lists.get(int(i)) for i in keep], pa.list_(span))],
                    ["t", "bucket", "x", "low", "high", "again", "spans"],
                )


_WINDOWS = "t long, whole boolean, low long, high long, w1 long, w2 long"


def _digest(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Of every run, a row with its text, the windows."""
    for batch in batches:
        t, whole, base = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        for first, data, offsets in parts(batch.column(3), CHUNK_BYTES):
            doc, starts, ends = words(data, offsets)
            at = np.flatnonzero(_starts(doc, len(offsets) - 1, n))
            own = doc[at]
            back = base[first + own] - offsets[own]
            digests = [_span(_word_sums(data, starts, ends, k), at, at + n, k).astype(np.int64) for k in (0, 1)]
            cols = [t[first + own], whole[first + own], starts[at] + back, ends[at + n - 1] + back, *digests]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols)], [x.split()[0] for x in _WINDOWS.split(", ")])


def repeated_passages(texts: DataFrame, n: int) -> DataFrame:
    """``t``, ``low``, ``high``: ranges of bytes of the windows of ``n`` words that start elsewhere too, in any text or the
    same one, from ``t`` (a number of the text), ``text``, a row for each document.

    Words are compared by their bytes, whatever space is between them.
    """
    if n < 2:
        raise ValueError("a passage has two words at least")
    long_enough = texts.where(F.octet_length("text") >= 2 * n - 1)
    found = write_through(long_enough.mapInArrow(lambda b: _cut(b, n), _RUNS), "word-runs")
    inside = found.where("spans is not null").select("t", F.inline("spans"))
    shared = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    found = found.select("t", "bucket", "x", "low", "high", "again").join(shared, "bucket", "left_semi")
    found = write_through(found, "shared-word-runs")
    classes = found.groupBy("bucket", "x").agg(
        F.count(F.lit(1)).alias("n"), F.max("again").alias("again"), F.min(F.struct("t", "low", "high")).alias("run")
    )
    classes = write_through(classes, "word-run-classes")
    # Runs that are equal: all their windows repeat.
    often = classes.where("n > 1").select("bucket", "x")
    whole = found.join(often, ["bucket", "x"], "left_semi").select("t", "low", "high")
    # Runs that differ but share a bucket: of each kind one tells its windows.
    several = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("bucket")
    wanted = classes.join(several, "bucket", "left_semi")
    wanted = wanted.select(((F.col("n") > 1) | F.col("again")).alias("whole"), "run.*")
    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("whole", "low", "high")).alias("runs"))
    one_text = texts.join(lists.select("t"), "t", "left_semi").groupBy("t").agg(F.first("text").alias("text"))
    cut = F.expr(
        "transform(runs, r -> struct(r.whole, r.low,"
        " substring(cast(text as binary), cast(r.low + 1 as int), cast(r.high - r.low as int)) as text))"
    )
    rows = one_text.join(lists, "t").select("t", F.explode(cut).alias("r")).select("t", "r.*")
    windows = write_through(rows.mapInArrow(lambda b: _digest(b, n), _WINDOWS), "windows")
    again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    partly = windows.where("not whole").join(again, ["w1", "w2"], "left_semi").select("t", "low", "high")
    return whole.union(inside).union(partly).distinct()

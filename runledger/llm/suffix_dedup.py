"""Removal of repeated passages: blockwise suffix sorting with a difference cover.

Equal strings must meet in one bucket that a task can sort. A string of
LENGTH bytes is put into the bucket of its least substring of GRAM bytes, by a hash; strings
that start side by side mostly share it, so a bucket gets one *run* of them, the text
from the first one's start to the last one's end. Runs with a bucket of their own
repeat nothing; equal runs repeat wholly. Only buckets of different runs are
sorted, one after the other and of bounded size: suffixes by their first PERIOD
bytes, and longer ties by the ranks of the suffixes at difference-cover positions,
computed before; neighbours are then compared byte by byte. What a large bucket's
parts have found is put together by digests of the strings. Repeats that are counted
in words, whatever their length in bytes, come from ``passages``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.llm import textbytes
from runledger.llm.common import digest_of, quoted, write_through
from runledger.llm.passages import repeated_passages
from runledger.llm.textbytes import BASE, CODES, mixed, parts, powers

LENGTH, GRAM = 400, 128
PERIOD = 32
RUNS_AT_ONCE = 512
CHUNK_BYTES = 1 << 20
PLACE_BITS = 21
SORT_BYTES = 2 << 20
_U = np.uint64
CODES_2 = mixed(CODES) | _U(1)
BASE_2 = int(mixed(np.array([BASE], _U))[0]) | 5


def difference_cover(period: int) -> list[int]:
    """Residues such that every difference modulo ``period`` is one of two of them; chosen greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        gain = {x: {(x - y) % period for y in cover} | {(y - x) % period for y in cover} for x in range(period)}
        best = max(range(period), key=lambda x: (len(gain[x] & missing), -x))
        cover.append(best)
        missing -= gain[best]
    return sorted(cover)


COVER = np.array(difference_cover(PERIOD))
_slot = np.full(PERIOD, -1)
_slot[COVER] = np.arange(len(COVER))
_shift = np.array([
    [next(d for d in range(PERIOD) if _slot[(a + d) % PERIOD] >= 0 <= _slot[(b + d) % PERIOD]) for b in range(PERIOD)]
    for a in range(PERIOD)
])


def _prefix_words(text: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The PERIOD bytes at each place as numbers that sort as the bytes do, first ones first."""
    view = np.lib.stride_tricks.sliding_window_view(text, PERIOD)
    block = np.ascontiguousarray(view[at])
    return list(block.view(">u8").astype(_U).T)


def _sorted_by(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order by ``keys``, the first counting most, and in it where a new combination starts."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    return order, new


def cover_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks, by ``depth`` bytes or more, of the suffixes at cover positions. The period leads from one to another,
    so doubling needs no other suffixes."""
    blocks = (len(text) - PERIOD) // PERIOD
    at = (np.arange(blocks)[:, None] * PERIOD + COVER).ravel()
    order, new = _sorted_by(_prefix_words(text, at))
    rank = np.empty(len(at), np.int64)
    rank[order] = np.cumsum(new)
    reach, step = PERIOD, len(COVER)
    while reach < depth:
        later = np.zeros(len(at), np.int64)
        later[: max(0, len(at) - step)] = rank[step:]
        pair = rank * (len(at) + 1) + later
        order = np.argsort(pair, kind="stable")
        ranks = np.cumsum(np.concatenate(([True], pair[order[1:]] != pair[order[:-1]])))
        rank[order] = ranks
        reach, step = 2 * reach, 2 * step
    return rank


def sort_suffixes(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``starts`` by bucket and suffix, to ``depth`` bytes at least, and where another bucket or prefix begins."""
    keys = [bucket, *_prefix_words(text, starts)]
    order, new = _sorted_by(keys)
    group = np.cumsum(new) - 1
    tied = np.flatnonzero(np.bincount(group)[group] > 1)
    if len(tied):
        rank = cover_ranks(text, depth)
        at, seg, mine = tied, group[tied], order[tied]
        while len(at):
            head = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
            size = np.diff(np.append(head, len(seg)))
            pivot = np.repeat(starts[mine[head + size // 2]], size)
            own = starts[mine]
            shift = _shift[own % PERIOD, pivot % PERIOD]
            a, b = own + shift, pivot + shift
            width = len(COVER)
            side = np.sign(rank[a // PERIOD * width + _slot[a % PERIOD]] - rank[b // PERIOD * width + _slot[b % PERIOD]])
            key = np.repeat(np.arange(len(head)), size) * 3 + side + 1
            moved = np.argsort(key, kind="stable")
            mine, key = mine[moved], key[moved]
            order[at] = mine
            open_ = key % 3 != 1  # those equal to the pivot are in place
            at, seg, mine = at[open_], key[open_], mine[open_]
            alone = np.bincount(seg)[seg] == 1 if len(seg) else np.zeros(0, bool)
            at, seg, mine = at[~alone], seg[~alone], mine[~alone]
    return order, new


def repeated(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start, whether its ``length`` bytes are found at another start of its bucket, and whether it is the
    first of such (or the only one)."""
    padded = np.concatenate((text, np.zeros(4 * PERIOD + 2 * length, np.uint8)))
    order, new = sort_suffixes(padded, starts, bucket, length)
    view = np.lib.stride_tricks.sliding_window_view(padded, length)
    same = np.zeros(len(order) + 1, bool)  # with the one before
    for low in range(0, len(order), 1 << 14):
        i = np.arange(low, min(low + (1 << 14), len(order)))
        i = i[~new[i]]
        same[i] = (view[starts[order[i]]] == view[starts[order[i - 1]]]).all(1)
    again, first = np.zeros(len(order), bool), np.zeros(len(order), bool)
    again[order] = same[:-1] | same[1:]
    first[order] = ~same[:-1]
    return again, first


def _sums_2(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(CODES_2[data] * powers(BASE_2, len(data)), out=out[1:])
    return out


def _span_2(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((prefix[end] - prefix[start]) * powers(pow(BASE_2, -1, 1 << 64), len(prefix))[start])


def _spans(flags: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)), 1)


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """text, start, strings (how many side by side), bucket and hash of each run."""
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
    prefix = textbytes.sums(data)
    grams = mixed((prefix[gram:] - prefix[:-gram]) * powers(textbytes.INVERSE, n)[: n - gram + 1])
    mask = _U((1 << PLACE_BITS) - 1)
    low = (grams & ~mask) | np.arange(len(grams), dtype=_U)
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    place = (low & mask).astype(np.int64)
    valid = np.zeros(len(place) + 1, np.int32)
    sizes = np.diff(offsets)
    np.add.at(valid, offsets[:-1][sizes >= length], 1)
    np.add.at(valid, (offsets[1:] - length + 1)[sizes >= length], -1)
    valid = np.cumsum(valid[:-1]) > 0
    head = valid.copy()
    head[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(head)
    stop = valid.copy()
    stop[:-1] &= head[1:] | ~valid[1:]
    ends = np.flatnonzero(stop) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    tail = ends + length - 1
    return doc, starts - offsets[doc], ends - starts, grams[place[starts]], textbytes.span(prefix, starts, tail)


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts of at most CHUNK_BYTES together, or slices of a longer one that share length - 1 bytes with the next."""
    if len(data) <= CHUNK_BYTES + length:
        yield 0, 0, data, offsets
    else:  # then it is one text
        for low in range(0, len(data) - length + 1, CHUNK_BYTES):
            part = data[low : low + CHUNK_BYTES + length - 1]
            yield 0, low, part, np.array([0, len(part)])


_RUNS = "t long, bucket long, x long, start long, strings int, again boolean, spans array<long>"


def _cut_runs(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = batch.column(0).to_numpy()
        for first, data, offsets in parts(batch.column(1), CHUNK_BYTES):
            for _, base, part, own in _pieces(data, offsets, length):
                doc, start, strings, bucket, x = runs(part, own, length, gram)
                if not len(doc):
                    continue
                start = start + base
                # Equal runs of one text: its first one stands for them, and their places are settled here.
                order, new = _sorted_by([doc.astype(_U), bucket, x])
                group = np.empty(len(doc), np.int64)
                group[order] = np.cumsum(new) - 1
                leader = order[new][group]  # the sort is stable, so the first in the text
                many = np.bincount(group)[group] > 1
                lists: list = [None] * len(doc)
                for d in np.unique(doc[many]):
                    mine = many & (doc == d)
                    flags = np.zeros(len(part) + 1, np.int8)
                    np.add.at(flags, start[mine] - base, 1)
                    np.add.at(flags, start[mine] - base + strings[mine], -1)
                    lists[leader[np.flatnonzero(mine)[0]]] = (_spans(np.cumsum(flags) > 0) + base).ravel()
                keep = np.flatnonzero(leader == np.arange(len(doc)))
                cols = [
                    t[first + doc[keep]], bucket[keep].astype(np.int64), x[keep].astype(np.int64), start[keep],
                    strings[keep].astype(np.int32), many[keep],
                ]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, cols), pa.array([lists[i] for i in keep], pa.list_(pa.int64()))],
                    [x.split()[0] for x in _RUNS.split(", ")],
                )


_FOUND = "t long, low long, high long, w1 array<long>, w2 array<long>, place array<long>"


def _sort_buckets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of bucket and part; whole parts are sorted, as many at once as make some MB."""
    held: list[dict] = []
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            if held and size >= SORT_BYTES and (row["bucket"], row["part"]) != (held[-1]["bucket"], held[-1]["part"]):
                yield _sort_rows(held, length)
                held, size = [], 0
            held.append(row)
            size += len(row["text"])
    if held:
        yield _sort_rows(held, length)


def _sort_rows(rows: list[dict], length: int) -> pa.RecordBatch:
    text = np.frombuffer(b"".join(r["text"] for r in rows), np.uint8)
    sizes = np.array([len(r["text"]) for r in rows])
    strings = sizes - length + 1
    base = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(rows)), strings)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
    starts = base[row] + inner
    names: dict = {}
    bucket = np.array([names.setdefault((r["bucket"], r["part"]), len(names)) for r in rows], _U)[row]
    again, first = repeated(text, starts, bucket, length)
    out: dict[str, list] = {x.split()[0]: [] for x in _FOUND.split(", ")}

    def add(r: dict, low, high, w1=None, w2=None, places=None):
        for k, v in zip(out, (r["t"], low, high, w1, w2, places), strict=True):
            out[k].append(v)

    prefix = second = None
    if any(r["parts"] > 1 for r in rows):
        prefix, second = textbytes.sums(text), _sums_2(text)
    ends = np.cumsum(strings)
    for i, r in enumerate(rows):
        own = slice(ends[i] - strings[i], ends[i])
        if not r["whole"]:
            for low, high in _spans(again[own]).tolist():
                add(r, r["start"] + low, r["start"] + high)
        if r["parts"] > 1:
            mine = np.flatnonzero(first[own])
            at = base[i] + mine
            ask = np.where(again[own][mine] | r["whole"], -1, r["start"] + mine)
            add(
                r, None, None, textbytes.span(prefix, at, at + length).astype(np.int64),
                _span_2(second, at, at + length).astype(np.int64), ask,
            )
    long, longs = pa.int64(), pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(v, longs if k in ("w1", "w2", "place") else long) for k, v in out.items()], list(out)
    )


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``t``, ``low``, ``high``: starts of strings of ``length`` bytes that start elsewhere too, as ranges, from ``t`` (a
    number of the text), ``text``, a row for each document."""
    if not 0 < gram < length:
        raise ValueError("gram must be shorter than length")
    long_enough = texts.where(F.octet_length("text") >= length)
    found = write_through(long_enough.mapInArrow(lambda b: _cut_runs(b, length, gram), _RUNS), "runs")
    inside = found.where("spans is not null").select(
        "t", F.explode(F.expr("transform(sequence(0, size(spans) - 1, 2), i -> struct(spans[i], spans[i + 1]))")).alias("s")
    )
    inside = inside.select("t", F.col("s.col1").alias("low"), F.col("s.col2").alias("high"))
    # Most runs have a bucket of their own. They are told from the others by counts of the buckets alone.
    shared = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    found = found.select("t", "bucket", "x", "start", "strings", "again").join(shared, "bucket", "left_semi")
    found = write_through(found, "shared-runs")
    classes = found.groupBy("bucket", "x").agg(
        F.count(F.lit(1)).alias("n"), F.max("again").alias("again"), F.min(F.struct("t", "start", "strings")).alias("run")
    )
    classes = write_through(classes, "run-classes")
    # Runs that are equal: all their strings repeat.
    often = classes.where("n > 1").select("bucket", "x")
    whole = found.join(often, ["bucket", "x"], "left_semi").select(
        "t", F.col("start").alias("low"), (F.col("start") + F.col("strings")).alias("high")
    )
    # Runs that differ but share a bucket: one of each kind is sorted.
    mixed_buckets = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    parts_ = F.ceil(F.col("kinds") / RUNS_AT_ONCE).cast("int")
    wanted = classes.join(mixed_buckets, "bucket").select(
        "bucket", parts_.alias("parts"), F.pmod(F.col("x"), parts_).cast("int").alias("part"),
        ((F.col("n") > 1) | F.col("again")).alias("whole"), "run.*",
    )
    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("bucket", "parts", "part", "whole", "start", "strings")).alias("runs"))
    one_text = texts.join(lists.select("t"), "t", "left_semi").groupBy("t").agg(F.first("text").alias("text"))
    cut = F.expr(
        f"transform(runs, r -> struct(r.bucket, r.parts, r.part, r.whole, r.start,"
        f" substring(cast(text as binary), cast(r.start + 1 as int), r.strings + {length - 1}) as text))"
    )
    rows = one_text.join(lists, "t").select("t", F.explode(cut).alias("r")).select("t", "r.*")
    dealt = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    seen = write_through(dealt.mapInArrow(lambda b: _sort_buckets(b, length), _FOUND), "sorted-buckets")
    partly = seen.where("low is not null").select("t", "low", "high")
    # Parts of one bucket: strings found in several of them.
    digests = seen.where("place is not null").select("t", F.inline(F.arrays_zip("w1", "w2", "place")))
    several = digests.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    across = digests.where("place >= 0").join(several, ["w1", "w2"], "left_semi").select(
        "t", F.col("place").alias("low"), (F.col("place") + 1).alias("high")
    )
    return whole.union(inside).union(partly).union(across).distinct()


def _removed(spans: list[dict] | None) -> np.ndarray:
    """Maximal runs of covered bytes, as starts and ends, from ranges of bytes."""
    if not spans:
        return np.zeros((0, 2), np.int64)
    at = np.array(sorted((s["low"], s["high"]) for s in spans))
    reach = np.maximum.accumulate(at[:, 1])
    head = np.concatenate(([True], at[1:, 0] > reach[:-1]))
    return np.stack((at[head, 0], reach[np.append(np.flatnonzero(head)[1:] - 1, len(at) - 1)]), 1)


def remove_repeats(
    df: DataFrame, text: str = "text", kept: str = "kept", length: int = LENGTH, gram: int = GRAM, over_words: int | None = None,
    report_words: int | None = None,
) -> DataFrame:
    """``df`` without its text, with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``.

    ``kept`` says what comes of the text: ``"kept"``, the remaining bytes; ``"text"``, a string in a column of
    that name, without characters that were cut in half; ``""``, nothing. New columns replace columns so named.
    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in any text or the same
    one; with ``over_words`` also if it is in a passage of more words than that which is found again, however few
    bytes it has (see ``passages``). Both are judged on the input. With ``report_words`` such passages are not removed for
    that but reported: ``n_passage_bytes``, bytes in passages of more words than that which are found again, and ``n_passages``,
    maximal runs of them. ``gram`` must be shorter than ``length``. A null text
    counts as empty and stays null as a string; equal rows repeat each other. An empty table gives an empty one.
    """
    new = ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]
    new += {"kept": ["kept binary"], "text": [f"{quoted(text)} string"], "": []}[kept]
    told = ["n_passage_bytes long", "n_passages long"] if report_words is not None else []
    new += told
    added = T.StructType.fromDDL(", ".join(new))
    own = {f.name.lower() for f in added} | {text.lower()}
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    t = digest_of(df, F.col(quoted(text)))(F.col(quoted(text)))
    texts = df.select(t.alias("t"), body.alias("text"))
    starts = repeated_spans(texts, length, gram)
    spans = starts.select("t", "low", (F.col("high") + (length - 1)).alias("high"))
    if over_words is not None:
        spans = spans.union(repeated_passages(texts, over_words + 1)).distinct()
    lists = spans.groupBy("t").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    if told:
        found = repeated_passages(texts, report_words + 1).groupBy("t").agg(F.collect_list(F.struct("low", "high")).alias("passages"))
        lists = lists.join(found, "t", "full")
    carried = [c for c in df.columns if c.lower() not in own]
    k = len(carried)
    cols = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(carried)]
    rows = df.select(*cols, t.alias("t"), F.col(quoted(text)).alias("text"))
    rows = rows.join(lists, "t", "left").select(*[f"c{i}" for i in range(k)], "text", "spans", *(["passages"] if told else []))
    fields = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(carried)]
    fields += [T.StructField(f"c{k + i}", f.dataType) for i, f in enumerate(added)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for body, spans in zip(batch.column(k), batch.column(k + 1).to_pylist(), strict=True):
                raw = body.as_buffer() if body.is_valid else b""
                left, at, parts_ = memoryview(raw), 0, []
                gone = _removed(spans)
                for low, high in gone.tolist():
                    parts_.append(left[at:low])
                    at = high
                parts_.append(left[at:])
                digest = hashlib.sha256()
                for part in parts_:
                    digest.update(part)
                rest = b"".join(parts_) if kept else b""
                if kept == "text":
                    rest = rest.decode("utf-8", "ignore") if body.is_valid else None
                values = (len(left), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), digest.hexdigest(), rest)
                for to, v in zip(out, values, strict=True):
                    to.append(v)
            kinds = [*[pa.int64()] * 3, pa.string(), pa.string() if kept == "text" else pa.binary()]
            made = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)][: len(new) - len(told)]
            if told:
                seen = [_removed(spans) for spans in batch.column(k + 2).to_pylist()]
                made += [pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in seen], pa.int64()), pa.array(map(len, seen), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *made], [f.name for f in fields])

    done = rows.mapInArrow(apply, T.StructType(fields))
    names = [*carried, *[f.name for f in added]]
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def remove_from_documents(
    docs: DataFrame, text: str = "text", n_chars: str = "n_chars", length: int = LENGTH, gram: int = GRAM,
    over_words: int | None = None,
) -> DataFrame:
    """``docs`` without repeated passages, columns as before; ``n_chars`` is counted anew where there is such a column."""
    done = remove_repeats(docs, text, "text", length, gram, over_words)
    size = F.length(F.col(quoted(text))).cast("long")
    return done.select(*[size.alias(c) if c == n_chars else F.col(quoted(c)) for c in docs.columns])

"""Phrases whose words belong together, counted in a prefix-free parse of the corpus.

Words parse into chunks that begin where the content says so, at a trigger of three words, and end with the next
chunk's trigger. So equal passages have equal chunks wherever they stand, and the parse is a dictionary of different
chunks with how often each was met. N-grams are counted inside the chunks of the dictionary, times their frequency;
those that begin in the trigger at the end of a chunk are left to the next chunk, which begins with it, so each is counted once.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import join_by_weight, packed, write_through
from runledger.llm.textbytes import mixed, span, sums, words

MIN_COUNT = 30
MOST_WORDS = 4
TOP_PHRASES = 2000
# A trigger is as long as what a phrase can reach beyond its first word, and one window in PERIOD is one.
TRIGGER, PERIOD = MOST_WORDS - 1, 32
# Bits that say which phrases of a length may be frequent: 2 MB, whatever the corpus. A power of two.
CELLS, CELLS_PER_ROW = 1 << 24, 1 << 15
BUFFER_BYTES, FLUSH_ENTRIES, FLUSH_NUMBERS = 1 << 22, 300_000, 1 << 20
_U = np.uint64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], _U)
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[10, 32]] = True
_CLEAN = bytearray(range(256))
_CLEAN[65:91] = range(97, 123)
_CLEAN[9] = 32
for _mark in b".,;:!?\n\x0b\x0c\r":
    _CLEAN[_mark] = 10
_CLEAN = bytes(_CLEAN)
_CHUNKS = pa.schema([("lang", pa.string()), ("chunk", pa.binary()), ("n", pa.int64())])
_GRAMS = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
_CHUNK_DDL, _GRAM_DDL = "lang string, chunk binary, n long", "lang string, words int, phrase string, n long"


def _buffers(bodies: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of bodies of BUFFER_BYTES, or one longer: first, and one past the last."""
    low, size = 0, 0
    for i, body in enumerate(bodies):
        if size and size + len(body) > BUFFER_BYTES:
            yield low, i
            low, size = i, 0
        size += len(body) + 1
    if size:
        yield low, len(bodies)


def _words(buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word its line, start, end and a hash; one space is between words, a line feed between lines."""
    data = np.frombuffer(buffer, np.uint8)
    _, starts, ends = words(data, np.array([0, len(data)]), _BETWEEN)
    lines = np.searchsorted(np.flatnonzero(data == 10), starts)
    return lines, starts, ends, span(sums(data), starts, ends)


def _runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on, for all that have so many after them."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, _U)
    for t in range(k):
        out += hashes[t : t + n] * _FACTORS[t]
    return mixed(out)


def parse(texts: list[bytes]) -> Counter:
    """Chunks of the texts and how often each occurs; one that ends its line has a line feed at its end."""
    found: Counter = Counter()
    for low, high in _buffers(texts):
        buffer = b"\n".join(texts[low:high]).translate(_CLEAN)
        if b"  " in buffer:
            buffer = re.sub(b"  +", b" ", buffer)
        lines, starts, ends, hashes = _words(buffer)
        n = len(starts)
        if not n:
            continue
        begins = np.ones(n, bool)
        begins[1:] = lines[1:] != lines[:-1]
        triggers = (_runs(hashes, TRIGGER) % _U(PERIOD) == 0) & (lines[: max(0, n - TRIGGER + 1)] == lines[TRIGGER - 1 :])
        begins[: len(triggers)] |= triggers
        first = np.flatnonzero(begins)
        after = np.append(first[1:], n)
        inner = np.append(lines[first[1:]] == lines[first[:-1]], False)
        last = np.where(inner, after + TRIGGER, after) - 1
        cut = list(zip(starts[first].tolist(), ends[last].tolist(), inner.tolist()))
        found.update(buffer[a:b] if more else buffer[a:b] + b"\n" for a, b, more in cut)
    return found


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, chunks in counts.items():
            entries = iter(chunks.items())
            while some := list(islice(entries, 50_000)):
                keys, values = zip(*some)
                columns = [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.binary()), pa.array(values, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=_CHUNKS)
        counts.clear()

    for batch in batches:
        by_lang: dict[str, list[bytes]] = defaultdict(list)
        for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist()):
            by_lang[lang].append(body)
        for lang, texts in by_lang.items():
            counts[lang].update(parse(texts))
            if sum(map(len, counts.values())) > FLUSH_ENTRIES:
                yield from flush()
    yield from flush()


def _seed(lang: str) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _numbers(lang: str, hashes: np.ndarray, k: int) -> np.ndarray:
    """A number of the ``k`` words from each word on; two phrases may share one."""
    return mixed(_runs(hashes, k) ^ _seed(lang)).view(np.int64)


def _flagged(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    cell = numbers & (CELLS - 1)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


class _Chunks:
    """The words of some chunks: where they start and end in ``buffer``, which are the chunk's own, and their chunk's frequency."""

    def __init__(self, chunks: list[bytes], times: np.ndarray):
        goes_on = np.array([not c.endswith(b"\n") for c in chunks])
        self.buffer = b"\n".join(c.rstrip(b"\n") for c in chunks)
        lines, self.starts, self.ends, self.hashes = _words(self.buffer)
        stop = np.searchsorted(lines, np.arange(len(chunks)), "right")  # one past a chunk's last word
        self.left = stop[lines] - np.arange(len(lines))  # words from here to the chunk's end
        self.own = self.left > TRIGGER * goes_on[lines]
        self.weight = times[lines]


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Chunks]]:
    for batch in batches:
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        times, chunks = batch.column("n").to_numpy(), batch.column("chunk").to_pylist()
        for lang in sorted(set(langs)):
            rows = np.flatnonzero(langs == lang)
            mine = [chunks[i] for i in rows]
            for low, high in _buffers(mine):
                yield lang, _Chunks(mine[low:high], times[rows[low:high]])


def _count_numbers(orders: tuple[int, ...], bits):
    """What counts the phrases of ``orders`` words by number; with ``bits``, broadcast, those whose pairs all are flagged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {k: [] for k in orders}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for k, some in held.items():
                if some:
                    numbers, weights = (np.concatenate(x) for x in zip(*some))
                    order = np.argsort(numbers)
                    numbers, weights = numbers[order], weights[order]
                    first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
                    columns = [pa.array(np.full(len(first), k, np.int32)), pa.array(numbers[first]), pa.array(np.add.reduceat(weights, first))]
                    yield pa.RecordBatch.from_arrays(columns, names=["words", "number", "n"])
                    some.clear()

        for lang, part in _chunks_of(batches):
            n = len(part.own)
            if bits is not None:
                good = _flagged(bits.value[2], _numbers(lang, part.hashes, 2))
            for k in orders:
                here = part.own & (part.left >= k)
                for t in range(k - 1 if bits is not None else 0):
                    here[: max(0, n - 1 - t)] &= good[t:]
                at = np.flatnonzero(here)
                if len(at):
                    held[k].append((_numbers(lang, part.hashes, k)[at], part.weight[at]))
                    size += len(at)
            if size > FLUSH_NUMBERS:
                yield from flush()
                size = 0
        yield from flush()

    return count


def _frequent_bits(chunks: DataFrame, orders: tuple[int, ...], bits, min_count: int) -> dict[int, np.ndarray]:
    """Which cells have a phrase that may be frequent, as CELLS bits a length that Spark puts together: CELLS / 8 bytes each come to the driver."""
    counted = chunks.mapInArrow(_count_numbers(orders, bits), "words int, number long, n long")
    frequent = counted.groupBy("words", "number").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    cell = F.col("number").bitwiseAND(F.lit(CELLS - 1))
    row = F.call_function("div", cell, F.lit(CELLS_PER_ROW))
    rows = frequent.groupBy("words", row.alias("row")).agg(F.bitmap_construct_agg(cell % CELLS_PER_ROW).alias("bits"))
    out = {k: np.zeros(CELLS // 8, np.uint8) for k in orders}
    for r in rows.collect():
        at = r["row"] * CELLS_PER_ROW // 8
        out[r["words"]][at : at + CELLS_PER_ROW // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _count_phrases(bits):
    """What counts the phrases that are flagged by their numbers in ``bits``, broadcast, all words, and, as ``words`` = 0, their sum."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, k), held in counts.items():
                entries = iter(held.items())
                while some := list(islice(entries, 50_000)):
                    keys, values = zip(*some)
                    n = len(keys)
                    columns = [pa.array([lang] * n, pa.string()), pa.array([k] * n, pa.int32()), pa.array(keys, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], schema=_GRAMS)
            counts.clear()

        for lang, part in _chunks_of(batches):
            starts, ends, buffer, once = part.starts.tolist(), part.ends.tolist(), part.buffer, part.weight == 1
            counts[lang, 0][b""] += int(part.weight[part.own].sum())
            for k in range(1, MOST_WORDS + 1):
                here = part.own & (part.left >= k)
                if k > 1:
                    flags = _flagged(bits.value[k], _numbers(lang, part.hashes, k))
                    here[: len(flags)] &= flags
                held = counts[lang, k]
                held.update([buffer[starts[i] : ends[i + k - 1]] for i in np.flatnonzero(here & once).tolist()])
                several = np.flatnonzero(here & ~once)
                for i, w in zip(several.tolist(), part.weight[several].tolist()):
                    held[buffer[starts[i] : ends[i + k - 1]]] += w
            if sum(map(len, counts.values())) > FLUSH_ENTRIES:
                yield from flush()
        yield from flush()

    return count


def dictionary(docs: DataFrame) -> DataFrame:
    """The parse of all texts: ``lang, chunk, n``, each different chunk of a language once. Null texts are empty, null langs ``und``."""
    rows = packed(docs.select("lang", "text")).select(
        F.coalesce(F.col("row.lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("row.text"), F.lit("")).cast("binary").alias("body")
    )
    return rows.mapInArrow(_parse_batches, _CHUNK_DDL).groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def frequent_phrases(chunks: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, words, phrase, n`` of all phrases of 1 to MOST_WORDS words that occur ``min_count`` times, and all words as ``words`` = 0.

    Phrases are counted by numbers first, pairs of words and then longer ones whose pairs all may be frequent, and as text
    only where their number is frequent; numbers decide nothing else. ``chunks`` is read three times.
    """
    context = chunks.sparkSession.sparkContext
    bits = _frequent_bits(chunks, (2,), None, min_count)
    bits |= _frequent_bits(chunks, tuple(range(3, MOST_WORDS + 1)), context.broadcast(bits), min_count)
    grams = chunks.mapInArrow(_count_phrases(context.broadcast(bits)), _GRAM_DDL)
    counted = grams.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= min_count) | (F.col("words") == 0))


def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP_PHRASES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to 4 words by score, a, and bytes of the phrase.

    From the columns ``lang, text`` of ``docs``: A-Z in lower case, pieces between ``. , ; : ! ?`` and line ends, words
    between spaces and tabs. Null texts are empty and null languages ``und``; an empty table, or one without a phrase
    that occurs ``min_count`` times, gives an empty result. ``a`` is the phrase's number of occurrences, overlaps included,
    ``n`` that of all words of the language. Cut in two, with l and r occurrences of the parts, a phrase scores
    floor(2000000 a / (l + r)); the cut that scores lowest counts, of equal ones the first. A phrase inside a longer one
    that has 80 % of its occurrences is left out. Repeated rows count as often as they are there. All is exact.
    """
    found = write_through(frequent_phrases(write_through(dictionary(docs), "chunks"), min_count), "frequent")
    candidates = found.where("words >= 2")
    listed = F.split("phrase", " ")

    def joined(start, length) -> Column:
        return F.array_join(F.slice(listed, start, length), " ")

    # Both parts of every cut, with their counts. A part is as frequent as what it is part of, so it is there.
    cuts = candidates.select("lang", "phrase", "words", "n", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = F.array(
        F.struct(joined(1, F.col("k")).alias("part"), F.lit(True).alias("first")),
        F.struct(joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("part"), F.lit(False).alias("first")),
    )
    parts = cuts.select("lang", "phrase", F.col("n").alias("a"), "k", F.explode(sides).alias("s"))
    parts = write_through(parts.select(F.struct("lang", "s.part").alias("key"), "phrase", "a", "k", "s.first"), "parts")
    known = found.where("words >= 1").select(F.struct("lang", F.col("phrase").alias("part")).alias("key"), F.col("n").alias("f"))
    counted = join_by_weight(parts, known, "key", "f").groupBy("key.lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r")
    )
    wide = F.lit(2_000_000).cast("decimal(38,0)") * F.col("a")
    score = F.call_function("div", wide, F.col("l").cast("decimal(20,0)") + F.col("r")).cast("bigint")
    lowest = counted.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # Every phrase of two words or more inside a longer one, with the largest of their counts.
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), i -> array_join(slice(split(phrase, ' '), i, k), ' '))))"
    )
    longer = found.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * 80)
    )
    totals = found.where("words = 0").select("lang", F.col("n"))  # a row per language
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(ranked))
    best = best.where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

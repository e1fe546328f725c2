"""Document fingerprints by SpotSigs: chains of content words that follow common words.

A fingerprint is a set of signatures, written as base64 of its sorted 32-bit numbers, so
two fingerprints can be compared (Jaccard) without their texts.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.buckets import classes
from runledger.llm.common import digest_of, quoted, write_through
from runledger.llm.textbytes import FOLDED_CODES, mixed, parts, powers, span, sums, words
from runledger.session import recorded_scratch, release_scratch, setting

# Common words of English, French, German and Spanish.
COMMON = """
a an and are as at be by for from had has have he in is it its not of on or she that the their there they this to was were
which will with you
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne ou par pas pour que qui se son sur un une
aber als am an auch auf aus bei das dass dem den der des die du ein eine einem einen einer er es für hat ich im in ist mit
nicht noch oder sich sie sind so um und von vor war wie wir zu zum zur
al como con de del el ella ellos en es está esta este la las lo los más no para pero por que se sin su sus un una uno y
""".split()  # fmt: skip
CHAIN = 2
CHUNK_BYTES = 2 << 20
ROWS_PER_BLOCK, MOST_BLOCKS = 2048, 100_000
ROWS_AT_ONCE = 512
SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_U = np.uint64
_between = np.ones(256, bool)
_between[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _hash_words(of: list[str]) -> np.ndarray:
    raw = [w.encode() for w in of]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    return np.unique(span(sums(data, FOLDED_CODES), ends - np.array([len(r) for r in raw]), ends))


_common = _hash_words(COMMON)


def _chains(doc, hashes, anchor, content) -> tuple[np.ndarray, np.ndarray]:
    """Texts and signatures of the anchors that have a whole chain behind them."""
    first = np.searchsorted(content, anchor, "right")
    whole = first + CHAIN <= len(content)
    anchor, first = anchor[whole], first[whole]
    whole = doc[content[first + CHAIN - 1]] == doc[anchor] if len(first) else np.zeros(0, bool)
    anchor, first = anchor[whole], first[whole]
    out = hashes[anchor].copy()
    for k in range(CHAIN):
        out += hashes[content[first + k]] * powers(0xD1B54A32D192ED03, CHAIN + 1)[k + 1]
    return doc[anchor], mixed(out)


def signature_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted signatures of every text.

    Words are runs of ASCII letters, digits and other than ASCII characters, A-Z in lower
    case. Where no common word has a chain behind it every word is an anchor and content; a text
    too short for that has one signature, of the whole text; an empty one has none.
    """
    out: list[np.ndarray] = []
    for _, data, offsets in parts(texts, CHUNK_BYTES):
        n = len(offsets) - 1
        doc, starts, ends = words(data, offsets, _between)
        prefix = sums(data, FOLDED_CODES)
        hashes = span(prefix, starts, ends)
        place = np.searchsorted(_common, hashes)
        common = _common[np.minimum(place, len(_common) - 1)] == hashes
        own, signs = _chains(doc, hashes, np.flatnonzero(common), np.flatnonzero(~common))
        for attempt in ("words", "text"):
            missing = np.bincount(own, minlength=n) == 0
            if attempt == "words":
                some = np.flatnonzero(missing[doc]) if len(doc) else doc
                more = _chains(doc[some], hashes[some], np.arange(len(some)), np.arange(len(some)))
            else:
                left = np.flatnonzero(missing & (np.diff(offsets) > 0))
                more = left, span(sums(data), offsets[left], offsets[left + 1])
            own, signs = np.concatenate((own, more[0])), np.concatenate((signs, more[1]))
        pair = np.unique(own.astype(_U) << _U(32) | signs >> _U(32))
        at = np.searchsorted(pair, np.arange(n + 1, dtype=_U) << _U(32))
        numbers = pair.astype("<u4")
        out.extend(numbers[at[i] : at[i + 1]] for i in range(n))
    return out


def written(signs: np.ndarray) -> str:
    return base64.b64encode(signs.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; two empty ones are alike. Sets whose sizes alone keep them below ``least`` give 0."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[place] == a).sum())
    return both / (len(a) + len(b) - both)


def edited(own: str, following: str) -> str:
    """``own`` with its last half replaced by as many characters, or all, of the start of ``following``."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def fingerprint(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``df`` narrowed to id and ``fingerprint``, a row for each row; a null text counts as empty."""
    kind = df.schema[doc_id].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = signature_sets(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(written, sets), pa.string())], ["doc_id", "fingerprint"]
            )

    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    return df.select(F.col(quoted(doc_id)).alias("doc_id"), body.alias("text")).mapInArrow(
        make, f"doc_id {kind}, fingerprint string"
    )


def near_classes(df: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = 0.8) -> DataFrame:
    """One row per document: its id as ``doc_id`` and ``class_id``, the least id of its class (a null comes first).

    Documents are in a class if a chain of pairs whose signature sets have a Jaccard of ``least`` or
    more links them, or if their texts are equal. Sets are partitioned by length, into levels such that linked
    ones are at most one level apart. Two linked sets of n signatures or more share one of the
    n - ceil(least * n) + 1 rarest signatures of each, so only these put texts of two levels into buckets, and
    only texts that share a bucket are compared. Null texts count as empty; an empty table gives an empty one.
    """
    of_text, node_of = _classes(df, text, doc_id, least)
    placed = df.select(F.col(quoted(doc_id)).alias("doc_id"), node_of(F.col(quoted(text))).alias("node"))
    return placed.join(of_text, "node").select("doc_id", "class_id")


def _few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ROWS_AT_ONCE rows, as what is made of a batch takes several times its texts' memory."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(low, ROWS_AT_ONCE)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _few_rows(batches):
        sets = signature_sets(batch.column(1))
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        numbers = np.concatenate([np.zeros(0, "<u4"), *sets]).view(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["node", "signs"])


def _sets(signs: pa.Array) -> Iterator[np.ndarray]:
    ends, numbers = signs.offsets.to_numpy(), signs.values.to_numpy()
    for low, high in zip(ends[:-1], ends[1:], strict=True):
        yield numbers[low:high]


def _classes(df: DataFrame, text: str, doc_id: str, least: float) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``node``, ``class_id`` of every text, written, and what gives a text's node.

    Signatures are told from those of one text alone by their number of texts, which comes from a shuffle of the numbers
    only; a text gets back only those that others have, too. What a step shuffled is removed when its result is
    written, and what it wrote when the classes are.
    """
    spark, left = df.sparkSession, []
    with recorded_scratch(left), setting(spark, SHUFFLES_REMOVED, "true"):
        node_of = digest_of(df, F.col(quoted(text)))
        body = F.coalesce(F.col(quoted(text)), F.lit(""))
        texts = df.select(node_of(F.col(quoted(text))).alias("node"), body.alias("text"))
        signed = texts.mapInArrow(_sign, "node long, signs array<int>").groupBy("node").agg(F.first("signs").alias("signs"))
        signed = write_through(signed, "signatures")
        rows = write_through(_rarest(signed, least), "rarest")
        sets = signed.select("node", F.col("signs").alias("text"))
        labels = signed.select("node").join(classes(rows, sets, _sets, least), "node", "left")
        labels = write_through(labels.select("node", F.coalesce("label", "node").alias("label")), "labels")
        placed = df.select(F.col(quoted(doc_id)).alias("id"), node_of(F.col(quoted(text))).alias("node")).join(labels, "node")
        firsts = placed.groupBy("label").agg(F.min(F.struct("id")).alias("first")).select("label", F.col("first.id").alias("class_id"))
        of_text = write_through(labels.join(firsts, "label").select("node", "class_id"), "classes")
    release_scratch(spark, left, of_text)
    return of_text, node_of


def _rarest(signed: DataFrame, least: float) -> DataFrame:
    """``node``, ``size``, ``key`` of the buckets that a text's rarest signatures put it into, but for those no other text has.

    The n - ceil(least * n) + 1 rarest are all but the ceil(least * n) - 1 that most texts have, so a text is
    ranked by what it shares alone, from the most frequent on; one that shares no more than these is in no bucket.
    """
    single = signed.select("node", F.explode("signs").alias("sign"))
    often = single.groupBy("sign").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = write_through(often, "shared-signatures")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("n"), F.desc("sign")))
    ranked = single.join(often, "sign").select("node", "sign", rank.alias("rank"))
    size = F.col("size")
    level = F.floor(F.log(size) / (1e-6 - math.log(least)))
    sizes = signed.select("node", F.size("signs").cast("long").alias("size")).withColumn("level", level)
    rare = ranked.join(sizes, "node").where(F.col("rank") >= F.ceil(F.lit(least - 1e-9) * size))
    pair = F.explode(F.array(F.col("level") - 1, F.col("level"))).alias("pair")
    return rare.select("node", "size", "sign", pair).select("node", "size", F.xxhash64("sign", "pair").alias("key"))


def compare_in_classes(df: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = 0.8) -> DataFrame:
    """The rows of ``compare_with_edits`` with ``class_id``, as ``near_classes`` gives it for all documents.

    A class is looked up by the row's text, so rows of one id neither multiply nor get each other's class.
    """
    of_text, node_of = _classes(df, text, doc_id, least)
    return _compared(df, text, doc_id, node_of, of_text)


_OUT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edits(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's text, in descending order of integer ids, and likenesses.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. After the last document comes the first; a null id comes last; equal ids are
    ordered by a digest of their texts. Documents are dealt in blocks of neighbouring ids, some
    2048 rows each, and a block also gets the first document of the next one; a block is read as
    a stream. All rows of one id are in one block. Null texts count as empty; an empty table gives an empty one.
    """
    return _compared(df, text, doc_id).drop("class_id")


def _compared(
    df: DataFrame, text: str, doc_id: str, node_of: Callable[[Column], Column] | None = None, of_text: DataFrame | None = None
) -> DataFrame:
    """The rows of ``compare_with_edits`` with ``class_id``, which ``of_text`` has for the node of each text (without it: null).

    Classes are dealt like the texts, as a narrow row of each id and text that goes before them, so no result row is shuffled.
    """
    kind = df.schema[doc_id].dataType.simpleString()
    own = F.col(quoted(text))
    body = F.coalesce(own, F.lit(""))
    node = (node_of(own) if node_of else F.lit(None).cast("long")).alias("node")
    named = df.select(F.col(quoted(doc_id)).alias("id"), F.xxhash64(body).alias("digest"), node, body.alias("text"))
    rows = named.withColumn("class_id", F.lit(None).cast(kind))
    n = df.count()
    blocks = min(MOST_BLOCKS, max(1, -(-n // ROWS_PER_BLOCK)))
    shares = [k / blocks for k in range(1, blocks)]
    bounds = rows.agg(F.percentile_approx("id", shares, 10 * blocks)).first()[0] if shares else None
    marks = sorted(set(bounds or []))
    # The higher the id the lower the block; rows without an id have one of their own, at the end.
    block = F.lit(len(marks)) - _position(F.col("id"), marks)
    block = F.when(F.col("id").isNull(), F.lit(len(marks) + 1)).otherwise(block).cast("int").alias("block")
    heads = rows.select("id", "digest", block).groupBy("block").agg(F.max(F.struct("id", "digest")).alias("head"))
    heads = sorted((r["block"], r["head"]["id"], r["head"]["digest"]) for r in heads.collect()) if n else []
    spark = df.sparkSession
    guests = [(b, i, d, heads[k - 1][0]) for k, (b, i, d) in enumerate(heads)]
    table = spark.createDataFrame(guests, f"block int, head {kind}, head_digest long, before int")
    if of_text is not None:
        first = named.select("id", "digest", "node").distinct().join(of_text, "node")
        rows = rows.unionByName(first.withColumn("text", F.lit(None).cast("string")))
    met = rows.select("*", block).join(F.broadcast(table), "block")  # at most MOST_BLOCKS + 1 rows
    is_head = F.col("text").isNotNull() & F.col("id").eqNullSafe(F.col("head")) & (F.col("digest") == F.col("head_digest"))
    own = F.struct(F.col("block").alias("to"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("before").alias("to"), F.lit(1).alias("guest"))
    targets = F.explode(F.when(is_head, F.array(own, guest)).otherwise(F.array(own))).alias("x")
    dealt = met.select("id", "digest", "node", "text", "class_id", targets)
    dealt = dealt.select("x.to", "x.guest", "id", "digest", "node", "text", "class_id").repartition(max(1, len(heads)), "to")
    order = ["to", "guest", F.col("id").desc(), F.col("digest").desc(), "node", F.col("text").isNotNull()]
    dealt = dealt.sortWithinPartitions(*order).select("to", "guest", "id", "text", "class_id")
    return dealt.mapInArrow(_compare, f"doc_id {kind}, {_OUT}, class_id {kind}")


def _position(value, marks: list):
    """How many of the sorted ``marks`` are below ``value``: by halving, so no row looks at all of them."""
    if not marks:
        return F.lit(0)
    table, steps = F.lit(marks), len(marks).bit_length()
    state = F.struct(F.lit(0).alias("low"), F.lit(len(marks)).alias("high"))

    def halve(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.get(table, middle) < value
        narrowed = F.struct(
            F.when(below, middle + 1).otherwise(s["low"]).alias("low"), F.when(below, s["high"]).otherwise(middle).alias("high")
        )
        return F.when(s["low"] < s["high"], narrowed).otherwise(s)

    return F.aggregate(F.sequence(F.lit(0), F.lit(steps)), state, halve, lambda s: s["low"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of block, guests last, and descending id. A row is done when the next one is there.

    A row without a text names the class of the rows behind it.
    """
    held, class_id = None, None
    for batch in _few_rows(batches):
        kind = batch.column(2).type
        rows = [held] if held else []
        for to, guest, own_id, text, own_class in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text is None:
                class_id = own_class
            else:
                rows.append((to, guest, own_id, text, class_id))
        if not rows:
            continue
        sets = signature_sets(pa.array([r[3] for r in rows], pa.large_string()))
        done = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
        edits = [edited(rows[i][3], rows[i + 1][3]) for i in done]
        changed = signature_sets(pa.array(edits, pa.large_string()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][2] for i in done], kind),
                pa.array([len(rows[i][3]) for i in done], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
                pa.array([written(sets[i]) for i in done], pa.string()),
                pa.array([written(s) for s in changed], pa.string()),
                pa.array([likeness(sets[i], s) for i, s in zip(done, changed, strict=True)], pa.float64()),
                pa.array([likeness(sets[i], sets[i + 1]) for i in done], pa.float64()),
                pa.array([rows[i][4] for i in done], kind),
            ],
            ["doc_id", *[x.split()[0] for x in _OUT.split(", ")], "class_id"],
        )
        held = rows[-1]

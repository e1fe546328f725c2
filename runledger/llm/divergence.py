"""How far the sources of a language are from each other, and by which words.

Identical texts of a language are collapsed first: a text is shuffled once, tokenized once, and adds its
counts to every source as often as that source has it. From there on all is sparse: a group is its words with
a count, every other word of the language has one and the same probability in it, so a pair costs its shared words
and one term per different count, not the vocabulary.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import floordiv, mod

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import join_by_weight, packed, write_through

MIN_DOCUMENTS = 10
TOP_TERMS = 10
FLUSH_TERMS = 400_000
SALTS = 32
# Letters A-Z as a-z, all other ASCII as a space; bytes of longer characters stay.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_NAMES = ["lang", "source", "term", "n", "docs"]
_DOC = 1 << 48  # what a document adds to a count, above the occurrences, of which a task has fewer


def collapse(docs: DataFrame) -> DataFrame:
    """Different texts per language: ``lang, body, sources``, the last being ``(source, n)`` pairs.

    Identical texts are counted before any shuffle, and the texts travel without their multiplicities. Null is ''.
    """
    lang, source, text = (F.coalesce(F.col("row").getField(c), F.lit("")) for c in ("lang", "source", "text"))
    rows = packed(docs.select("lang", "source", "text")).select(lang.alias("lang"), source.alias("source"), text.alias("text"))
    key = F.unhex(F.md5(F.concat(F.octet_length("lang").cast("string"), F.lit(":"), "lang", "text").cast("binary")))
    keyed = rows.select("*", key.alias("key"))
    per_source = keyed.groupBy("key", "source").agg(F.count(F.lit(1)).alias("n"))
    sources = per_source.groupBy("key").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    bodies = keyed.groupBy("key").agg(F.any_value("lang").alias("lang"), F.any_value("text").alias("text"))
    return bodies.join(sources, "key").select("lang", F.col("text").cast("binary").alias("body"), "sources")


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per language, source and term: occurrences, and documents that have it."""
    counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, sources in counts.items():
            for source, terms in sources.items():
                same = [pa.array([value] * len(terms), pa.string()) for value in (lang, source)]
                n, docs = (pa.array([part(both, _DOC) for both in terms.values()], pa.int64()) for part in (mod, floordiv))
                yield pa.RecordBatch.from_arrays([*same, pa.array(list(terms), pa.binary()).cast(pa.string()), n, docs], names=_NAMES)
        counts.clear()

    for batch in batches:
        for lang, body, sources in zip(*(batch.column(c).to_pylist() for c in ("lang", "body", "sources"))):
            words = Counter(body.translate(_LETTERS).split())
            for pair in sources:
                times, terms = pair["n"], counts[lang][pair["source"]]
                held -= len(terms)
                for word, found in words.items():
                    terms[word] += times * (found + _DOC)
                held += len(terms)
            if held > FLUSH_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def _p(n: Column, total: Column, kept: Column) -> Column:
    return (F.lit(1) + _div(F.lit(1_000_000_000).cast("decimal(38,0)") * (n + 2), total + 2 * kept)).cast("bigint")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _f(p: Column, q: Column) -> Column:
    # p and q are at most a thousand million and one, so the square is below 2 ** 63.
    return _div((p - q) * (p - q), p + q)


def _total(value: Column) -> Column:
    return F.sum(value).cast("bigint")


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` from the columns ``lang, source, text`` of ``docs``; nulls count as ''.

    Terms are runs of letters and of other than ASCII characters, A-Z in lower case; a language keeps those found in
    ``min_documents`` of its rows. In a group of N occurrences of the V kept terms one found n times has
    p = 1 + floor(10^9 (n + 2) / (N + 2 V)); two probabilities are f = floor((p - q)^2 / (p + q)) apart.
    Part ``pair`` has, for each source, every other source of the language with f summed over the kept terms; part
    ``term`` the source's ``top_terms`` terms whose p is above the language's, by f. Ranks go by falling value, then
    by the item's bytes. A source without kept terms has pairs only, at a distance of 0 where V is 0; an empty
    table gives an empty result. All is exact. Every pair of sources is a row of the result, whence a language's
    sources are paired with each other; nothing else is.
    """
    # Counted by task, and dealt by term once: both sums below find their rows together.
    counted = collapse(docs).mapInArrow(_tokenize, _COUNTS).repartition("lang", "term")
    summed = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    per_term = summed.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    # One row per kept term of a language; its list has at most one entry per source.
    terms = write_through(per_term.where(F.col("docs") >= min_documents).select("lang", "term", "total", "sources"), "terms")

    lang, source = (F.coalesce(F.col(c), F.lit("")) for c in ("lang", "source"))
    named = docs.select(lang.alias("lang"), source.alias("source")).distinct()
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("all"))
    flat = terms.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", "term", "total", "s.source", "s.n")
    own = flat.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("own"))
    zero = F.lit(0).cast("bigint")
    groups = named.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "own", "kept", "all")]
    )
    rare = F.when(F.col("kept") > 0, _p(F.lit(0), F.col("size"), F.col("kept")))  # p of a term that is not there
    groups = write_through(groups.select("*", rare.alias("p0"), F.struct("lang", "source").alias("key")), "groups")

    found = flat.select(F.struct("lang", "source").alias("key"), "term", "total", "n")
    figures = groups.select("key", "size", "kept", "all", "p0", "own")
    held = join_by_weight(found, figures, "key", "own").select(
        "key.lang", "key.source", "term", "n", "p0",
        _p(F.col("n"), F.col("size"), F.col("kept")).alias("p"), _p(F.col("total"), F.col("all"), F.col("kept")).alias("q"),
    )
    held = write_through(held, "held")
    above = held.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    best = _ranked(above).where(F.col("rank") <= top_terms)
    return _ranked(_pairs(held, groups)).unionByName(best)


def _ranked(rows: DataFrame) -> DataFrame:
    """Rank within a source. Where few ranks are asked for, Spark cuts before the shuffle."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    """Every source with every other of its language, and their distance.

    Over all kept terms, f(p, q) = [f(p, q0) if only the one has it] + [f(p0, q) if only the other has it] + f(p0, q0)
    for those of neither: the sums against q0 need a source's different counts only, and what they get wrong for
    shared terms is made good term by term.
    """
    p, p0 = F.col("p"), F.col("p0")
    entries = held.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("s"))
    firsts = entries.select("lang", "s", F.posexplode("s").alias("at", "x"))
    both = firsts.select("lang", "x", F.explode(F.slice("s", F.col("at") + 2, F.size("s"))).alias("y"))
    x, y = (lambda c: F.col("x").getField(c)), (lambda c: F.col("y").getField(c))
    excess = _f(x("p"), y("p")) - _f(x("p"), y("p0")) - _f(x("p0"), y("p"))
    shared = both.groupBy("lang", x("source").alias("a"), y("source").alias("b")).agg(
        _total(excess).alias("excess"), F.count(F.lit(1)).alias("shared")
    )
    shared = shared.unionByName(shared.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "excess", "shared"))

    # A language's sources meet each other: salted, so that one large language is many keys.
    salt = F.pmod(F.xxhash64("source"), F.lit(SALTS)).cast("int").alias("salt")
    left = groups.select("lang", F.col("source").alias("a"), "kept", F.col("own").alias("own_a"), F.col("p0").alias("p0_a"), salt)
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    right = groups.select("lang", F.col("source").alias("b"), F.col("own").alias("own_b"), F.col("p0").alias("p0_b"), every)
    pairs = left.join(right, ["lang", "salt"]).where("a <> b").drop("salt")

    # Different counts of a source against every other source's p of an absent term.
    levels = held.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    levels = levels.groupBy("lang", F.col("source").alias("a")).agg(F.collect_list(F.struct("p", "terms")).alias("levels"))
    against = pairs.join(levels, ["lang", "a"]).select("lang", "a", "b", "p0_b", F.explode("levels").alias("l"))
    alone = against.groupBy("lang", "a", "b").agg(_total(F.col("l.terms") * _f(F.col("l.p"), F.col("p0_b"))).alias("alone"))
    other = alone.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), F.col("alone").alias("other"))

    keys = ["lang", "a", "b"]
    joined = pairs.join(shared, keys, "left").join(alone, keys, "left").join(other, keys, "left").na.fill(0, ["excess", "shared", "alone", "other"])
    neither = F.col("kept") - F.col("own_a") - F.col("own_b") + F.col("shared")
    rest = F.when(F.col("kept") > 0, neither * _f(F.col("p0_a"), F.col("p0_b"))).otherwise(0)
    value = (F.col("alone") + F.col("other") + F.col("excess") + rest).cast("bigint")
    return joined.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))

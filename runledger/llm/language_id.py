"""Language of pages by Bayesian fusion: likelihood of the text, declared markup language, address suffix and host.

The host's prior is smoothed by that of its domain, that by its address suffix's and that by
all pages'. Priors are counts of what the text and the markup say, summed by groups,
and a page's own vote is taken out of those that judge it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import packed, quoted, unpacked, write_through
from runledger.llm.textbytes import mixed, parts
from runledger.llm.url_filter import host_of

LANGUAGES = ("de", "en", "es", "fr")
FEATURES = 1 << 15
TEXT_TOKENS = 40.0  # a text counts as so many independent trigrams at most
MIN_TOKENS = 1
DECLARED_RIGHT = 0.9
PRIOR_PAGES = 4.0
CHUNK_BYTES = 1 << 20
_U = np.uint64
_fold = np.arange(256, dtype=_U)
_fold[65:91] += _U(32)
_fold[[*range(48, 58)]] = _U(48)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature of every byte trigram inside a text."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = _fold[data]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    tri = mixed(x[:-2] | x[1:-1] << _U(8) | x[2:] << _U(16)) % _U(FEATURES)
    inside = doc[:-2] == doc[2:]
    return doc[:-2][inside], tri[inside].astype(np.int64)


def train(texts: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Log-probabilities, languages x FEATURES, from all rows of ``lang``, ``text``.

    Counts are summed in tasks and by groups; at most len(languages) x FEATURES rows come to the
    driver. Null texts and other languages count for nothing; a language without text is uniform.
    """
    known = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(languages), FEATURES), np.int64)
        for batch in batches:
            langs = np.array([known[x] for x in batch.column(0).to_pylist()], np.int64)
            for low, data, offsets in parts(batch.column(1), CHUNK_BYTES):
                doc, feature = _features(data, offsets)
                at = langs[low + doc] * FEATURES + feature
                table += np.bincount(at, minlength=table.size).reshape(table.shape)
        lang, feature = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(feature), pa.array(table[lang, feature])], ["lang", "feature", "n"])

    rows = texts.where(F.col("lang").isin(*languages) & F.col("text").isNotNull()).select("lang", "text")
    counted = rows.mapInArrow(count, "lang long, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    table = np.full((len(languages), FEATURES), 0.5)
    for r in counted.toLocalIterator():
        table[r["lang"], r["feature"]] += r["n"]
    return np.log(table / table.sum(1, keepdims=True))


def text_log_likelihoods(text: Column, model: np.ndarray) -> Column:
    """Of each language, in a column of arrays: the mean over the text's trigrams, times their number up to TEXT_TOKENS.
    Zeros where there are none."""
    flat = model.astype(np.float32)

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        out = np.zeros((len(texts), len(flat)))
        for low, data, offsets in parts(texts, CHUNK_BYTES):
            n = len(offsets) - 1
            doc, feature = _features(data, offsets)
            many = np.bincount(doc, minlength=n)
            weight = np.minimum(many, TEXT_TOKENS) / np.maximum(many, 1)
            for i, row in enumerate(flat):
                out[low : low + n, i] = np.bincount(doc, row[feature], n) * weight
        ends = np.arange(len(texts) + 1, dtype=np.int32) * len(flat)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return score(F.coalesce(text, F.lit("")))


def visible_text(html: Column) -> Column:
    """Markup without scripts, styles, comments, navigation, tags and entities."""
    plain = F.regexp_replace(html, r"(?is)<(script|style|nav|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(plain, r"(?s)<[^>]*>", " "), r"&[#0-9A-Za-z]{1,10};|\s+", " ")


def declared_language(html: Column) -> Column:
    """The first part of the html tag's lang, in lower case; null without one."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)
    return F.when(found != "", F.lower(found))


def _normal(logs: Column) -> Column:
    """Probabilities from logarithms."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def identify(df: DataFrame, model: np.ndarray, url: str = "url", html: str = "html", languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """``df`` with ``lang``, ``probability``, ``declared`` and ``host``, replacing columns so named.

    Ties go to the language named first. A null URL, or one without ``://``, has an empty host, which is a
    host like others; a null page has neither text nor markup, and its host's prior decides. Equal rows get equal
    results; an empty table gives an empty one. Group tables have a row per host, domain or suffix
    and are joined by what size they turn out to have.
    """
    n, zeros = len(languages), [0.0] * len(languages)
    link, page = F.col("row").getField(url), F.col("row").getField(html)
    rows = packed(df).select("row", host_of(link).alias("host"), page.alias("page"))
    host = F.regexp_replace("host", r"^.*@|:[0-9]*$", "")
    rows = rows.select(
        "row", "host", declared_language(F.col("page")).alias("declared"),
        text_log_likelihoods(visible_text(F.col("page")), model).alias("logs"),
        F.substring_index(host, ".", -2).alias("domain"), F.substring_index(host, ".", -1).alias("suffix"),
    )
    names = F.array(*map(F.lit, languages))
    wrong = (1 - DECLARED_RIGHT) / max(1, n - 1)
    said = F.when(
        F.col("declared").isin(*languages),
        F.transform(names, lambda x: F.log(F.when(x == F.col("declared"), DECLARED_RIGHT).otherwise(wrong))),
    ).otherwise(F.lit(zeros))
    both = F.zip_with("logs", said, lambda a, b: a + b)
    rows = write_through(rows.withColumn("evidence", both).withColumn("vote", _normal(F.col("evidence"))), "language-evidence")
    votes = [F.sum(F.get("vote", F.lit(i))).alias(f"v{i}") for i in range(n)]
    vector = F.array(*[f"v{i}" for i in range(n)])
    hosts = write_through(rows.groupBy("host", "domain", "suffix").agg(*votes).select("host", "domain", "suffix", vector.alias("host_votes")), "host-votes")
    again = [F.sum(F.get("host_votes", F.lit(i))).alias(f"v{i}") for i in range(n)]
    domains = hosts.groupBy("domain").agg(*again).select("domain", vector.alias("domain_votes"))
    suffixes = hosts.groupBy("suffix").agg(*again).select("suffix", vector.alias("suffix_votes"))
    every = hosts.agg(*again).first()
    total = F.lit([float(x or 0) for x in every])
    joined = rows.join(
        hosts.join(domains, "domain").join(suffixes, "suffix").select("host", "host_votes", "domain_votes", "suffix_votes"), "host"
    )

    def smoothed(prior: Column, of: Column) -> Column:
        own = F.zip_with(of, F.col("vote"), lambda a, b: F.greatest(a - b, F.lit(0.0)))
        size = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(own, prior, lambda a, p: (a + PRIOR_PAGES * p) / (size + PRIOR_PAGES))

    prior = F.lit([1.0 / n] * n)
    for k, of in enumerate((total, F.col("suffix_votes"), F.col("domain_votes"), F.col("host_votes"))):
        joined = joined.withColumn(f"prior{k}", smoothed(prior, of))
        prior = F.col(f"prior{k}")
    fused = joined.withColumn("posterior", _normal(F.zip_with("evidence", prior, lambda a, p: a + F.log(p))))
    best = F.array_max("posterior")
    return unpacked(
        fused, lang=F.get(names, F.array_position("posterior", best).cast("int") - 1), probability=best,
        declared=F.col("declared"), host=F.col("host"),
    )

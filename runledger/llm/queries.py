"""The registered queries of the operators, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import (
    collocations, divergence, exact_dedup, language_id, line_quality, lm_scoring, mixing, packing, probminhash, sharding,
    spotsigs, suffix_dedup, url_filter,
)

SHARDS = 8
RULES = [
    url_filter.Rule("org/", "allow"),
    url_filter.Rule("example.org/es/", "block"),
    url_filter.Rule("example.org/en/1", "block"),
    url_filter.Rule("com/fr/", "allow"),
    url_filter.Rule("com/de/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, RULES).drop("url")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    grown = F.lit(None).cast("int").alias("grown_shard")
    return sharding.assign_shards(docs, SHARDS).select("*", F.lit("rows").alias("law"), grown)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.count_words(F.col("text")).alias("size"))
    return mixing.mix(docs)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by the model of those labelled good and not toxic."""
    good = _table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return lm_scoring.score(_table(spark, sf_dir, "documents").select("doc_id", "text"), good)


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: fingerprints, the likeness to an edit and to the next one, and the class among all of them."""
    return spotsigs.compare_in_classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.judge_lines(docs).drop("text", "clean_text")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; the text model is trained on all documents that name a language."""
    model = language_id.train(_table(spark, sf_dir, "documents"))
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return language_id.identify(pages, model).drop("url", "html")


def op8_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("node")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By strings of 400 bytes; passages of over 50 words that are found again are reported beside that, however few bytes they have."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, kept="", report_words=50)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # The digest is asked of every document, those that length and prefix tell apart included.
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    marked = exact_dedup.mark_copies(docs.withColumn("text_sha256", digest), keep_text=False)
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents").select("lang", "text"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_sharding, op3_mixing, op4_lm_scoring, op5_spotsigs, op6_line_quality, op7_language_id,
        op8_probminhash, op9_packing, op10_suffix_dedup, op11_exact_dedup, op12_source_divergence, op13_collocations,
    )
}

"""From raw documents to training sequences: quality rules, near-duplicates, repeated passages, mix, packing.

Every stage takes what the one before kept, whole, and is written before the next reads it.  So what a stage
wrote on its way is removed when the next one begins.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runledger.llm import line_quality, mixing, packing, probminhash, suffix_dedup
from runledger.llm.common import write_through
from runledger.session import recorded_scratch, release_scratch

# Fixed value: passages of more words than this are not to be found twice.
PASSAGE_WORDS = 50
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Folders of the last stage that ran, of no use once its result is written.
_left: list[str] = []


def _stage(work: Stage) -> Stage:
    """A stage that first removes what the stage before it left, except what its own input is read from.

    A stage's result that nobody has written is lost when the next stage is called, unless it is that one's input.
    """

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, _left, docs)
        with recorded_scratch(_left):
            return work(spark, docs, sf_dir)

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines go; documents that are rejected go whole."""
    return line_quality.clean_documents(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays."""
    return probminhash.deduplicate(docs)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, and strings of 400 bytes, that are found twice go; documents stay, if with an empty text."""
    return suffix_dedup.remove_from_documents(docs, over_words=PASSAGE_WORDS)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences with their ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mix", mix),
    ("packing", packing_stage),
]

# The draw of the mix and the tokenizer's ids have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written: list[str] = []
    for name, stage in STAGES:
        with recorded_scratch(written):
            docs = write_through(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release_scratch(spark, written, docs)
    return docs

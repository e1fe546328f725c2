"""Fan-in, routing and fan-out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import attr


@dataclass(frozen=True)
class Route:
    """Rows for which ``condition`` is true go to all of ``pipelines``."""

    condition: Column
    pipelines: tuple


def text_attr(attributes: Column | str, key: str) -> Column:
    """A text attribute; NULL if it is missing or no text, as a number never equals a text."""
    return attr(attributes, key)["stringValue"]


def resource_attr(key: str) -> Column:
    """A text attribute of the resource of a flattened row."""
    return text_attr("resource.attributes", key)


def merge_sources(*sources: DataFrame) -> DataFrame:
    """All rows of all sources; duplicates stay."""
    return reduce(DataFrame.unionByName, sources)


def pipelines_of(routes: list[Route], default: list[str]) -> Column:
    """The pipelines a row goes to, as an array: those of the first route whose condition
    is true, else ``default``.  A condition that is NULL is not true."""
    listed = F.array(*[F.lit(p) for p in default])
    for r in reversed(routes):
        listed = F.when(r.condition, F.array(*[F.lit(p) for p in r.pipelines])).otherwise(listed)
    return listed


def _names(all_pipelines) -> list[str]:
    return list(dict.fromkeys(p for pipelines in all_pipelines for p in pipelines))


def route(df: DataFrame, routes: list[Route], default: list[str]) -> dict[str, DataFrame]:
    """Rows per pipeline.  The first matching route counts, unmatched rows go to ``default``.

    Each pipeline is a filter over the same input, so nothing is shuffled;
    :func:`run_pipelines` reads the input once for all of them.
    """
    listed = pipelines_of(routes, default)
    names = _names([*[r.pipelines for r in routes], default])
    return {name: df.filter(F.array_contains(listed, name)) for name in names}


def route_counts(df: DataFrame, routes: list[Route], default: list[str]) -> DataFrame:
    """Rows per pipeline that gets any, in one pass: ``pipeline, records``."""
    sent = df.select(F.explode(pipelines_of(routes, default)).alias("pipeline"))
    return sent.groupBy("pipeline").agg(F.count(F.lit(1)).alias("records"))


def route_envelopes(envelopes: DataFrame, routes: list[tuple], default: list[str], field: str) -> dict[str, DataFrame]:
    """Route whole resources inside their envelopes, without flattening or a shuffle.

    ``routes`` holds ``(condition, pipelines)`` where ``condition`` takes the
    attributes of a resource and returns a Column; ``field`` names the array of
    resources.  Envelopes left empty are dropped.
    """

    def goes_to(name):
        def test(resource):
            attributes = resource["resource"]["attributes"]
            bound = [Route(condition(attributes), pipelines) for condition, pipelines in routes]
            return F.array_contains(pipelines_of(bound, default), name)

        return test

    names = _names([*[pipelines for _, pipelines in routes], default])
    return {
        name: envelopes.withColumn(field, F.filter(field, goes_to(name))).filter(F.size(field) > 0) for name in names
    }


def run_pipelines(df: DataFrame, branches: Callable[[DataFrame], dict], sinks: dict) -> None:
    """Write every branch of ``df`` to its sink, reading ``df`` once.

    ``branches`` maps the input to ``{pipeline: DataFrame}`` and ``sinks`` maps a
    pipeline to a function that writes a DataFrame.  Made for ``foreachBatch``;
    the batch is kept on disk where memory is short and rebuilt from its source
    where an executor is lost.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, rows in branches(kept).items():
            sinks[name](rows)
    finally:
        kept.unpersist()

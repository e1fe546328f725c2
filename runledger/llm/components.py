"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import write_through


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` for every end of a link; the label is the least node reached.

    Large and small stars in turn: every node links its larger neighbours to its least
    one, then its smaller ones. Links never grow in number, and some log(n) rounds leave
    stars. Each round is written, so lost executors cost a round at most. Partial
    minima come before each shuffle; the joins are by ``u``, so a hub's links are split only by adaptive execution.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = write_through(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select("u", "v", "m")
        small = moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(moved.select("u", F.col("m").alias("v")))
        edges = write_through(small.where("u != v").distinct(), "edges")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.min("v"), F.max("u")
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )

"""Sharding: a Feistel permutation of the global row numbers, with cycle walking, deals rows to shards.

A row's place in the shuffled order is computed from its row number, the number
of rows and a seed alone; shard and slot follow from the place, and from shard and
slot the row number follows again (``row_number_at``), without any table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import free_names, number_rows, quoted

ROUNDS = 6
# Walks longer than this stop the query; among N numbers fewer than sqrt(N) lie outside, so the odds are N ** -32.
WALK = 64


def _mixed(seed: int, turn: int, value: Column, modulus: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), value), F.lit(modulus))


def _feistel(x: Column, high: int, low: int, seed: int, inverse: bool) -> Column:
    """A permutation of 0 .. high * low - 1 whose halves take turns in shifting each other."""
    left, right = F.call_function("div", x, F.lit(low)), F.pmod(x, F.lit(low))
    for turn in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        if turn % 2 == 0:
            shift = _mixed(seed, turn, right, high)
            left = F.pmod(left - shift if inverse else left + shift, F.lit(high))
        else:
            shift = _mixed(seed, turn, left, low)
            right = F.pmod(right - shift if inverse else right + shift, F.lit(low))
    return left * F.lit(low) + right


def permute(number: Column, n: int, seed: int = 17, inverse: bool = False) -> Column:
    """Where row ``number`` of ``n`` stands in the shuffled order, a permutation of 0 .. n - 1 (n up to 2 ** 50)."""
    if n > 2**50:
        raise ValueError("more than 2 ** 50 rows")
    if n < 2:
        return number.cast("long")
    high = math.isqrt(n - 1) + 1
    low = -(-n // high)

    def step(x: Column) -> Column:
        return _feistel(x, high, low, seed, inverse)

    inside = F.lit(n)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        step(number.cast("long")),
        lambda x, _: F.when(x < inside, x).otherwise(step(x)),
    )
    return F.aggregate(
        F.array(walked), F.lit(0).cast("long"),
        lambda _, x: F.when(x < inside, x).otherwise(F.raise_error(F.lit("walk too long, change the seed")).cast("long")),
    )


def row_number_at(shard: Column, slot: Column, n: int, shards: int, seed: int = 17) -> Column:
    """The number of the row that stands at ``slot`` of ``shard``."""
    return permute(slot * F.lit(shards) + shard, n, seed, inverse=True)


def assign_shards(df: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` (int) and ``slot`` (long), replacing columns so named.

    Shards differ by one row at most and slots are gapless from 0. The same rows
    give the same result however they are stored. Nulls are values like others;
    equal rows get places of their own; an empty table gives an empty one.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    own = {"row_number", "shard", "slot"}
    kept = df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in own])
    numbered, n = number_rows(kept, "row_number")
    (at,) = free_names(kept, "place")
    place = numbered.withColumn(at, permute(F.col("row_number"), n, seed))
    return place.select(
        *[F.col(quoted(c)) for c in kept.columns],
        "row_number",
        F.pmod(at, F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col(at), F.lit(shards)).cast("long").alias("slot"),
    )

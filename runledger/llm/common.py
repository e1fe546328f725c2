"""What the operators share: rows carried whole, let-bindings in SQL expressions, numbering without a single task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.session import scratch_path, write_through

# Fixed value: what separates words.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
ROWS_PER_BUCKET = 20_000
HOT_SHARE = 1000


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """Every row of ``df`` as one struct column ``row``, so that no column of it can clash with one made here."""
    row = F.struct(*[F.col(quoted(c)).alias(c) for c in df.columns])
    return df.select(row.alias("row"), *[v.alias(k) for k, v in more.items()])


def unpacked(df: DataFrame, **new: Column) -> DataFrame:
    """The fields of ``row`` and the ``new`` columns, which replace fields of the same name in any case."""
    taken = {name.lower() for name in new}
    old = [f.name for f in df.schema["row"].dataType if f.name.lower() not in taken]
    return df.select(*[F.col("row").getField(c).alias(c) for c in old], *[v.alias(k) for k, v in new.items()])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where a lambda in ``use`` reads it for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digest_of(df: DataFrame, text: Column) -> Callable[[Column], Column]:
    """What gives a text (null as empty) a 64-bit number of its own among the texts of ``df``.

    Texts whose numbers are equal though a second digest or the length tells them apart make it try another seed.
    """

    def made(seed: int) -> Callable[[Column], Column]:
        return lambda own: F.xxhash64(F.lit(seed), F.coalesce(own, F.lit("")))

    body = F.coalesce(text, F.lit(""))
    for seed in range(42, 52):
        pairs = df.select(made(seed)(text).alias("a"), F.xxhash64(F.lit(-1), body, F.length(body)).alias("b")).distinct()
        if pairs.groupBy("a").count().where("count > 1").isEmpty():
            return made(seed)
    raise RuntimeError("digests collide for every seed")


def number_rows(df: DataFrame, name: str = "number", lead: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """``df`` with a gapless row number from 0, and the number of rows.

    The number depends on the rows' content alone, not on files, partitions or
    retries; equal rows get adjacent numbers, and rows that are equal in ``lead``, of
    which there are few values, stand together in their order. Equal rows are counted before the
    shuffle, so a third of all rows being equal costs one row; hash buckets of
    some 20,000 rows are numbered on their own and put in order by their sizes,
    of which there is one row per bucket. All columns must be groupable (no maps).
    """
    cols = [F.col(quoted(c)) for c in df.columns]
    n, h, b, start, before = free_names(df, "n", "h", "b", "start", "before")
    grouped = write_through(df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n)), "distinct-rows")
    kinds = grouped.count()
    buckets = max(1, -(-kinds // ROWS_PER_BUCKET))
    digest = F.xxhash64(*cols) if df.columns else F.lit(0)
    split = grouped.withColumn(h, digest).withColumn(b, F.pmod(h, F.lit(buckets)))
    keys = [*map(quoted, lead), b]
    sizes = split.groupBy(*keys).agg(F.sum(n).alias("rows"))
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(start))
    total = grouped.agg(F.sum(n)).first()[0] or 0
    inside = Window.partitionBy(*keys).orderBy(h, *cols).rowsBetween(Window.unboundedPreceding, -1)
    ranged = split.withColumn(before, F.coalesce(F.sum(n).over(inside), F.lit(0))).join(starts, [*lead, b])
    first = F.col(start) + F.col(before)
    number = F.explode(F.sequence(first, first + F.col(n) - 1))
    return ranged.select(*cols, number.alias(name)), total


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns that no column of ``df`` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    mark = next(m for m in ("_" * k for k in range(2, len(taken) + 3)) if not any(m + w in taken for w in wanted))
    return [mark + w for w in wanted]


def join_by_weight(rows: DataFrame, groups: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` left joined with ``groups``, of which each key has one row; both are written tables, ``rows`` without null keys.

    ``weight`` bounds the rows of a key. Groups of more than a HOT_SHARE-th of all weight, which by their sum are fewer
    than HOT_SHARE, are broadcast, so their rows stay where they are; no other key can fill a task.
    """
    total = groups.agg(F.sum(F.col(weight).cast("decimal(38,0)"))).first()[0] or 0
    hot = F.col(weight) * HOT_SHARE > F.lit(total).cast("decimal(38,0)")
    few = F.broadcast(groups.where(hot))
    large = rows.join(few, key)
    rest = rows.join(few.select(key), key, "left_anti").join(groups.where(~hot), key, "left")
    return large.unionByName(rest)


__all__ = [
    "ROWS_PER_BUCKET", "SPACES", "WORD", "digest_of", "free_names", "join_by_weight", "let", "number_rows", "packed", "quoted",
    "scratch_path", "unpacked", "write_through",
]

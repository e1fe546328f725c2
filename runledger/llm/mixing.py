"""Mixing sources to target weights: pivotal dependent rounding of copy probabilities.

Each document of a source is due the same number of copies, target / size of the
source. Whole copies are certain; the fractional ones are settled in pairs: mass,
counted in words, moves at random from one document to the other until one of the
two holds a whole copy or none. What a block of documents leaves over, one
fractional document, goes up a reduction tree with those of other blocks. Words
are conserved in every step, so a source misses its target by less than one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import ROWS_PER_BUCKET, WORD, packed, quoted, unpacked, write_through

BLOCK = 64
MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
_WHOLE = 1 << 53


def count_words(text: Column) -> Column:
    """Words of a text; none for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``target`` from a table of ``source`` and ``size``, both in words.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ...; they share the sum
    of all sizes by weight. A target stops at three times its source's size and the
    rest is shared again among the others. Rows are sources, pre-aggregated; they
    are put in order in one task.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    rank = (F.row_number().over(ordered) - 1) % len(WEIGHTS)
    weighed = sources.select(
        "*",
        F.get(F.array(*map(F.lit, WEIGHTS)), rank).alias("weight"),
        (MAX_COPIES * F.col("source_size")).alias("cap"),
    ).withColumn("level", F.col("cap") / F.col("weight"))
    # Sources fill up in order of cap / weight; the first that doesn't fill sets the level for the rest.
    filling = Window.orderBy("level", F.col("source").isNull(), "source")
    done = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = weighed.withColumn("at", (F.sum("source_size").over(everything) - done) / open_weight)
    first = F.when(F.col("at") <= F.col("level"), F.struct(F.row_number().over(filling).alias("nr"), "at"))
    shared = shared.withColumn("first", first)
    level = F.min("first").over(everything)["at"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level, F.col("level")) * F.col("weight"))
    return shared.select("source", "source_size", target.alias("target"))


def _uniform(seed: int, *of: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(_WHOLE)) / F.lit(float(_WHOLE))


def _settled(items: Column, seed: int) -> Column:
    """All ``items`` of a block, all but the last with ``p`` 0 or 1."""

    def item(x: Column, p: Column) -> Column:
        return F.struct(x["size"].alias("size"), x["uid"].alias("uid"), p.alias("p"), x["row"].alias("row"))

    def meet(state: Column, x: Column) -> Column:
        r, zero, one = state["left"], F.lit(0.0), F.lit(1.0)
        r_room, r_mass = (one - r["p"]) * r["size"], r["p"] * r["size"]
        x_room, x_mass = (one - x["p"]) * x["size"], x["p"] * x["size"]
        up, down = F.least(r_room, x_mass), F.least(r_mass, x_room)
        rises = _uniform(seed, r["uid"], x["uid"]) * (up + down) < down
        r_done = F.when(rises, r_room <= x_mass).otherwise(r_mass <= x_room)
        r_p = F.when(rises, F.least(one, r["p"] + up / r["size"])).otherwise(F.greatest(zero, r["p"] - down / r["size"]))
        x_p = F.when(rises, F.greatest(zero, x["p"] - up / x["size"])).otherwise(F.least(one, x["p"] + down / x["size"]))
        whole_r, whole_x = F.when(rises, one).otherwise(zero), F.when(rises, zero).otherwise(one)
        settled = F.when(r_done, item(r, whole_r)).otherwise(item(x, whole_x))
        left = F.when(r_done, item(x, x_p)).otherwise(item(r, r_p))
        return F.struct(left.alias("left"), F.concat(state["done"], F.array(settled)).alias("done"))

    first = F.get(items, F.lit(0))
    start = F.struct(item(first, first["p"]).alias("left"), F.slice(items, 1, 0).alias("done"))
    return F.aggregate(
        F.slice(items, F.lit(2), F.size(items)), start, meet, lambda s: F.concat(s["done"], F.array(s["left"]))
    )


def mix(df: DataFrame, source: str = "source", size: str = "size", seed: int = 11) -> DataFrame:
    """``df`` with ``source_size``, ``target`` (of its source), ``copies`` and ``taken`` (words), replacing columns so named.

    ``size`` counts words and is not null. A row gets the whole copies its source is
    due and, by lot, one more; rows of size 0 get the whole ones only, and sources of
    size 0 none. Equal rows are drawn each on its own. Blocks hold 64 rows of one
    source whatever its size, so no task gathers a source. The draw depends on the rows'
    content and the seed, not on partitions. A null source is a source, last in order.
    Nothing is done to an empty table. Columns must be groupable (no maps).
    """
    own = {"source_size", "target", "copies", "taken"}
    cols = [F.col(quoted(c)) for c in df.columns if c.lower() not in own]
    counted = packed(df.select(*cols)).groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    counted = write_through(
        counted.select(
            "row", "n", F.col("row").getField(source).alias("source"), F.col("row").getField(size).cast("long").alias("size")
        ),
        "mix-rows",
    )
    targets = source_targets(counted.select("source", (F.col("size") * F.col("n")).alias("size")))
    targets = write_through(targets, "mix-targets")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (
        counted.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .alias("c")
        .join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
        .select("row", "c.source", "size", "source_size", "target", due.alias("due"), F.xxhash64("row", "turn").alias("uid"))
        .withColumn("whole", F.floor("due"))
        .withColumn("p", F.when(F.col("size") > 0, F.col("due") - F.col("whole")).otherwise(F.lit(0.0)))
    )
    buckets = max(1, -(-counted.agg(F.sum("n")).first()[0] // ROWS_PER_BUCKET)) if not counted.isEmpty() else 1
    kept = F.struct("row", "source_size", "target", "whole").alias("row")
    order = Window.partitionBy("source", "bucket").orderBy("size", "uid")
    placed = (
        rows.where((F.col("p") > 0) & (F.col("p") < 1))
        .select("source", "size", "uid", "p", kept, F.pmod("uid", F.lit(buckets)).cast("int").alias("bucket"))
        .withColumn("block", (F.row_number().over(order) - 1).cast("int"))
    )
    level = write_through(placed, "mix-level")
    most = level.agg(F.max("block")).first()[0]
    certain = rows.where((F.col("p") <= 0) | (F.col("p") >= 1)).select("size", kept, F.col("p").alias("extra"))
    parts, depth = [certain], 0
    while most is not None:
        upper = "block" if most > 0 or depth == 0 else "bucket"
        most, buckets = (most // BLOCK, buckets) if upper == "block" else (0, -(-buckets // BLOCK))
        item = F.struct("size", "uid", "p", "row")
        grouped = (
            level.withColumn(upper, F.floor(F.col(upper) / BLOCK).cast("int"))
            .groupBy("source", "bucket", "block")
            .agg(F.sort_array(F.collect_list(item), asc=False).alias("items"))
        )
        settled = grouped.select(
            "source", "bucket", "block", F.size("items").alias("many"), F.posexplode(_settled(F.col("items"), seed + depth))
        )
        settled = write_through(settled, "mix-level")
        last, x = F.col("pos") == F.col("many") - 1, F.col("col")
        top = most == 0 and buckets == 1
        drawn = F.when(_uniform(seed - 1, x["uid"]) < x["p"], F.lit(1.0)).otherwise(F.lit(0.0))
        done = settled if top else settled.where(~last)
        extra = F.when(last, drawn).otherwise(x["p"]) if top else x["p"]
        parts.append(done.select(x["size"].alias("size"), x["row"].alias("row"), extra.alias("extra")))
        if top:
            break
        level = settled.where(last).select("source", "bucket", "block", "col.*")
        depth += 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    copies = (F.col("row.whole") + F.col("extra")).cast("int")
    flat = out.select(
        F.col("row.row").alias("row"), "row.source_size", "row.target", copies.alias("copies"),
        (F.col("size") * copies).cast("long").alias("taken"),
    )
    return unpacked(flat, **{c: F.col(c) for c in ("source_size", "target", "copies", "taken")})


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", seed: int = 11) -> DataFrame:
    """The documents of the mix, each as many times as it is taken, with the columns of ``docs``.

    The draw is made on narrow rows (a digest, source and size) and joined to the
    texts by the digest; equal documents share what they drew.
    """
    key = F.xxhash64(*[F.col(quoted(c)) for c in docs.columns])
    narrow = docs.select(key.alias("key"), F.col(quoted(source)).alias("source"), count_words(F.col(quoted(text))).alias("size"))
    drawn = mix(narrow, seed=seed).groupBy("key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    copies = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("turn") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    joined = packed(docs, key=key).join(drawn.where("copies > 0"), "key").withColumn("turn", turn)
    return unpacked(joined.withColumn("many", copies).where("many > 0").select("row", F.explode(F.expr("sequence(1, many)"))))

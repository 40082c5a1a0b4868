"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

The corpus is dealt in blocks of equally many words, short enough that the smallest target is made of
``FINE`` of them. Sources get whole numbers of blocks by the
highest quotients weight / (2k + 1), and inside a source its shards do the same by size. A shard is
a seeded part of a source's documents in seeded order; its words are one stream, cut into equal
blocks, and a run of blocks from a seeded start is taken, whole rounds first. A document's share is
the overlap of its interval with that run.

Only sizes are shuffled, never texts. The hottest source is split over its shards. What meets in one
task is one row a source, or at most ``SHARDS`` rows of one source.

Defined results: a null text has size 0 and takes 0; a null source is a source of its own and comes
last; sources of size 0 have target 0. Equal rows are separate documents with separate intervals. An
empty table gives an empty result. Texts of any length are counted whole. Other columns pass through; those named like a result are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable

WORD = r"[^\x20\x09-\x0D]+"
#: Shards of a source at most; larger sources have larger shards.
SHARDS = 65_536
#: Words of a block at most, blocks of the smallest target, and blocks of the longest kind in a shard.
BLOCK, FINE, LONG = 1024, 400, 256
ROUNDS = 3
RESULT = ("size", "source_size", "target", "taken")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), rounds: int = ROUNDS) -> DataFrame:
    """Target words of each source from ``source, source_size``.

    Weights repeat along the sources by code point, null last. A target stops at ``rounds`` times the
    source's size and the excess goes to the others by weight: the level is found along the ratio of
    limit to weight, as sources fill up in that order.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    weighed = sizes.withColumn("place", F.row_number().over(by_name)).withColumns(
        {
            "weight": F.get(weights, F.pmod(F.col("place") - 1, F.lit(len(cycle)))),
            "most": (rounds * F.col("source_size")).cast("double"),
        }
    )
    weighed = weighed.withColumn("fills", F.col("most") / F.col("weight"))
    filling = Window.orderBy("fills", "place")
    before, onward = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    open_at = weighed.withColumn("level", level)
    # The first source that its level doesn't fill sets the level for it and all after it.
    reached = F.min(F.when(F.col("level") <= F.col("fills"), F.struct("fills", "place", "level"))).over(everything)
    leveled = open_at.withColumn("reached", reached)
    return leveled.select(
        "source", "place", "source_size", F.least("most", F.coalesce(F.col("reached.level") * F.col("weight"), "most")).alias("target")
    )


def apportion(claims: DataFrame, group: list[str], seats: str, weight: str, order: list[str]) -> DataFrame:
    """Add ``quota``: ``seats`` of each group dealt by highest quotients ``weight / (2k + 1)``.

    A claim's number of seats lies near its exact share q: with n claims and N seats the divisor
    differs from the mean by n / 2N at most. Seats below that range are sure, and only the quotients
    inside it (about n for all claims together) are ranked.
    """
    whole = Window.partitionBy(*group)
    n, total = F.count(F.lit(1)).over(whole), F.sum(weight).over(whole)
    shared = claims.withColumn("_q", F.when(total > 0, F.col(seats) * F.col(weight) / total).otherwise(0.0))
    slack = F.when(F.col(seats) > 0, F.col("_q") * n / (2 * F.col(seats))).otherwise(0.0)
    shared = shared.withColumn("_slack", slack)
    bounded = shared.withColumns(
        {
            "_low": F.greatest(F.lit(0), F.floor(F.col("_q") - F.col("_slack")) - 2).cast("bigint"),
            "_high": (F.ceil(F.col("_q") + F.col("_slack")) + 2).cast("bigint"),
        }
    )
    left = bounded.withColumn("_open", F.col(seats) - F.sum("_low").over(whole))
    steps = left.where(F.col(weight) > 0).withColumn("_k", F.explode(F.sequence("_low", "_high")))
    ranked = Window.partitionBy(*group).orderBy((F.col(weight) / (2 * F.col("_k") + 1)).desc(), *order, "_k")
    won = steps.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= F.col("_open"))
    extra = won.groupBy(*group, *order).agg(F.count(F.lit(1)).alias("_won"))
    keys = list(dict.fromkeys([*group, *order]))
    quota = F.when(F.col(weight) > 0, F.col("_low") + F.coalesce("_won", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    return left.join(extra, keys, "left").select(*claims.columns, quota.alias("quota"))


def _draw(seed: int, *parts: Column) -> Column:
    """A seeded number from 0 to 2**32 - 1."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def mix(
    df: DataFrame,
    text: str = "text",
    doc: str = "doc_id",
    source: str = "source",
    cycle: tuple[int, ...] = (1, 2, 3),
    rounds: int = ROUNDS,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document."""
    sized = durable(df.select(F.col(doc).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size")))
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, rounds)
    one = Window.partitionBy()
    total, smallest = F.sum("source_size").over(one), F.min(F.when(F.col("target") > 0, F.col("target"))).over(one)
    # One length for all sources, from the smallest target.
    per_block = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.coalesce(smallest, F.lit(0.0)) / FINE))).cast("bigint")
    sources = sources.withColumns({"total": total, "per_block": per_block, "all": F.lit(1)})
    sources = sources.withColumn("blocks", F.floor(F.col("total") / F.col("per_block")).cast("bigint"))
    sources = apportion(sources, ["all"], "blocks", "target", ["place"])
    # Shards have many blocks of any length, and don't multiply with shorter ones.
    shards = F.least(F.lit(SHARDS), F.greatest(F.lit(1), F.floor(F.col("source_size") / (LONG * block)))).cast("bigint")
    sources = durable(sources.withColumn("shards", shards).drop("all", "blocks", "total"))

    named = sources.withColumnRenamed("source", "_source")
    placed = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumns(
        {"shard": F.pmod(_draw(seed, F.col("doc_id")), F.col("shards")), "draw": F.md5(F.concat_ws(":", F.lit(f"{seed}+"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))}
    )
    parts = placed.groupBy("place", "shard").agg(F.sum("size").alias("words"), F.max("quota").alias("seats"), F.max("per_block").alias("per_block"))
    dealt = apportion(parts, ["place"], "seats", "words", ["shard"])
    n = F.greatest(F.lit(1), F.round(F.col("words") / F.col("per_block"))).cast("bigint")
    dealt = dealt.withColumn("n", n).withColumn("quota", F.least("quota", rounds * F.col("n")))
    start = F.pmod(_draw(seed, F.col("place"), F.col("shard"), F.lit("start")), F.col("n"))
    dealt = dealt.withColumns({"whole": F.floor(F.col("quota") / F.col("n")), "rest": F.col("quota") % F.col("n"), "start": start})
    edge = lambda i: F.floor(i * (F.col("words") / F.col("n"))).cast("bigint")
    stop = F.col("start") + F.col("rest")
    dealt = dealt.select(
        "place", "shard", "whole", edge(F.col("start")).alias("from_1"), edge(F.least(stop, F.col("n"))).alias("to_1"),
        edge(F.greatest(F.lit(0), stop - F.col("n"))).alias("to_2"),
    )
    along = Window.partitionBy("place", "shard").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("end", F.sum("size").over(along)).withColumn("begin", F.col("end") - F.col("size"))

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least("end", high) - F.greatest("begin", low))

    run = overlap(F.col("from_1"), F.col("to_1")) + overlap(F.lit(0), F.col("to_2"))
    taken = (F.col("whole") * F.col("size") + run).cast("bigint")
    return laid.join(dealt, ["place", "shard"]).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))

"""Connected components of a link table, by large and small stars.

Each round points neighbours at the smallest node around them, in joins and minima that are combined
before the shuffle, until nothing changes; the rounds grow with the logarithm of the longest path.
Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable


def _least(edges: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(_least(both), "u")
    return near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    least = _least(down)
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    h: Column = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node reachable."""
    edges = durable(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = durable(_small(_large(edges).where("u != v")))
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)

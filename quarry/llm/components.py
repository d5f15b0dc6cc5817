"""Connected components of a link table, by alternating large-star and small-star
steps (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stage


def _min_of_neighbours(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the least of u and all its v.

    The least are written first, so that the join stands alone in its stage and the
    edges of a star's centre can be split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(stage(least, "components-least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _min_of_neighbours(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _min_of_neighbours(down)
    return starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        starred.select("u", F.col("m").alias("v"))
    )


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node of
    ``edges`` (u, v) that is not the smallest of its component."""
    edges = stage(edges.where("u != v").select("u", "v").distinct(), "components")
    seen = None
    while True:
        edges = stage(
            _small_star(_large_star(edges)).where("u != v").distinct(), "components"
        )
        now = _summary(edges)
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now

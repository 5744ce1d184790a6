"""Connected components of a table of links, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex moves to the vertex's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").where(F.col("b") > F.col("a"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours move to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _are_stars(links: DataFrame) -> bool:
    """Whether each vertex has one link down, to a vertex that has none."""
    n, distinct = links.agg(F.count("*"), F.count_distinct("a")).first()
    return n == distinct and links.join(links.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``a`` and ``b``: each linked vertex but the least of its component, and that one.

    Links are rows of ``a`` and ``b``. The two star steps are repeated until only stars
    are left; every step aggregates and joins by vertex, so a vertex with any number
    of links is only as many rows. Each round is written to the shared folder,
    which also cuts the plan.
    """
    links = links.select("a", "b").where(F.col("a") != F.col("b"))
    while True:
        stars = _small_star(_large_star(links))
        links = materialise(stars.where(F.col("a") != F.col("b")).distinct())
        if _are_stars(links):
            return links

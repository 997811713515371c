"""Connected components of a link table by alternating star contractions.

Every round rewrites the links so that nodes point to smaller neighbours, once over all neighbours
and once over the smaller ones; it ends with stars around the smallest node of each component.
Rounds grow with the logarithm of the longest path. Only the round's counts reach the driver, and
each round is a table in the shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common


def _towards_smallest(both: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to the smallest of its neighbourhood."""
    smallest = both.groupBy("a").agg(F.min("b").alias("least"))
    smallest = smallest.select("a", F.least("a", "least").alias("least"))
    larger = both.filter(F.col("b") > F.col("a"))
    return larger.join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _among_smaller(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    smallest = links.groupBy("a").agg(F.min("b").alias("least"))
    passed = links.join(smallest, "a").filter(F.col("b") != F.col("least"))
    passed = passed.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return passed.unionByName(smallest.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every linked node but roots.

    ``links`` has two long columns, ``a`` and ``b``; order, repeats, self-links and nulls do not
    matter. Nodes without links do not appear; no links give an empty frame.
    """
    stars = common.stored(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars = common.stored(
            _among_smaller(_towards_smallest(both).distinct()).distinct(), "links"
        )
        # Done once every node has one smaller neighbour, and that one has none itself.
        parents = stars.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        inner = stars.select(F.col("b").alias("a")).distinct().join(parents, "a", "left_semi")
        open_ends = parents.filter("n > 1").select("a").unionByName(inner)
        if open_ends.isEmpty():
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))

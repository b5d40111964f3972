"""Connected components of a table of links, by alternating star steps.

A large-star step moves each node's larger neighbours to its smallest one, a small-star step
does so with the smaller neighbours (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014). Both are a grouped minimum and a join. Minima are saved before they are
joined: then both sides of the join are plain shuffles, and adaptive execution can split a
node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.saving import saved


def _done(links: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which has none itself."""
    several = links.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    chained = links.alias("x").join(links.alias("y"), F.col("x.b") == F.col("y.a"), "left_semi")
    return several.isEmpty() and chained.isEmpty()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (a, b) with b < a; the result has the same form."""
    swapped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = links.unionByName(swapped) if large else links
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    least = saved(least, "least")
    moved = (swapped if large else links).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return saved(moved.filter(F.col("a") != F.col("b")).distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b): the smallest node that it reaches.

    Links may come in either direction, repeated, and from a node to itself; links with a
    null end tell nothing. A root has a row of its own. No links: no rows.
    """
    one_way = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = saved(one_way.distinct(), "links")
    while not _done(current):
        current = _star(_star(current, large=True), large=False)
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())

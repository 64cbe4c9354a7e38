"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import forget, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    return moved.unionAll(least.select(F.col("m").alias("x"), F.col("b").alias("y"))).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b")


def components(edges: DataFrame) -> DataFrame:
    """Links (a, b) of long ids -> (node, component): each linked node and the least node it reaches.

    Every round is two shuffles of the links, summed before they are sent, and its result is written to the shared
    folder, so a lost executor costs part of one round. The number of rounds is logarithmic in the longest path.
    Self-links and repeated links do no harm; no links give no rows."""
    now = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    state = None
    while True:
        after = materialise(_small_star(_large_star(now).distinct()).distinct())
        found = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        forget(now)
        now = after
        if found == state or not found[0]:
            break
        state = found
    return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))

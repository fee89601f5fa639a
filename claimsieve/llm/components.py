"""Connected components of a link table: alternating large-star and small-star steps.

Both steps are a minimum per node and a join, so a hub with a large share of all links is combined
in the map tasks and its join partition is split by adaptive execution. Every round is written to
the shared folder. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest node around it."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked with the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link to another node; the root is the smallest node of its component."""
    now = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    seen = None
    while True:
        now = stored(_small_star(_large_star(now)).where("a <> b").distinct(), "stars")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state

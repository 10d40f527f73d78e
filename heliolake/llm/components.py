"""Connected components of a large edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliolake.llm.common import stored

#: Rounds grow with the logarithm of the nodes; this many serve any input, and an unfinished labelling is never returned.
MOST_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to its smallest neighbour. Edges come as a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return (joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, comp)`` for every node on an edge; ``comp`` is the component's smallest node.

    Each round is written to the shared folder, which cuts the lineage. Hot nodes (a star with very many leaves) are
    only combined by ``min`` and joined by key, so no task or driver holds a component.
    """
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct(), "component-edges")
    mark = None
    for _ in range(MOST_ROUNDS):
        now = stored(_small_star(_large_star(now)), "component-edges")
        # a star forest no longer changes; its sums tell
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components are not settled after {MOST_ROUNDS} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custarc.llm.common import stored


def connected(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component): for each node of the undirected links (a, b), the smallest node that it
    reaches.

    Large-star and small-star steps alternate until nothing changes; both only join on nodes, and
    each step starts from a stored table. The number of steps grows with the logarithm of a
    component's diameter. A link of a node with itself is ignored.
    """
    edges = stored(_downward(links.select("a", "b")), "edges")
    before = None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def _downward(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller node."""
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.where("a != b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of a node to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and itself, to the smallest of them."""
    down = _downward(edges)
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _downward(moved.union(least.select("a", F.col("m").alias("b"))))

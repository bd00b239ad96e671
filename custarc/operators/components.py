"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected(links: DataFrame, cut: Callable[[DataFrame, str], DataFrame], rounds: int = 100) -> DataFrame:
    """(node, root): for each node of the undirected ``links`` (a, b), the smallest node it reaches.

    In each round every node hands the smallest of its neighbours first to its larger neighbours and
    then to its smaller ones, so stars grow and chains shrink by a constant factor. ``cut(df, name)``
    stores the links of a round. Links of a node with itself are ignored.
    """

    def downward(ends: DataFrame) -> DataFrame:
        return ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def with_least(ends: DataFrame, least) -> DataFrame:
        of = ends.groupBy("a").agg(least.alias("least")).withColumnRenamed("a", "of")
        return ends.join(of, F.col("a") == F.col("of")).drop("of")

    own, before = cut(downward(links.select("a", "b")), "links"), None
    for n in range(rounds):
        state = own.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = own.union(own.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = with_least(both, F.least(F.min("b"), F.col("a"))).where("b > a")
        down = with_least(downward(up.select(F.col("b").alias("a"), F.col("least").alias("b"))), F.min("b"))
        moved = down.select(F.col("b").alias("a"), F.col("least").alias("b"))
        own = cut(downward(moved.union(down.select("a", F.col("least").alias("b")))), f"links_{n}")
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    roots = own.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return own.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots).distinct()

"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens.llm.frames import stored

#: Rounds after which something must be wrong; log2 of the nodes suffice in practice.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _proper(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for edges ``(a, b)`` of longs; component is its least node.

    Edges with a null or equal ends are left out; nodes without another edge
    get no row. Every round is written to the shared folder, so a lost executor
    costs a round at most. Neighbours are never gathered: each round is two
    aggregations and two joins.
    """
    proper = _proper(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna())
    now, before = stored(proper, "edges"), None
    for _ in range(MOST_ROUNDS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = stored(_proper(_small_star(_proper(_large_star(now)))), "edges")
    else:
        raise RuntimeError("components did not settle")
    # Stars: every other node has one edge, to the least one.
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

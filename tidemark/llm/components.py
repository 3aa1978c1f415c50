"""Connected components by alternating stars, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written

# A node is a hub from so many edges on, but there are never more hubs than this.
HUB_EDGES, MOST_HUBS = 100, 10_000


def _hang(edges: DataFrame, rows: int) -> DataFrame:
    """Each ``v`` linked to the smallest neighbour of its ``u``; ``edges`` holds (u, v), at most ``rows`` of them.

    The edges of a hub stay where they are and are told its smallest neighbour. Hubs are few whatever the data:
    ``rows`` edges have room for ``rows / hub_from`` nodes of ``hub_from`` edges. All others go by their node.
    """
    hub_from = max(HUB_EDGES, -(-rows // MOST_HUBS))
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    hubs = F.broadcast(least.where(F.col("n") >= hub_from).drop("n"))
    others = least.where(F.col("n") < hub_from).drop("n")
    # No hub is among the others, so the join by node gets none of a hub's edges.
    small = edges.join(hubs, "u", "left_anti").join(others, "u")
    return edges.join(hubs, "u").unionByName(small)


def large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hang(both, 2 * rows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    moved = _hang(down, rows).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that reaches a smaller one.

    ``edges`` holds two long columns ``a`` and ``b``; loops, repeats and both directions are welcome. A hub is
    the neighbour of many: its minimum is aggregated partially and handed to its edges wherever they are.
    """
    current = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"), "edges")
    rows = current.count()
    if not rows:
        return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:
        # Large stars leave no more edges than there were.
        current = written(small_star(large_star(current, rows), rows), "edges")
        # Stars whose centres and members no longer change are the components.
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before, rows = now, now[0]

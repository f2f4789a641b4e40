"""Connected components of a graph of any shape, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Pointer jumps of a round: a path of smaller and smaller neighbours shrinks by two to this power.
JUMPS = 3


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(id, root) for every id of `edges` (a, b): root is the smallest id that can be reached.

    In each round every vertex points to its smallest neighbour, pointers are followed a few steps, and edges are
    contracted; edges within a vertex vanish and parallel ones fall together, until none is left. Minima are taken with
    partial aggregation, so a vertex with any number of edges leaves one row per task.
    """
    current = scratch.save(edges.select("a", "b").where("a <> b").distinct())
    maps: list[DataFrame] = []
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = scratch.save(
            both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("to"))
        )
        for _ in range(JUMPS):
            far = point.select(F.col("id").alias("to"), F.col("to").alias("far"))
            jumped = scratch.save(point.join(far, "to").select("id", F.col("far").alias("to")))
            scratch.drop(point)
            point = jumped
        maps.append(point)
        left = point.select(F.col("id").alias("a"), F.col("to").alias("x"))
        right = point.select(F.col("id").alias("b"), F.col("to").alias("y"))
        contracted = current.join(left, "a").join(right, "b").where("x <> y")
        following = scratch.save(
            contracted.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        scratch.drop(current)
        current = following
    if not maps:
        return current.select(F.col("a").alias("id"), F.col("b").alias("root"))
    root = maps[0].select("id", F.col("to").alias("root"))
    for later in maps[1:]:
        step = later.select(F.col("id").alias("root"), F.col("to").alias("_to"))
        root = root.join(step, "root", "left").select("id", F.coalesce("_to", "root").alias("root"))
    return scratch.save(root)

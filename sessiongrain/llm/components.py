"""Connected components by repeated contraction, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessiongrain.llm.common import cut, discard


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (node, root), one row for each node that has an edge to another node.

    Each round sends every node to the least node of its closed neighbourhood and maps both ends of
    every edge. A path maps to a path, so components stay; with hashed ids the nodes left shrink by a
    constant factor, so the rounds grow with the logarithm of the largest component. Minima are
    partially aggregated, and each edge is one row, so no group is gathered in one place.
    Order of ids is by xxhash64, a bijection of 64-bit values. root is one of the component's nodes.
    Self-loops and repeated edges are allowed; an empty input gives an empty result. Null ends are dropped.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = cut(both.where(F.col("a") != F.col("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not now.isEmpty():
        least = now.groupBy("a").agg(F.min_by("b", F.xxhash64("b")).alias("m"))
        step = cut(least.select(F.col("a").alias("node"), F.when(F.xxhash64("m") < F.xxhash64("a"), F.col("m")).otherwise(F.col("a")).alias("root")), "hook")
        maps.append(step)
        ends = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        other = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
        following = now.join(ends, "a").join(other, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).where("a != b").distinct()
        following = cut(following, "edges")
        discard(now)
        now = following
    if not maps:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    discard(now)
    whole = maps.pop()
    while maps:
        step = maps.pop()
        last = whole.select(F.col("node").alias("root"), F.col("root").alias("end"))
        merged = cut(step.join(last, "root", "left").select("node", F.coalesce("end", "root").alias("root")), "roots")
        discard(step, whole)
        whole = merged
    return whole

"""Connected components of a large, sparse graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainspark.llm.common import discard, stage


def components(edges: DataFrame) -> DataFrame:
    """node, component (least node reachable) for every node of edges(a, b).

    Each level maps a node to the least of itself and its neighbours, jumps once more along that map, and contracts
    the graph to the names that are left; edges inside a name go, so a dense group is gone after a level or two. The
    least node of a component always keeps its name. The maps are composed at the end. Every level is written to the
    shared folder, where only the maps stay; whether edges are left comes to the driver.
    """
    left = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    left = stage(left, "edges")
    found = None
    while found is None or not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("to")).union(left.select("b", "a"))
        near = both.groupBy("node").agg(F.min("to").alias("to"))
        hooks = stage(near.select("node", F.least("node", "to").alias("name")), "hooks")
        up = hooks.select(F.col("node").alias("name"), F.col("name").alias("above"))
        names = stage(hooks.join(up, "name").select("node", F.col("above").alias("name")), "names")
        ends = left
        for end in ("a", "b"):
            ends = ends.join(names.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("name", end)
        before, left = left, ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
        left = stage(left, "edges")
        discard(before, hooks)
        if found is None:
            found = names.withColumnRenamed("name", "component")
        else:
            step = names.select(F.col("node").alias("component"), "name")
            found = found.join(step, "component", "left").select("node", F.coalesce("name", "component").alias("component"))
    return found

"""Connected components of a graph in a DataFrame, by hooking to the least neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm.store import written


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) to (node, component): the least node reachable, for every node that has an edge.

    Null ends and loops are dropped; repeated edges count once; no edges give no rows. Each
    round is an aggregation and joins of the nodes that still have links between components, so no
    node's neighbours meet in one task beyond partial minima.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    edges = written(edges.distinct(), "edges")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")).select(F.col("a").alias("node"), "up")
        up = written(up, "up")
        while True:
            over = up.select(F.col("node").alias("up"), F.col("up").alias("over"))
            jumped = written(
                up.join(over, "up").select("node", F.col("over").alias("up"), (F.col("over") != F.col("up")).alias("moved")), "up"
            )
            up = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = up.select("node", F.col("up").alias("component"))
        else:
            after = up.select(F.col("node").alias("component"), "up")
            labels = written(
                labels.join(after, "component", "left").select("node", F.coalesce("up", "component").alias("component")), "labels"
            )
        a, b = up.select(F.col("node").alias("a"), F.col("up").alias("ua")), up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = written(
            edges.join(a, "a").join(b, "b").where("ua <> ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(),
            "edges",
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) if labels is None else labels


def merged_components(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """connected_components of the edges that gave parts(node, component) and of edges(a, b) together."""
    ends = [parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part")) for c in "ab"]
    between = edges.join(ends[0], "a", "left").join(ends[1], "b", "left")
    between = written(between.select("a", "b", F.coalesce("a_part", "a").alias("a_part"), F.coalesce("b_part", "b").alias("b_part")), "between")
    more = connected_components(between.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")))
    new = between.select(F.col("a").alias("node"), F.col("a_part").alias("component")).union(between.select("b", "b_part"))
    known = parts.union(new.where("node = component").distinct())  # a node that parts has is its own component only if parts says so
    known = known.dropDuplicates(["node"])
    further = more.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return known.join(further, "component", "left").select("node", F.coalesce("least", "component").alias("component"))

"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable over `edges` (a, b: long), for every node that has an edge.

    Each round lets every node point to its smallest neighbour, doubles the pointers until they end at nodes that point
    to themselves, and contracts the edges to those between different ends. Ends are at most half of the nodes, and a
    chain of n pointers takes log n doublings; edges never come to the driver. Nulls, loops and repeated edges have no
    effect; no edges give no rows.
    """
    e = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        step = cut_lineage(step)
        while True:
            far = cut_lineage(step.join(step.select(F.col("a").alias("m"), F.col("m").alias("mm")), "m").select("a", "m", "mm"))
            step = far.select("a", F.col("mm").alias("m"))
            if far.where("m <> mm").isEmpty():
                break
        to = step.select(F.col("a").alias("b"), F.col("m").alias("mb"))
        e = cut_lineage(e.join(step, "a").join(to, "b").select(F.col("m").alias("a"), F.col("mb").alias("b")).where("a <> b").distinct())
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("m").alias("component"))
        else:
            nxt = step.select(F.col("a").alias("component"), "m")
            labels = labels.join(nxt, "component", "left").select("node", F.coalesce("m", "component").alias("component"))
        labels = cut_lineage(labels)
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels

"""Connected components of links by contraction over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, broadcast_if_small

#: A row of two longs in a broadcast hash table.
NODE_BYTES = 160


def renamed(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """rows with the label in place of each node of a column that has one."""
    side = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return rows.join(side, F.col(column) == F.col("_node"), "left").withColumn(column, F.coalesce("_label", column)).drop("_node", "_label")


def ordered(links: DataFrame) -> DataFrame:
    """Distinct links a, b with a < b."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def components(links: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """node and label (the least node of its component) of n links a, b: links are contracted until none is left.

    Every node hangs on its least neighbour if that is less than itself; chains of such are halved until each node
    hangs on a root; links between roots remain for the next turn.
    """
    edges, done = scratch.written(ordered(links), "links"), None
    while n:
        hung = scratch.written(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "hung")
        while True:
            jumped = hung.withColumn("was", F.col("label"))
            jumped = scratch.written(renamed(jumped, "label", broadcast_if_small(hung, NODE_BYTES, n)), "hung")
            hung = jumped.select("node", "label")
            if jumped.where("label <> was").isEmpty():
                break
        side = broadcast_if_small(hung, NODE_BYTES, n)
        done = hung if done is None else scratch.written(renamed(done, "label", side).unionByName(hung), "labels")
        edges = scratch.written(ordered(renamed(renamed(edges, "a", side), "b", side)), "links")
        n = edges.count()
    return scratch.written(done.unionByName(done.select(F.col("label").alias("node"), "label").distinct()), "labels")


def joined(labels: DataFrame | None, links: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """labels, of classes found so far, after n more links between nodes."""
    if labels is None:
        return components(links, n, scratch)
    edges = scratch.written(ordered(renamed(renamed(links.select("a", "b"), "a", labels), "b", labels)), "links")
    if not (m := edges.count()):
        return labels
    new = components(edges, m, scratch)
    return scratch.written(renamed(labels, "label", broadcast_if_small(new, NODE_BYTES, 2 * m)).unionByName(new.join(labels.select("node"), "node", "left_anti")), "labels")

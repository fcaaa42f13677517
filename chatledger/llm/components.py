"""Connected components by alternating large and small stars, as joins and minima.

Each round is a few shuffles of the edge table, which is written to the shared folder; hubs cost a
minimum that combines before its shuffle and a join that splits skewed keys.  Rounds grow with the
logarithm of the largest component.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import materialize

MAX_ROUNDS = 60


def star_edges(edges: np.ndarray, nodes: int) -> np.ndarray:
    """Smallest node reachable from each node, for one block's edges (pairs of node numbers)."""
    label = np.arange(nodes)
    if not len(edges):
        return label
    a, b = edges[:, 0], edges[:, 1]
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while (jump := new[new] < new).any():
            new = np.where(jump, new[new], new)
        if (new == label).all():
            return label
        label = new


def _distinct(edges: DataFrame) -> DataFrame:
    """Distinct edges after an exchange of their own: by columns, Spark would do with the exchange of the
    join before, and could then not split a hub's partition."""
    return edges.select(F.struct("v", "u").alias("e")).distinct().select("e.*")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    Self loops and repeated edges are ignored; a node without an edge does not appear.
    """
    stars = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    for _ in range(MAX_ROUNDS):
        # Large star: every larger neighbour of a node hangs on the node's smallest neighbour.
        both = stars.union(stars.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # Written, like what else is joined here: Spark splits a skewed key only between plain exchanges.
        least = materialize(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m")))
        large = stars.withColumnRenamed("v", "w").join(least.withColumnRenamed("v", "u"), "u").select(F.col("w").alias("v"), F.col("m").alias("u"))
        large = materialize(_distinct(large))
        # Small star: every smaller neighbour of a node, and the node, hang on the smallest of them.
        down = materialize(large.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")))
        moved = large.join(down.where("n > 1").select("v", "m"), "v").where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        after = materialize(_distinct(down.select("v", F.col("m").alias("u")).union(moved)))
        # Settled: each node hangs on one smaller node that hangs on none.
        hung = after.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        loose = after.join(hung.select(F.col("v").alias("u")), "u", "left_semi").select(F.lit(1)).union(hung.where("n > 1").select(F.lit(1)))
        stars = after
        if loose.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("u").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)

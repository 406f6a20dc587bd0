"""Connected components of an edge table by contraction.

In every round each node takes the least of itself and its neighbours as its parent. A
parent is always smaller, so the parents form trees; they are flattened by pointer
doubling, and each edge is replaced by an edge between the roots of its ends. Loops and
repeated edges go, so the table shrinks from round to round, until none is left. The
root that remains of a component is its least node, which never has a parent.

Nodes and links stay distributed; what a round leaves is written to the shared
checkpoint folder. The least neighbour is combined before the shuffle, and a node with a
great many links is split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import write_cut


def _flatten(parent: DataFrame) -> DataFrame:
    """(node, root) from (node, root), where root may itself have a root."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
        parent = write_cut(parent.join(up, "root", "left").select(
            "node", F.coalesce("up", "root").alias("root"),
            (F.coalesce("up", "root") != F.col("root")).alias("moved")), "roots")
        if parent.where("moved").isEmpty():
            return parent.select("node", "root")
        parent = parent.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, component): the least node reachable. Nodes
    without an edge are absent. An empty table gives an empty one; null ends,
    loops and repeated edges change nothing."""
    # The greater end first; null ends compare as null and go.
    left = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    left, known = write_cut(left, "edges"), None
    while True:
        # Every greater end takes its least neighbour; other nodes are their own root.
        parent = left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        lone = left.select(F.col("b").alias("node"), F.col("b").alias("root"))
        root = _flatten(parent.union(lone).groupBy("node").agg(F.min("root").alias("root")))
        if known is None:
            known = root
        else:
            step = root.select(F.col("node").alias("root"), F.col("root").alias("up"))
            known = write_cut(known.join(step, "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")), "known")
        ends = [root.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"]
        # A parent edge lies within a tree and is gone at once.
        moved = left.join(ends[0], "a").where("ra <> b").join(ends[1], "b").where("ra <> rb")
        left = write_cut(moved.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))
                         .distinct(), "edges")
        if left.isEmpty():
            return known.select("node", F.col("root").alias("component"))

"""Connected components of a link table, as Spark joins; nothing is collected."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_at, unstage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns ``a`` and ``b``,
    long): component is the smallest node reachable. Nulls are not nodes.

    Each round hooks a node and its parent to the smallest grandparent among
    the node's neighbours and halves the path to the root; a round is written
    to the shared folder, which cuts lineage and survives lost executors. The
    number of rounds grows with the logarithm of the longest path.
    """
    spark = links.sparkSession
    links = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges, edges_at = stage_at(both, "links")
    start = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("parent"))
    state, state_at = stage_at(start.withColumn("moved", F.lit(True)), "components")
    while state.where("moved").limit(1).count():
        up = state.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        near = state.select("node", "parent").join(up.hint("merge"), "parent").select("node", "parent", "grand")
        near, near_at = stage_at(near, "parents")
        least = (
            edges.join(near.select(F.col("node").alias("b"), "grand").hint("merge"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("least"))
        )
        hooked = near.join(least.hint("merge"), "node")
        offers = hooked.select(
            F.explode(F.array(
                F.struct(F.col("node").alias("node"), F.least("least", "grand").alias("to")),
                F.struct(F.col("parent").alias("node"), F.least("least", "grand").alias("to")),
            )).alias("o")
        ).select("o.*")
        best = offers.groupBy("node").agg(F.min("to").alias("to"))
        after = near.join(best.hint("merge"), "node").select(
            "node", F.least("parent", "to").alias("parent"), (F.col("to") < F.col("parent")).alias("moved")
        )
        new, new_at = stage_at(after, "components")
        for path in (state_at, near_at):
            unstage(spark, path)
        state, state_at = new, new_at
    unstage(spark, edges_at)
    return state.select("node", F.col("parent").alias("component"))


class Groups:
    """Union of index pairs inside one task: ``root`` holds each index's smallest partner."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _flatten(self) -> None:
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return
            self.root = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            self._flatten()

"""Connected components of a link table by alternating star contractions.

Each round is a few joins and partial aggregates on the links alone; its result is
written to the shared checkpoint folder (``materialize``), which cuts the lineage and
survives lost executors. A hub with very many links is pre-aggregated before the
shuffle (its minimum) and split by the skew join of adaptive execution (its links).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them.
    ``links`` have a > b."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(low, "a").where("b > low").select(F.col("b").alias("a"), "low")
    return moved.unionByName(low).select("a", F.col("low").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of one orderable
    type): root is the smallest node reachable. Loops and repeated links do no harm."""
    state = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
        state = materialize(_small_star(_large_star(state)), "links")
    roots = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("root"))
                             .distinct())


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each node's smallest known companion; at first itself) after the links
    a[i] - b[i] are added."""
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        for ends in (a, b):
            np.minimum.at(after, label[ends], low)
            np.minimum.at(after, ends, low)
        after = after[after]
        while not np.array_equal(after, after[after]):
            after = after[after]
        if np.array_equal(after, label):
            return label
        label = after

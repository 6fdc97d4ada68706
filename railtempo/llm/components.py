"""Connected components of a graph given as edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtempo.llm.common import cut


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each node's least known partner, a root of itself) after linking a[i] with b[i]."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := labels[labels], labels):
            labels = up


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of an edge (a, b) with the least node it can reach.

    Alternates two steps until nothing changes, a number of rounds that grows with the logarithm of the graph: each
    node links its greater neighbours to its least one, then its lesser ones. Every round is a partial aggregation and
    a join, checkpointed; a node with very many neighbours is split by the skew join.
    """
    edges = cut(_directed(edges))
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = _directed(both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = cut(_directed(small))
        now = _state(edges)
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from the greater node to the lesser."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    hashes = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(hashes), F.sum(hashes % (1 << 32))).first())

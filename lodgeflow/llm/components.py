"""Connected components of an undirected graph, and a union-find for the links of one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import checkpointed


class Union:
    """Components of ``n`` nodes under links that arrive in arrays; the root is the smallest node."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return self.parent
            self.parent = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            root = self.roots()
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), a component being its smallest node.

    Alternates the large-star and small-star steps: each hangs the neighbours of a node under
    the smallest of them, so that chains shrink by halves and every tree ends as a star. Minima
    are combined before the shuffle, each step is checkpointed, and nothing reaches the driver
    but a count and a checksum of the edges. Null ends and self links are ignored; an empty
    input gives an empty result."""
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = checkpointed(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        edges = checkpointed(small)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components: by contraction on tables, and of the rows of one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.staging import staged


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each node of ``links`` (``a``, ``b``) is connected with.

    Returns ``node`` and ``root``, for linked nodes only. Each round points every node at
    its smallest neighbour if that is smaller, follows the pointers to their ends and
    goes on with the links between different ends, so the rounds grow with the logarithm
    of the nodes. Links may repeat, run both ways, or join a node with itself. Every
    step is a join or an aggregate on tables in the shared folder.
    """
    links = staged(links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b"), "links")
    found = None
    while True:
        ways = links.union(links.select("b", "a"))
        ends = ways.groupBy("a").agg(F.min("b").alias("low"))
        low = F.least("a", "low").alias("root")
        ends = staged(ends.select(F.col("a").alias("node"), low), "ends")
        ends = followed(ends)
        found = ends if found is None else staged(renamed(found, ends), "found")
        first, second = renaming(ends, "a"), renaming(ends, "b")
        between = links.join(first, "a").join(second, "b").select("_a", "_b").where("_a <> _b")
        links = staged(between.toDF("a", "b").distinct(), "links")
        if links.isEmpty():
            return found


def renaming(ends: DataFrame, name: str) -> DataFrame:
    return ends.select(F.col("node").alias(name), F.col("root").alias(f"_{name}"))


def renamed(found: DataFrame, ends: DataFrame) -> DataFrame:
    """``found`` with the roots of ``ends`` for the nodes that it ends in."""
    later = ends.select(F.col("node").alias("root"), F.col("root").alias("_later"))
    return found.join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("root"))


def followed(ends: DataFrame) -> DataFrame:
    """Every node with the end of its chain of pointers; each step doubles what is followed."""
    while True:
        further = ends.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        moved = (F.col("_next") != F.col("root")).alias("_moved")
        followed_once = ends.join(further, "root").select("node", F.col("_next").alias("root"), moved)
        step = staged(followed_once, "ends")
        moved = not step.where("_moved").isEmpty()
        ends = step.drop("_moved")
        if not moved:
            return ends


class Forest:
    """Components of places in sorted fingerprints, labelled with their first place."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.mixed = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                further = self.root[self.root]
                if (further == self.root).all():
                    break
                self.root = further
        # Places up to each one where the label changes: a range without a change is of one component.
        self.mixed = np.concatenate(([0], np.cumsum(self.root[1:] != self.root[:-1])))

    def settled(self, lo_a, hi_a, lo_b, hi_b) -> np.ndarray:
        whole = (self.mixed[hi_a - 1] == self.mixed[lo_a]) & (self.mixed[hi_b - 1] == self.mixed[lo_b])
        return whole & (self.root[lo_a] == self.root[lo_b])

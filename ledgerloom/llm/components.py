"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the links ``a``, ``b`` (long): the smallest node reachable.

    Each round joins every node's neighbours to the smallest one, first those above the node, then
    those below, until nothing changes; the number of rounds grows with the logarithm of the length
    of the longest chain. The smallest neighbour is combined in each task before the exchange, and
    is written before it is joined, so a node with many links is a join side Spark can split. Links
    of a node to itself and links with a null are no links. An empty table has no components.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    valid = links.filter("a is not null and b is not null and a <> b")
    stars = kept(valid.select(a.alias("a"), b.alias("b")).distinct())
    state = _state(stars)
    while state[0]:
        # No step makes more links than it is given.
        stars = _small_star(_large_star(stars, state[0]), state[0])
        before, state = state, _state(stars)
        if state == before:
            break
    tops = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(tops)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())


def _lowest(links: DataFrame, number: int) -> DataFrame:
    """The smallest neighbour below each node that has one."""
    return kept(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")), number)


def _large_star(links: DataFrame, number: int) -> DataFrame:
    """Join the larger neighbours of each node to the smallest of its neighbours and itself."""
    lowest = _lowest(links, number)
    up = links.join(lowest, links["b"] == lowest["node"], "left")
    return kept(up.select("a", F.coalesce("low", "b").alias("b")).distinct(), number)


def _small_star(links: DataFrame, number: int) -> DataFrame:
    """Join the smaller neighbours of each node, and itself, to the smallest of them."""
    lowest = _lowest(links, number)
    moved = links.join(lowest, links["a"] == lowest["node"]).select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = lowest.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return kept(moved.filter("a <> b").union(own).distinct(), number)


def merge(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Unite the sets of ``left[i]`` and ``right[i]`` in a forest whose roots are smallest members."""
    while len(left):
        _flatten(parent)
        left, right = parent[left], parent[right]
        apart = left != right
        left, right = left[apart], right[apart]
        np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))
    _flatten(parent)


def _flatten(parent: np.ndarray) -> None:
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            return
        parent[:] = above

"""Connected components of an undirected graph whose nodes are 64-bit integers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import materialize


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of the edges a[i] - b[i]; roots are left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        ru, rv = root[u], root[v]
        differ = ru != rv
        if not differ.any():
            break
        np.minimum.at(root, np.maximum(ru, rv)[differ], np.minimum(ru, rv)[differ])
        while not np.array_equal(step := root[root], root):
            root = step
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges -> ``(node, root)`` for every node that is not the smallest of its component.

    Large-star / small-star rounds until the edges no longer change: every
    aggregation combines before its shuffle, a hub is never gathered into one
    row, and each round is one table in the shared checkpoint folder.  Loops
    and repeated edges are allowed; no edges give no rows.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    now, before = materialize(now, "components"), None
    while True:
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == before or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now, before = materialize(_small_star(_large_star(now).distinct()).distinct(), "components"), mark

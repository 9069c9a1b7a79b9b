"""Connected components of links, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from carryall.sources.tables import pin


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links a > b."""
    # Each node with more than itself: all larger neighbours go to its least one.
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # All smaller neighbours, and the node itself, go to its least one.
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of `links` (a, b); component: its least node.

    Loops, repeated links and either direction are welcome; nulls link nothing. No
    links give no rows. Every round is written to the shared folder, and the loop
    ends when a round changes nothing: every node then hangs on its component's
    least node. Rounds grow with the logarithm of the longest chain.
    """
    links = pin(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    sign = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = links.agg(sign).first()
    while before[0][0]:
        links = pin(_round(links), "stars")
        after = links.agg(sign).first()
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The root of each node in a forest of parents."""
    top = parent[nodes]
    while True:
        above = parent[top]
        if np.array_equal(above, top):
            return top
        top = above


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a[k] and b[k] for all k; a larger root hangs on a smaller one."""
    while True:
        a, b = roots(parent, a), roots(parent, b)
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack([np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart])]), axis=1)
        a, b = pairs
        np.minimum.at(parent, a, b)

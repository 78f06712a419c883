"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.shared import send_by_value, settled

send_by_value(__name__)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of `n` nodes over links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every node's larger (or, if not `large`, smaller) neighbours to the
    smallest of its neighbourhood.

    The smallest are written before the join, so that a node with very many
    links is a skewed key which the adaptive planner can split.
    """
    if large:
        seen = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges
    least = settled(seen.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("x"), F.least("u", "w").alias("w")))
    met = seen.join(least, F.col("u") == F.col("x"))
    if large:
        return settled(met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("w").alias("v")).filter("u <> v"))
    out = met.select(F.col("v").alias("u"), F.col("w").alias("v")).unionAll(
        least.select(F.col("x").alias("u"), F.col("w").alias("v"))
    )
    return settled(out.filter("u <> v").distinct())


def _all_stars(edges: DataFrame) -> bool:
    """Has every node one link up at most, and none both up and down?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) of every node of `links` (u, v), where a component is
    named by its smallest node.

    Alternates large and small stars until every component is a star around its
    smallest node; every round works on at most as many links as there were
    and is written to the shared folder, so nothing depends on the executors
    that made it.
    """
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = settled(links.filter("u <> v").select(high, low).distinct())
    for _ in range(rounds):
        if _all_stars(edges):
            break
        edges = _star(_star(edges, large=True), large=False)
    else:
        raise RuntimeError("the components have not settled")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

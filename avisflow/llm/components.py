"""Distributed connected components: alternating large-star and small-star steps.

Every step maps edges onto the smallest neighbour of their end points; after the last one the
edges are stars around the smallest node of each component. Minima are aggregated before the
shuffle and written as tables, so the join that hands them back to the edges stands on two plain
exchanges and Spark can split a hub's rows. Nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avisflow.llm.common import table


def local_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of one task as (node, smallest node reachable by them), roots left out."""
    if len(u) == 0:
        return u, v
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(root, before):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over distinct edges (u > v)."""
    if small:
        sides = edges
    else:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = table(sides.groupBy("u").agg(F.min("v").alias("m"))
                  .select(F.col("u").alias("c"), F.least("u", "m").alias("m")), "star-min")
    joined = sides.join(least, sides.u == least.c)
    if small:  # neighbours below u, and u itself, hang on the smallest of them
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    else:  # neighbours above u hang on the smallest node around u
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return table(out.where("u <> v").distinct(), "star-edges")


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs, any order, repeats and loops allowed -> (node, root) for every node with
    an edge to another one; root is the smallest node of its component. No edges: no rows."""
    cur = table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "cc-edges")
    seen = None
    while True:
        now = cur.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now["n"] == 0 or (now["n"], now["s"]) == seen:
            break
        seen = (now["n"], now["s"])
        cur = _star(_star(cur, small=False), small=True)
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

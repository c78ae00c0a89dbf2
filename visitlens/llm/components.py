"""Connected components of a graph given as edges, by alternating star contractions.

Every round links each node to the smallest id among its neighbours (large star), then
links the smaller neighbours among each other (small star), until every edge leads to the
smallest id of its component.  Rounds grow with the logarithm of the graph's size.  Each
round is two pre-aggregated groupings and joins on edges written to the shared folder; one
more grouping tells whether another is needed, and the driver sees that answer alone.
Edges that come later are taken to the components they join (``merged``), so no round goes
over the earlier ones again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _only_stars(edges: DataFrame) -> bool:
    """Whether every larger end ``u`` of the (distinct) edges is an end of that one edge alone."""
    ends = edges.select("u", F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    tied = ends.groupBy("u").agg(F.sum("up").alias("up"), F.count("*").alias("edges"))
    return tied.filter("up > 0 AND edges > 1").isEmpty()


def spanning_labels(ids: np.ndarray, left: np.ndarray, right: np.ndarray, links: np.ndarray) -> np.ndarray:
    """For every id the smallest one it reaches when ``links[i, j]`` joins rows ``left[i]``
    and ``right[j]``: edges (id, label) connect what the links connect, one per row at most."""
    label = ids.copy()
    some, other = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
    inner = links[np.ix_(some, other)]
    i, j, far = left[some], right[other], np.iinfo(np.int64).max
    while inner.size:
        before = label.copy()
        label[i] = np.minimum(label[i], np.where(inner, label[j][None, :], far).min(1))
        label[j] = np.minimum(label[j], np.where(inner, label[i][:, None], far).min(0))
        if (label == before).all():
            break
    return label


def star_edges(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with an edge that is not the smallest of its
    component; component is the smallest id reachable.

    Null ends, loops and repeated edges are ignored; no edges give no rows.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = written(edges.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct(), "edges")
    while not _only_stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = written(small.filter("u <> v").distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def merged(stars: DataFrame, edges: DataFrame) -> DataFrame:
    """``star_edges`` of ``stars`` (what it returned for other edges) and the edges (a, b): only
    the edges between components go through rounds."""
    if edges.isEmpty():
        return stars
    for end in ("a", "b"):
        found = stars.select(F.col("node").alias(end), F.col("component").alias("root"))
        edges = edges.join(found, end, "left").withColumn(end, F.coalesce("root", end)).select("a", "b")
    roots = star_edges(edges)
    if roots.isEmpty():
        return stars
    renamed = roots.select(F.col("node").alias("component"), F.col("component").alias("root"))
    moved = stars.join(renamed, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return written(moved.union(roots), "merged")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with an edge: ``star_edges`` and the smallest ids themselves."""
    stars = star_edges(edges, a, b)
    roots = stars.select("component").distinct()
    return stars.union(roots.select("component", "component"))

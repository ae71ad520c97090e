"""Connected components of an edge table, as Spark joins and groupings.

Alternates the large-star and small-star steps of Kiveris et al., "Connected Components in
MapReduce and Beyond" (2014): every node hooks onto the smallest neighbour until each
component is a star around its smallest node. Only edge counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    """Written, so that its join with the edges shuffles both sides itself and may split a hub."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _smallest_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest_neighbour(down)
    rest = down.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v")))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)`` that is not its component's smallest.

    ``u`` and ``v`` are comparable keys; self loops, repeated and reversed edges are fine, an
    edge with a null end is ignored. A node missing from the result is its own component
    id. Each round is written to the shared folder. The number of rounds grows with the
    logarithm of the longest chain, and a hub's edges are combined before each shuffle.
    """
    edges = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)).distinct(), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

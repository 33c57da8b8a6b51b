"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps: each step groups the edges by one end and
links that end's neighbours to the smallest of them. A node's edges are never gathered
in one row: its smallest neighbour is an aggregate, joined back to the edges. The edges
end as stars around the smallest node of each component, after about log(n) steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that the edges ``a``, ``b`` connect each node with.

    Nodes without edges do not occur. Loops and repeated edges do not matter.
    """
    current = stored(_from_large(edges.where("a <> b")), "components")
    state = _state(current)
    while True:
        current = stored(_small_star(_large_star(current)), "components")
        before, state = state, _state(current)
        if state == before:
            break
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(roots).distinct()


def _from_large(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and practically only for those."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a")))
    return tuple(row.first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m"))
    linked = both.join(smallest, "a").where("b > a")
    return _from_large(linked.select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(smallest, "a")
    links = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        smallest.select("a", F.col("m").alias("b"))
    )
    return _from_large(links.where("a <> b"))

"""Connected components of a graph given as a table of edges, by alternating stars.

Each round hooks every node's larger neighbours, then its smaller ones, to the smallest node it knows. It keeps
the components as they are and ends as one star around the smallest node of each. The number of rounds grows with
the logarithm of the graph, and no round makes more edges than it got. Edges are partitioned by node and joined to
partial minima, so a node with any share of the edges can be split. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.sources.tables import materialize

_MOST_ROUNDS = 100


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node in ``edges`` (a, b); the component is its smallest node.

    Direction and repetition of edges do not matter. Edges with a null end are ignored; an edge from a node to
    itself makes that node known. An empty table gives an empty table.
    """
    known = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    loops = known.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    stars = known.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = materialize(stars, "edges")
    before = _mark(stars)
    if before[0]:
        for _ in range(_MOST_ROUNDS):
            stars = materialize(_small_star(materialize(_large_star(stars), "large")), "small")
            now = _mark(stars)
            if now == before:
                break
            before = now
        else:
            raise RuntimeError(f"components not found in {_MOST_ROUNDS} rounds")
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).union(loops).distinct()
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    # a node with an edge to itself may be a leaf too
    return leaves.union(centres).groupBy("node").agg(F.min("component").alias("component"))


def _mark(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to the smallest of the node and its neighbours."""
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("mid")).agg(F.min("v").alias("least"))
    least = least.select("mid", F.least("mid", "least").alias("least"))
    return stars.join(least, F.col("v") == F.col("mid")).select("u", F.col("least").alias("v"))


def _small_star(stars: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of these."""
    least = stars.groupBy(F.col("u").alias("mid")).agg(F.min("v").alias("least"))
    moved = stars.join(least, F.col("u") == F.col("mid")).where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select(F.col("mid").alias("u"), F.col("least").alias("v"))).distinct()

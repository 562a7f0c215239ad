"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _hop(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Replace ``column`` by its parent; nodes without one stay."""
    p = parent.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    return (df.join(p, df[column] == F.col("_node"), "left")
            .withColumn(column, F.coalesce("_parent", column)).drop("_node", "_parent"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: long);
    component is the smallest node that is reachable.

    Contraction: each node points to its smallest neighbour, the pointers are
    doubled until they stand, the edges move to the pointed-to nodes, and
    what is left between different nodes goes into the next round.  A node
    that is not the smallest of its neighbourhood disappears, so each round
    at least halves the nodes that still have edges; pointers double, so a
    chain takes as many steps as the logarithm of its length.  Every table is
    written, so lineage stays one round deep.  Self-loops and edges with a
    null end are ignored; an empty input gives an empty result.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                    .withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
                        .where("parent < node"), "parents")
        while True:
            # one doubling: roots have no row, so a pointer to a root stays
            onward = parent.select(F.col("node").alias("_node"), F.col("parent").alias("_next"))
            doubled = stored(parent.join(onward, F.col("parent") == F.col("_node"), "left")
                             .select("node", F.coalesce("_next", "parent").alias("parent"),
                                     F.col("_next").isNotNull().alias("moved")), "parents")
            parent = doubled.select("node", "parent")
            if doubled.where("moved").isEmpty():
                break
        moved = _hop(_hop(edges, "a", parent), "b", parent).where("a <> b")
        edges = stored(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .distinct(), "edges")
        labels = stored(_hop(labels, "component", parent), "labels")
    return labels

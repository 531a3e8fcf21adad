"""Connected components of a table of links, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import opaque, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each end of ``links`` (a, b): the smallest node reachable.

    Each round hooks every node to its smallest neighbour, shortens the chains
    by pointer jumping and contracts the links; rounds fall with the logarithm
    of the component size. Minima combine before the shuffle, so a node with
    very many links is no hot task; every round is cut by a stored table.
    """
    out = None
    edges = stored(links.select("a", "b").filter("a != b").distinct(), "links")
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                        .select("node", F.least("node", "b").alias("root")), "parents")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = stored(parent.join(up, "root").select("node", F.col("above").alias("root"),
                                                           (F.col("above") != F.col("root")).alias("moved")), "jumps")
            parent = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        if out is None:
            out = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
            out = stored(out.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "roots")
        ends = edges
        for end in ("a", "b"):
            up = parent.select(opaque(F.col("node")).alias("_node"), F.col("root").alias("_root"))
            ends = ends.join(up, opaque(F.col(end)) == F.col("_node")).drop("_node", end).withColumnRenamed("_root", end)
        edges = stored(ends.filter("a != b").distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0) if out is None else out

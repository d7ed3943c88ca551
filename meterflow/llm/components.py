"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.session import stage


def connected_components(edges: DataFrame, folder: str) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``edges`` (columns ``a, b``).

    Each round every node takes its smallest neighbour's name, if that is smaller, and edges are
    rewritten to the new names; loops and repeats go. A chain halves per round and a star is done in
    one. Every round's tables are written, so lineage stays short; a hub's edges meet only in a minimum.
    """
    names = None
    edges = stage(edges.filter("a <> b").distinct(), folder, "edges0")
    level = 0
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
        )
        least = stage(
            both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("name")),
            folder, f"least{level}",
        )
        if names is None:
            names = least.withColumnRenamed("name", "component")
        else:
            moved = least.select(F.col("node").alias("component"), "name")
            names = names.join(moved, "component", "left").select(
                "node", F.coalesce("name", "component").alias("component")
            )
            names = stage(names, folder, f"names{level}")
        of_a = least.select(F.col("node").alias("a"), F.col("name").alias("_a"))
        of_b = least.select(F.col("node").alias("b"), F.col("name").alias("_b"))
        renamed = edges.join(of_a, "a").select("_a", "b").join(of_b, "b").filter("_a <> _b")
        level += 1
        edges = stage(
            renamed.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            folder, f"edges{level}",
        )
    if names is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return names

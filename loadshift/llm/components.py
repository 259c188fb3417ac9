"""Connected components of an undirected graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadshift.llm.shared import is_empty, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: every node of `edges` (two bigint columns) with the smallest node of its component.

    Each round every node takes its smallest neighbour, and edges are carried over to the taken nodes, until none is left. Minima are
    partial aggregates, so a node with very many neighbours does not gather them. Rounds grow with the logarithm of the component.
    Loops and repeated edges do no harm; no edges give an empty table.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = stored(both.union(both.select("y", "x")).distinct(), "edges")
    labels = both.select(F.col("x").alias("node"), F.col("x").alias("root")).distinct()
    both = both.filter("x <> y")
    while not is_empty(both):
        up = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("up"))
        # One step further up at once: where a node's neighbour takes another node, it takes that one too.
        up = stored(up, "up")
        further = up.select(F.col("x").alias("up"), F.col("up").alias("next"))
        up = stored(up.join(further, "up", "left").select("x", F.least("up", "next").alias("up")), "up")
        labels = stored(labels.join(up.withColumnRenamed("x", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root")), "labels")
        left = both.join(up, "x").select(F.col("up").alias("x"), "y")
        right = left.join(up.select(F.col("x").alias("y"), F.col("up").alias("z")), "y")
        both = stored(right.select("x", F.col("z").alias("y")).filter("x <> y").distinct(), "edges")
    return labels

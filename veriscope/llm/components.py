"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of an edge table ``a, b``: two nodes have equal labels if a path joins them.

    Each round sends a node to its smallest neighbour, follows that pointer once more, and keeps one edge between
    what is still apart; a star is done in one round, and a path of n nodes in about log n.  A node with very many edges
    is one row on the pointers' side of each join, and minima are taken before the shuffle.  Rounds are written tables.
    """
    edges = written(edges.filter("a <> b").select("a", "b").distinct())
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = written(labels.withColumn("label", F.col("node")))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        near = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")))
        far = near.select(F.col("a").alias("up"), F.col("up").alias("top"))
        up = written(near.join(far, "up").select(F.col("a").alias("label"), "top"))
        labels = written(labels.join(up, "label", "left").select("node", F.coalesce("top", "label").alias("label")))
        ends = edges.join(up.select(F.col("label").alias("a"), F.col("top").alias("x")), "a")
        ends = ends.join(up.select(F.col("label").alias("b"), F.col("top").alias("y")), "b")
        edges = written(ends.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return labels

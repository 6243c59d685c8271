"""Connected components of a graph given as links, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, join_small, materialize


def components(links: DataFrame) -> DataFrame:
    """One row (node, label) per node of the links (a, b): nodes have one label exactly if they are connected.

    Each round every node goes to the neighbour (or itself) of least hash, and
    the links move along; in expectation a constant share of the nodes goes.
    Neighbourhoods are only ever reduced to a minimum, so a node with very many
    links is no large group. Each round's tables are written to the shared folder.
    """
    edges = materialize(links.where("a <> b").select("a", "b").distinct(), "cc-links")
    labels = None
    while edges.limit(1).count():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("x"))
        least = both.groupBy("u").agg(F.min(rank("v")).alias("m"), F.count("*").alias("n"))
        moved = materialize(least.select("u", F.least(rank("u"), F.col("m"))["x"].alias("to"), "n"), "cc-moves")
        total = max(1, edges.count())
        left = join_counted(edges, moved.select(F.col("u").alias("a"), F.col("to").alias("to_a"), "n"), ["a"], "n", total).drop("n")
        left = join_counted(left, moved.select(F.col("u").alias("b"), F.col("to").alias("to_b"), "n"), ["b"], "n", total)
        following = left.where("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        step = moved.select(F.col("u").alias("label"), "to")
        if labels is None:
            labels = step.select(F.col("label").alias("node"), F.col("to").alias("label"))
        else:
            labels = join_small(labels, step, ["label"]).select("node", F.coalesce("to", "label").alias("label"))
        labels = materialize(labels, "cc-labels")
        edges = materialize(following.distinct(), "cc-links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels

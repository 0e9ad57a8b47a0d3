"""Connected components of a graph given as an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(a long, b long) -> (node, label): the label is the least node reachable.

    Each round points every node at its least neighbour (a minimum, combined
    before the shuffle, so a node with very many edges is no hot spot), follows
    that pointer once more, and contracts the edges; rounds go on until no edge is
    left. Pointers lead to ever smaller nodes, so the label is the least of all.
    """
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .filter("a != b").distinct(), "edges")
    labels = materialise(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                         .select("node", F.col("node").alias("label")), "labels")
    while edges.limit(1).count():
        both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a"))
        point = both.groupBy("x").agg(F.least(F.first("x"), F.min("y")).alias("p"))
        point = materialise(point, "pointers")
        jump = point.select(F.col("x").alias("jx"), F.col("p").alias("jp"))
        point = materialise(point.join(jump, point["p"] == jump["jx"])
                            .select("x", F.col("jp").alias("p")), "jumped")
        to = lambda name: point.select(F.col("x").alias(f"{name}_at"), F.col("p").alias(f"{name}_to"))
        labels = materialise(labels.join(to("l"), F.col("label") == F.col("l_at"), "left")
                             .select("node", F.coalesce("l_to", "label").alias("label")), "labels")
        edges = (edges.join(to("a"), F.col("a") == F.col("a_at")).join(to("b"), F.col("b") == F.col("b_at"))
                 .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
                 .filter("a != b").distinct())
        edges = materialise(edges, "edges")
    return labels

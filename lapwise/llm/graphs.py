"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.session import stored


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` of every node of the undirected ``edges`` (``a, b``).

    Each round moves every node to its smallest neighbour and contracts the edges, until
    none is left; the moves are then chained.  Node ids should be hashes: in random order a
    round removes a constant share of the nodes, whatever the graph looks like.  Minima are
    combined before they are shuffled, and joins on a hub split where it is skewed.
    """
    moves = []
    edges = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{label}-edges",
    )
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = stored(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("to")),
            f"{label}-moves",
        )
        moves.append(move)
        ends = edges.join(move.toDF("a", "x"), "a").join(move.toDF("b", "y"), "b")
        edges = stored(
            ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            f"{label}-edges",
        )
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[-1].toDF("node", "root")
    for move in reversed(moves[:-1]):
        later = roots.withColumnRenamed("node", "to")
        roots = stored(
            move.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root")),
            f"{label}-roots",
        )
    return roots

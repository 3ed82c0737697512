"""Connected components by alternating stars, over edges of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import use_checkpoints


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on the least node it sees. Edges are (a, b) with a > b.

    The least neighbour comes from an aggregate with partial sums before its shuffle, and a hub's rows
    are dealt by a plain join, which adaptive execution can split.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    hung = both.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node of the component.

    The rounds are few (their number grows with the logarithm of the longest chain) and each is
    checkpointed to the shared folder, so a lost executor costs at most one round.
    """
    use_checkpoints(edges.sparkSession)
    least, most = F.least("a", "b"), F.greatest("a", "b")
    edges = edges.where("a <> b").select(most.alias("a"), least.alias("b")).distinct().checkpoint()
    state = None
    while True:
        found = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if found["n"] == 0 or tuple(found) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = tuple(found)
        edges = _star(_star(edges, large=True), large=False).checkpoint()

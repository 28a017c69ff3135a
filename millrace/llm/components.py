"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """Node and root for every node of an edge between different nodes (columns a, b).

    Random contraction: in each round every node hooks onto its neighbour with the smallest
    random rank, if that is below its own; then nodes are replaced by what they hooked
    onto, and loops and repeated edges go. A fixed share of the nodes is expected to go in every
    round, whatever the shape of the graph. Minima per node have a partial step, so a
    node with very many edges makes no hot task. Every round is a written table.
    """
    pairs = edges.select("a", "b").where("a <> b")
    pairs = materialise(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels, rounds = None, 0
    while not pairs.isEmpty():
        def rank(node: str, salt: int = rounds):
            return F.struct(F.xxhash64(F.lit(salt), node).alias("rank"), F.col(node).alias("node"))

        ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(
            ends.groupBy("a").agg(F.min(rank("b")).alias("best"))
            .select(F.col("a").alias("node"), F.least("best", rank("a"))["node"].alias("root")), "hooks")
        for end in ("a", "b"):
            pairs = pairs.join(hooks.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("root", end)
        pairs = materialise(
            pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if labels is None:
            labels = hooks
        else:
            step = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = materialise(
                labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        rounds += 1
    if labels is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels

"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import stash


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id on an edge; edges: columns a and b.

    Randomised contraction: in each round every id joins the neighbour that comes first in that round's hashed order, if it comes
    before itself; the edges between what has joined go on to the next round. Whatever the graph's shape, a constant share of
    the ids is expected to go each round. Rounds are written to the shared folder, so a lost executor costs one round at most.
    """
    e = stash(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels, turn = None, 0
    while True:
        turn += 1
        placed = lambda c, k=turn: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("id"))
        sides = e.select(F.col("a").alias("id"), placed("b").alias("near")).unionByName(e.select(F.col("b").alias("id"), placed("a").alias("near")))
        first = sides.groupBy("id").agg(F.min("near").alias("near")).select("id", F.least("near", placed("id"))["id"].alias("to"))
        first = stash(first)
        if labels is None:
            labels = first.select("id", F.col("to").alias("label"))
        else:
            labels = stash(labels.join(first.select(F.col("id").alias("_id"), "to"), F.col("label") == F.col("_id"), "left").select("id", F.coalesce("to", "label").alias("label")))
        at = lambda c: first.select(F.col("id").alias(c), F.col("to").alias(f"{c}_to"))
        left = e.join(at("a"), "a").join(at("b"), "b").where("a_to <> b_to")
        e = stash(left.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
        if not e.take(1):
            least = labels.groupBy("label").agg(F.min("id").alias("component"))
            return labels.join(least, "label").select("id", "component")

"""Connected components by minimum hooking and contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """``id, comp`` for every node of ``edges`` (``a, b`` long): the smallest id of its component.

    Each round hooks every remaining node to its smallest neighbour, shortens the chains and contracts
    the edges, so the rounds grow with the logarithm of the longest chain. What a round makes is written
    to the shared folder and deleted when the next one is. Self-loops, repeated edges and an empty table are fine; nulls are ignored.
    """
    spark, before, now = edges.sparkSession, [], []
    edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", before)
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("p")), "hooks", before)
        jump = up.select(F.col("id").alias("p"), F.col("p").alias("pp"))
        up = up.join(jump, "p").select("id", F.col("pp").alias("p")).join(jump, "p").select("id", F.col("pp").alias("p"))
        up = materialise(up, "roots", now)
        if labels is None:
            labels = up.select("id", F.col("p").alias("comp"))
        else:
            moved = up.select(F.col("id").alias("comp"), "p")
            labels = materialise(labels.join(moved, "comp", "left").select("id", F.coalesce("p", "comp").alias("comp")), "labels", now)
        at = lambda c: up.select(F.col("id").alias(c), F.col("p").alias(f"p{c}"))
        met = edges.join(at("a"), "a").join(at("b"), "b").where("pa <> pb")
        edges = materialise(met.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges", now)
        discard(spark, before)
        before, now = now, []
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))

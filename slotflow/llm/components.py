"""Connected components of a stored edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for each node of the edges ``a``, ``b``: the least node of its component.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its least neighbour, then
    its smaller ones are. Each keeps components together, and the paths shrink to stars in about log(n) rounds. A round
    is an aggregate and a join; its edges are written to the shared folder. Edges of a hot node are rows of one join, which
    Spark can split.
    """
    # after each step a > b: every node points at smaller ones
    current = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, state = store(current), None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = store(large)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        current = store(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct())
        row = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row == state or not row[0]:
            break
        state = row
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""Connected components of an edge list, without bringing it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b); component is the least node in it.

    Large-star and small-star steps in turn; each round is written to the shared folder.
    Both steps group by a node's neighbours with min aggregates and joins only, so a hub
    costs a partial aggregate and a split join, never one task's list. Nulls and loops
    are ignored; an empty edge list has no components.
    """
    now = cut(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower.hint("merge"), "a")
        stars = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        after = cut(stars.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        if after.exceptAll(now).isEmpty() and now.exceptAll(after).isEmpty():
            break
        now = after
    else:
        raise RuntimeError("components did not settle")
    leaves = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

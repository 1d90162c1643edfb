"""Connected components of an edge table, as DataFrame rounds: nothing is collected, no node's edges meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import materialize, scratch


def components(edges: DataFrame, tag: str = "components", rounds: int = 60) -> DataFrame:
    """node, root (the smallest node reachable) of every node of edges(a, b) that isn't its own root.

    Alternates large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and Beyond") until
    the edges are stars. A node's smallest neighbour is a partial aggregate, written as a table of its own, so that the
    joins that bring it back have a plain shuffle on either side, which Spark splits where a node has many edges. Tables
    of a round get as many files as the edges at its start ask for, and all but the last go at the end.
    """
    with scratch() as keep:
        stars = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), tag)
        seen = _state(stars)
        for _ in range(rounds):
            n = seen[0]
            both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), tag, n)
            large = materialize(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), tag, n)
            least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), tag, n)
            small = large.join(least, "u")
            small = small.select("u", F.col("m").alias("v")).unionByName(small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
            stars = materialize(small, tag, n)
            now = _state(stars)
            if now == seen or _settled(stars):
                return keep(stars).select(F.col("u").alias("node"), F.col("v").alias("root"))
            seen = now
    raise RuntimeError("the components did not settle")


def _settled(stars: DataFrame) -> bool:
    """Whether every node has one root, which has none itself: as edges lead to smaller nodes, these are the smallest."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(stars.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

"""Connected components as DataFrame rounds."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint in the folder that driver and executors share: cuts lineage, survives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or f"file://{tempfile.gettempdir()}/checkpoints")
    return df.checkpoint()


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """node, root (the smallest node reachable) of every node of edges(a, b).

    In a round a node's label, and that of the node it points to, fall to the smallest label around it; then labels are
    followed one step further. So long paths take some rounds more than the logarithm of their length. No node's edges
    are collected; each round ends in a checkpoint.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = settled(both.union(both.select("v", "u")).distinct())
    labels = settled(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label")))
    for _ in range(rounds):
        around = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("least"))
        met = labels.join(around, "u")
        pulled = met.select("u", F.least("label", "least").alias("label")).union(met.select("label", "least"))
        lower = pulled.groupBy("u").agg(F.min("label").alias("label"))
        next_ = lower.select(F.col("u").alias("label"), F.col("label").alias("beyond"))
        now = settled(lower.join(next_, "label", "left").select("u", F.least("label", F.coalesce("beyond", "label")).alias("label")))
        if now.join(labels.withColumnRenamed("label", "before"), "u").where(F.col("label") != F.col("before")).isEmpty():
            return now.select(F.col("u").alias("node"), F.col("label").alias("root"))
        labels = now
    raise RuntimeError("the components did not settle")

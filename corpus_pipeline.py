"""From raw documents to training shards: five stages, each on all rows that the one before kept.

Every stage keeps the columns it is given, whatever their names and types; the last adds `shard` (or `shard_1`, ... if
documents have that column).

Defined results, stage by stage. Null and empty texts have an empty view, and stay if its score is good enough. Near
copies: all texts without words are copies of each other, so one row of them stays; of repeated rows one stays; a null
doc_id is larger than any other. Decontamination leaves null, empty and wordless texts as they are. Mixing: a null source,
or one without a weight of its own, is in the pool of all others; repeated ids are drawn alike. Sharding: a null doc_id
counts as the empty string. An empty table stays empty; very long texts are read in whole throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliospark.llm.common import by_name, discard, materialize, scratch, table
from foliospark.llm.decontam import decontaminate
from foliospark.llm.mixing import OTHER, WEIGHTS, replicate
from foliospark.llm.quality import keep_good
from foliospark.llm.quality import train as train_quality
from foliospark.llm.sharding import assign_shards
from foliospark.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages cover to 5 % or more go; of others, passages of 13 words or more are cut out."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that sources reach their target weights."""
    mixed = replicate(docs, WEIGHTS, OTHER)
    return mixed.select(*[by_name(mixed, c) for c in docs.columns])


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard."""
    return assign_shards(docs)


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: The learned classifier and XXH64 fingerprints have no SQL: tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage but the last is written; then what it was made from, and its own tables, go."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before = docs
        with scratch() as keep:
            docs = keep(materialize(stage(spark, before, sf_dir), f"stage{i}"))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)

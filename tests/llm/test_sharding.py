import pytest
from pyspark.sql import functions as F

from foliospark.llm.sharding import OP5_SQL, assign_shards, number_slots, op5_shard, rendezvous, write_shards
from tests.llm.compare import same


def test_growing_moves_rows_into_the_new_shard_only(spark):
    for weights in (None, [1.0 + i for i in range(9)]):
        ids = spark.range(4000).select(F.col("id").cast("string").alias("k"))
        got = ids.select(rendezvous(F.col("k"), 8, weights and weights[:8]).alias("a"), rendezvous(F.col("k"), 9, weights).alias("b")).collect()
        assert all(r["a"] == r["b"] or r["b"] == 8 for r in got)
        counts = [sum(r["b"] == s for r in got) for s in range(9)]
        share = [(weights or [1] * 9)[s] / sum(weights or [1] * 9) for s in range(9)]
        assert all(abs(c / 4000 - p) < 0.03 for c, p in zip(counts, share))


def test_bad_weights(spark):
    with pytest.raises(ValueError):
        rendezvous(F.lit("x"), 2, [1.0, 0.0])


def test_awkward_rows(awkward, empty):
    got = assign_shards(awkward, into="part").collect()
    assert len(got) == awkward.count() and all(0 <= r["part"] < 8 and r["score"] == "kept" for r in got)
    assert len({r["part"] for r in got if r["doc_id"] == 4}) == 1
    assert assign_shards(empty, into="part").count() == 0
    out = assign_shards(awkward)
    assert out.columns == [*awkward.columns, "shard_1"] and {r["shard"] for r in out.collect()} == {r["shard"] for r in awkward.collect()}
    assert assign_shards(out).columns[-2:] == ["shard_1", "shard_2"]


def test_slots_of_awkward_rows(awkward, empty):
    """Null and repeated keys, names with dots, and a key that holds most rows."""
    digest = lambda df: assign_shards(df.drop("tags", "shard").withColumnRenamed("doc_id", "doc.id"), key="doc.id", n_shards=2)
    got = number_slots(digest(awkward), "shard", "doc.id", ["a.b"])
    assert got.columns[-1] == "slot_1" and got.count() == awkward.count()
    for s in (0, 1):
        assert sorted(r["slot_1"] for r in got.where(F.col("shard") == s).collect()) == list(range(got.where(F.col("shard") == s).count()))
    assert number_slots(digest(empty), "shard", "doc.id", ["a.b"]).count() == 0


def test_slots_of_one_hot_row(spark, monkeypatch):
    from foliospark.llm import sharding

    monkeypatch.setattr(sharding, "SLOT_RUN", 7)
    rows = spark.range(100).select(F.when(F.col("id") < 60, 5).otherwise(F.col("id")).alias("doc_id"), F.lit(0).alias("shard"), F.lit(1).alias("c"))
    got = number_slots(rows, "shard", "doc_id", ["c"], buckets=4).collect()
    assert sorted(r["slot"] for r in got) == list(range(100)) and sum(r["doc_id"] == 5 for r in got) == 60


def test_slots_are_gapless(spark):
    rows = spark.range(3000).select((F.col("id") % 1000).alias("doc_id"), F.crc32(F.col("id").cast("string").cast("binary")).alias("c")).withColumn("shard", rendezvous(F.col("doc_id").cast("string"), 4))
    got = number_slots(rows, "shard", "doc_id", ["c"], buckets=16).groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect()
    assert all(r["s"] == list(range(len(r["s"]))) for r in got)


def test_written_shards(spark, tmp_path):
    df = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("shard_note", F.lit("x"))
    write_shards(df, str(tmp_path / "out"), n_shards=3, tasks_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.where(F.col("shard") != rendezvous(F.col("doc_id").cast("string"), 3)).count() == 0


def test_query(spark, sf_dir):
    assert same(op5_shard(spark, sf_dir), OP5_SQL, sf_dir)

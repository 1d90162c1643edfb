import math

import pytest
from pyspark.sql import functions as F

from foliospark.llm.mixing import OP7_SQL, op7_mix, rates, replicate
from tests.llm.compare import same


def test_counts_follow_the_rates(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source"), F.lit("xxxx").alias("text"))
    got = {r["source"]: (r["n"], r["d"]) for r in replicate(docs, {"a": 1.0, "b": 4.0}, 1.0).groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d")).collect()}
    for source, share in (("a", 1 / 6), ("b", 4 / 6), (None, 1 / 6)):
        n, distinct = got[source]
        rate = share * 3
        assert abs(n / 6000 - share) < 0.03
        assert abs(distinct / 2000 - (1 - math.exp(-rate))) < 0.05


def test_large_rates_and_repeats_of_a_key(spark):
    docs = spark.createDataFrame([(1, "rare", "x" * 10), (1, "rare", "x" * 10)] + [(i, "common", "y" * 100) for i in range(2, 100)], "doc_id long, source string, text string")
    out = replicate(docs, {"rare": 1.0, "common": 1.0}, 0.0)
    got = out.groupBy("doc_id", "source").agg(F.count("*").alias("n"), F.max("copy").alias("m")).where("source = 'rare'").first()
    assert 350 < got["n"] < 630 and got["n"] == 2 * (got["m"] + 1)
    assert {r["pool"]: r["rate"] for r in rates(docs, {"rare": 1.0, "common": 1.0}, 0.0).collect()}[None] == 0.0


def test_awkward_rows(awkward, empty):
    out = replicate(awkward, {"src1": 1.0}, 1.0, copy="nth", order="place")
    assert out.columns == [*awkward.columns, "nth", "place"] and {r["score"] for r in out.collect()} == {"kept"}
    out = replicate(awkward, {"src1": 1.0}, 1.0)
    assert out.columns == [*awkward.columns, "copy_1", "order_key_1"]
    assert {(r["copy"], r["Order_Key"], r["a.b"]) for r in out.collect()} == {("kept",) * 3} and {len(r["order_key_1"]) for r in out.collect()} == {32}
    assert replicate(empty, {"src1": 1.0}).count() == 0
    with pytest.raises(ValueError):
        replicate(awkward, {"src1": -1.0})


def test_native(spark, sf_dir):
    plan = op7_mix(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, sf_dir):
    assert same(op7_mix(spark, sf_dir), OP7_SQL, sf_dir)

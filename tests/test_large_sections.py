"""Sections and records that come again and again: each two keys or names are compared once, and results are those of all pairs."""

import time

import numpy as np

from foliospark.functions.similarity import jaro_winkler
from foliospark.operators import sections as SE
from foliospark.operators import sequence as S


def test_keys_are_compared_once(monkeypatch):
    seen = []
    monkeypatch.setattr(SE, "jaro_winkler", lambda a, b: seen.append((a, b)) or jaro_winkler(a, b))
    left, right = ["abc", "abd", "abc", "x"] * 50, ["abc", "xy", "abd"] * 40
    rows = np.array(list(SE._key_rows(left, right)))
    assert np.array_equal(rows, np.array([[jaro_winkler(a, b) for b in right] for a in left]))
    assert len(seen) == 3 * 3


def test_long_volumes_of_few_keys():
    rng = np.random.default_rng(3)
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD"]
    left, right = ([names[k] for k in rng.integers(0, 5, n)] for n in (4000, 4100))
    began = time.time()
    found = S.align_rows(SE._key_rows(left, right), len(left), len(right), 0.8)
    assert time.time() - began < 10
    assert len(found) > 1000 and all(left[i] == right[j] for i, j in found)


def repeated(tmp_path, n):
    """The parts of the smallest table n times, with shifted keys."""
    import duckdb

    duckdb.execute(f"COPY (SELECT p.* REPLACE (p_partkey + 200 * r AS p_partkey) FROM '/root/testdata/sf0.001/part.parquet' p, range({n}) x(r)) TO '{tmp_path}/part.parquet'")
    return str(tmp_path)


def most_rows(df):
    """The most rows that a join of the query makes, as its plan counts them once it has run."""
    df.collect()
    plan, most, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if "Join" in node.getClass().getSimpleName():
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.length())]
    return most


def test_repeated_records_are_not_expanded(spark, tmp_path):
    from foliospark.plans.alignment_queries import QUERIES, SQL
    from tests.compare import same

    sf_dir = repeated(tmp_path, 12)
    for name in ("candidates_mutual_best", "inversions"):
        assert same(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) > 0
        # all pairs inside segments are about 58,000 here
        assert 0 < most_rows(QUERIES[name](spark, sf_dir)) < 12_000


def test_pairs_are_made_of_names_at_the_end(spark, tmp_path):
    from foliospark.operators import links
    from foliospark.plans.alignment_queries import QUERIES, SQL
    from tests.compare import same

    sf_dir = repeated(tmp_path, 12)
    for name in ("similarity_pairs", "rival_margin"):
        assert same(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) > 50_000
        # joins make pairs of names; all pairs inside segments are about 58,000 here
        assert 0 < most_rows(QUERIES[name](spark, sf_dir)) < 12_000
    left = spark.createDataFrame([("s", i, "xy"[i % 2]) for i in range(7)], "segment string, i long, a string")
    right = spark.createDataFrame([("s", j, "z") for j in range(5)], "segment string, j long, b string")
    known = spark.createDataFrame([("x", "z", 0.5), ("y", "z", 0.25)], "a string, b string, sim double")
    got = [tuple(r) for r in links.pairs_by_name(left, right, known, chunk=2).collect()]
    assert sorted(got) == [("s", i, j, (0.5, 0.25)[i % 2]) for i in range(7) for j in range(5)]


def test_alignment_without_tables():
    rng = np.random.default_rng(5)
    for n, m in ((0, 3), (1, 1), (7, 9), (40, 35), (60, 80)):
        for levels in (3, 8, 1000):
            sims = (rng.integers(0, levels, (n, m)) / max(levels - 1, 1)).astype(np.float32)
            for threshold in (0.25, 0.75):
                cells = ((np.flatnonzero(r - threshold > 0), (r - threshold)[r - threshold > 0]) for r in sims)
                pairs = S.align_gains(cells, m)
                assert pairs == S.align(sims, threshold)
                assert S.residual_rows(lambda i, cols: sims[i, cols], n, m, pairs[::2], np.float32(0.9)) == S.residual(sims, pairs[::2], np.float32(0.9))


def test_repeated_records_are_compared_once(spark, monkeypatch):
    """Links of a section whose records come many times are those of all pairs, and cells are made of distinct contents."""
    from foliospark.operators import alignment as A
    from tests.test_alignment import plain_links, rows_of

    side = lambda s, n: spark.createDataFrame([("s", k, f"{s}{k}", ["ring", "bolt", "rung", ""][k % 4], f"rue {k % 3 * 7}") for k in range(n)], "segment string, order long, uuid string, subj string, text string")
    left, right, made, plain = side("a", 60), side("b", 50), [], A.cells
    monkeypatch.setattr(A, "cells", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    got = {(r["segment"], r["left_uuid"], r["right_uuid"], round(r["score"], 5), r["source"]) for r in A.align(left, right, A.Params(context=False))[0].collect()}
    assert got == plain_links(rows_of(left), rows_of(right), A.Params(context=False)) and got
    assert 0 < made[0].count() <= 12 * 12


def test_transport_of_copies():
    rng = np.random.default_rng(7)
    for n, m in ((1, 1), (4, 3), (6, 9), (12, 12)):
        for levels in (2, 5, 1000):
            supply, demand = rng.integers(1, 5, n), rng.integers(1, 5, m)
            gain = rng.integers(0, levels, (n, m)) / levels * (rng.random((n, m)) < 0.7)
            i, j = np.nonzero(gain)
            met = S.transport(supply, demand, np.searchsorted(i, np.arange(n + 1)), j, gain[i, j])
            dealt = np.zeros((n, m), dtype=int)
            for a, b, k in met:
                dealt[a, b] += k
            assert (dealt.sum(axis=1) <= supply).all() and (dealt.sum(axis=0) <= demand).all() and (gain[dealt > 0] > 0).all()
            single = np.repeat(np.repeat(gain, supply, axis=0), demand, axis=1)
            assert abs((dealt * gain).sum() - sum(single[a, b] for a, b in S.assignment(single))) < 1e-9


def test_repeated_records_are_linked_by_contents(spark, monkeypatch):
    """Similarities are those of contents, counted and dealt out as often as their records make pairs."""
    from collections import Counter
    from types import SimpleNamespace

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    from foliospark.operators import linking as LK

    side = lambda s, n, of: spark.createDataFrame([("s", k, f"{s}{k}", f"T{k % 2}", ["ring", "Bolt", "rung", ""][k % 4], f"rue {k % of * 7}") for k in range(n)], "segment string, order long, uuid string, section string, subj string, text string")
    left, right, made, plain = side("a", 60, 3), side("b", 50, 6), [], LK.tiles
    pairs = LK.compared(left, right).withColumn("match", (F.substring("left_uuid", 2, 9) == F.substring("right_uuid", 2, 9)).cast("int")).persist()
    every = pairs.collect()
    assert len(every) > 1000
    monkeypatch.setattr(LK, "tiles", lambda a, b: made.append(a.count() * b.count()) or plain(a, b))
    judged = left.where("order % 2 = 0")
    same = judged.select(F.col("uuid").alias("left_uuid"), "order").join(right.select(F.col("uuid").alias("right_uuid"), "order"), "order")
    rows = LK.counted(left, right, judged, same)
    got = {(r["section"], r["subj"], r["text"], r["match"]): r["n"] for r in rows.collect()}
    assert got == Counter((r["section"], r["subj"], r["text"], r["match"]) for r in every if int(r["left_uuid"][1:]) % 2 == 0)
    model = LK.learn(rows, count="n")
    own = pairs.where("substring(left_uuid, 2) % 2 = 0")
    n = Counter(r["match"] for r in own.collect())
    weighted = VectorAssembler(inputCols=LK.FIELDS, outputCol="x").transform(own.withColumn("w", F.when(F.col("match") == 1, n.total() / 2 / n[1]).otherwise(n.total() / 2 / n[0])))
    single = LogisticRegression(featuresCol="x", labelCol="match", weightCol="w", regParam=0.01).fit(weighted)
    assert np.allclose(model.coefficients.toArray(), single.coefficients.toArray(), rtol=1e-3) and abs(model.intercept - single.intercept) < 1e-2
    made.clear()
    for weights, free in ((model.coefficients.toArray(), model.intercept), (np.array([1.0, -2.0, 3.0]), -1.5)):
        score = {(int(r["left_uuid"][1:]), int(r["right_uuid"][1:])): 1 / (1 + np.exp(-(free + weights @ [r[f] for f in LK.FIELDS]))) for r in every}
        table = np.zeros((60, 50))
        for (i, j), p in score.items():
            table[i, j] = p if p >= LK.THRESHOLD else 0
        found = [(int(r["left_uuid"][1:]), int(r["right_uuid"][1:]), r["score"]) for r in LK.link(left, right, SimpleNamespace(coefficients=SimpleNamespace(toArray=lambda w=weights: w), intercept=free)).collect()]
        assert found and len({i for i, _, _ in found}) == len({j for _, j, _ in found}) == len(found)
        assert all(abs(p - table[i, j]) < 1e-9 and p >= LK.THRESHOLD for i, j, p in found)
        assert abs(sum(p for *_, p in found) - sum(table[i, j] for i, j in S.assignment(table))) < 1e-9
    # 60 by 50 records are 12 by 12 contents
    assert made and max(made) <= 12 * 12

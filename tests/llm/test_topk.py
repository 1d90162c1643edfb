import math
import random

import numpy as np
from pyspark.sql import functions as F

from foliospark.llm import topk as T
from foliospark.llm.topk import OP2_SQL, op2_topk, top_k
from tests.llm.compare import same


def brute(rows, is_query, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if is_query(i) and (i not in asked or v < asked[i]):
            asked[i] = v
    out = []
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in whole if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(df, F.col("id") % 3 == 0, k=k, **options).collect())


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 4) for _ in range(6)]) for i in range(160)]
    rows += [(200 + i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(30)]  # ties
    want = brute(rows, lambda i: i % 3 == 0, 5)
    for options in ({}, {"query_block": 7, "candidate_block": 11, "seed_rows": 3}, {"query_wave": 9, "query_block": 4}):
        assert run(spark, rows, **options) == want


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [2.0]), (6, []), (7, [-1.0, 1.0, 3.0]), (None, [9.0, 9.0]), (9, [1.0, 2.0]), (9, [1.0, 2.0]), (12, [1e9, -1e9])]
    assert run(spark, rows, k=3) == brute(rows, lambda i: i % 3 == 0, 3)


def test_huge_components_are_cut_to_longs(spark):
    got = run(spark, [(0, [1e200]), (1, [1e200]), (2, [-1e200])], k=2)
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_dense_and_single_products(monkeypatch):
    """Both ways to the exact scores, on blocks with many and few survivors."""
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * rng.normal(size=(300, 8)))
    ids, turn = np.arange(300), np.linalg.svd(vectors.T @ vectors)[2].T
    for share in (0.0, 2.0):
        monkeypatch.setattr(T, "DENSE", share)
        block = T.Queries(ids[:40], vectors[:40], turn, 3, vectors[:20], ids[:20], 4)
        best, least = {}, block.least.copy()
        for at in range(0, 300, 50):
            T.best_of(block, T.Candidates(ids[at : at + 50], vectors[at : at + 50], turn, 3), best, least)
        for q in range(40):
            want = sorted(((int(vectors[q] @ vectors[c]), -c) for c in range(300) if c != q), reverse=True)[:4]
            assert best[q] == want


def test_extra_columns(spark):
    rows = [(i, [float(i), 1.0], "x") for i in range(9)]
    df = spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], "vec_id long, embedding array<double>, label string, id string, v string, norm2 string, `a.b` string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(df, F.col("id") % 3 == 0, k=2).collect())
    assert got == brute([(i, v) for i, v, _ in rows], lambda i: i % 3 == 0, 2)


def test_few_and_none(spark):
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert run(spark, []) == []


def test_query(spark, sf_dir):
    assert same(op2_topk(spark, sf_dir), OP2_SQL, sf_dir)

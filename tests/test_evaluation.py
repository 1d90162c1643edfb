"""Models of many runs: equal runs are counted, so the work grows with the distinct ones; a model's rounds are those of the operator."""

import inspect
import random
import time

import numpy as np

from foliospark.operators import crf
from foliospark.operators import evaluation as EV
from foliospark.plans import audit_queries


def runs(n, seed=0):
    rng = random.Random(seed)
    return [([[f"a={rng.randint(0, 3)}", f"b={rng.randint(0, 2)}"] for _ in range(k)], [rng.choice("XYZ") for _ in range(k)], rng.randint(1, 3)) for k in (rng.randint(1, 7) for _ in range(n))]


def test_expected_moves_and_marginals_are_those_of_each_run_by_itself():
    rng = np.random.default_rng(1)
    lengths = [3, 1, 5, 1, 2]
    packed = crf.Packed([list(range(sum(lengths[:k]), sum(lengths[: k + 1]))) for k in range(len(lengths))])
    e, moves, counts = rng.normal(size=(sum(lengths), 3)) * 5, rng.normal(size=(3, 3)), np.array([1.0, 2, 1, 3, 1])
    p, pairs, z = packed.expect(e[packed.lines], moves, counts)
    own = [crf._expect(part, moves) for part in np.split(e, np.cumsum(lengths)[:-1])]
    assert np.allclose(p[packed.at], np.concatenate([x[0] for x in own]))
    assert np.allclose(pairs, sum(n * x[1] for n, x in zip(counts, own)))
    assert np.allclose(z, [x[2] for x in own])


def test_counted_runs_give_the_model_of_repeated_ones():
    counted = runs(60)
    repeated = [(lines, ys, 1) for lines, ys, n in counted for _ in range(n)]
    a, b = crf.train_runs(counted), crf.train_runs(repeated)
    assert list(a.features) == list(b.features)
    assert np.allclose(a.state, b.state, atol=1e-6) and np.allclose(a.moves, b.moves, atol=1e-6)


def test_training_takes_the_time_of_distinct_runs():
    few = [([{"a": str(k % 3)}, {"a": "1"}], ["X" if k % 3 else "Y", "Z"]) for k in range(3)]
    began = time.time()
    assert crf.train(few * 20_000, rounds=20) is not None
    assert time.time() - began < 10


def test_held_lines_are_scored_by_the_other_splits(spark):
    rows = [(f"d{d}", p, p // 2, 1 + p // 2 % 2, "# x" if (d + p) % 3 == 0 else "abc", ("B-TITLE" if (d + p) % 3 == 0 else "I-ENTRY") if p != 3 else None) for d in range(12) for p in range(8 if d else 2)]
    lines = spark.createDataFrame(rows, "document string, pos int, page int, split int, text string, label string")
    e = EV.Experiment("one", "reference", ("bias", "heading"))
    classes = ["B-TITLE", "I-ENTRY"]
    found = {(r["document"], r["pos"]): r for r in EV.cross_validate(lines, [e], classes).collect()}
    assert len(found) == len(rows) and all(found[r[0], r[1]]["split"] == r[3] and found[r[0], r[1]]["gold"] == r[5] for r in rows)
    features = {(r["document"], r["pos"]): r["features"] for r in EV.features.with_features(lines, ["bias", "heading"]).collect()}
    for split in (1, 2):
        data = []
        for d in {r[0] for r in rows}:
            own = sorted(r for r in rows if r[0] == d)
            data += crf.labelled_runs([features[d, r[1]] for r in own], [r[5] if r[3] != split else None for r in own])
        model = crf.train(data)
        for d in ("d0", "d5"):
            own = sorted(r for r in rows if r[0] == d)
            p = model.marginals([features[d, r[1]] for r in own])
            for r, want in zip(own, p):
                if r[3] == split:
                    assert np.allclose(found[d, r[1]]["marginals"], want, atol=1e-6)


def test_the_queries_learn_to_the_end():
    for query in (audit_queries.cross_validated_accuracy, audit_queries.cross_validation):
        assert "rounds" not in inspect.getsource(query)

"""Small literal cases of the kernels, and checks against plain versions."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.functions import similarity as SI
from foliospark.functions import spans as SP
from foliospark.functions.spans import Span
from foliospark.operators import crf, extraction, layers, sampling, sequence, tagging


def test_ordered_alignment():
    assert sequence.align(np.eye(3), 0.5) == [(0, 0), (1, 1), (2, 2)]
    assert sequence.align(np.diag([1.0, 0.0, 1.0]), 0.5) == [(0, 0), (2, 2)]
    inverted = np.array([[0, 0.9], [0.95, 0]])
    assert sequence.align(inverted, 0.5) == [(1, 0)]
    assert sequence.residual(inverted, [(1, 0)], 0.85) == [(0, 1)] and sequence.residual(inverted, [(1, 0)], 0.95) == []
    assert sequence.align(np.full((1, 1), 0.5), 0.5) == [] and sequence.align(np.zeros((0, 3)), 0.5) == []


def test_ordered_alignment_is_the_best():
    rng = np.random.default_rng(1)
    for _ in range(60):
        s = rng.random((rng.integers(1, 6), rng.integers(1, 6)))
        pairs = sequence.align(s, 0.4)
        assert all(a < c and b < d for (a, b), (c, d) in itertools.pairwise(pairs))
        best = max(sum(s[i, j] - 0.4 for i, j in zip(rows, cols, strict=True)) for k in range(min(s.shape) + 1) for rows in itertools.combinations(range(s.shape[0]), k) for cols in itertools.combinations(range(s.shape[1]), k))
        assert abs(sum(s[i, j] - 0.4 for i, j in pairs) - best) < 1e-9


def test_assignment_is_the_best():
    rng = np.random.default_rng(2)
    for _ in range(80):
        n, m = rng.integers(1, 6, 2)
        g = np.where(rng.random((n, m)) < 0.5, rng.random((n, m)), 0.0)
        total = lambda pairs: sum(g[i, j] for i, j in pairs)
        wide = g if n <= m else g.T
        best = max(sum(wide[i, p[i]] for i in range(len(wide))) for p in itertools.permutations(range(wide.shape[1]), len(wide)))
        assert abs(total(sequence.assignment(g)) - best) < 1e-9
        assert abs(total(sequence.residual(g, [], 1e-12)) - best) < 1e-9


def test_windows():
    assert sequence.windows([(1, 0), (3, 3)], 5, 4) == [([0], []), ([2], [1, 2]), ([4], [])]
    assert sequence.windows([], 2, 1, [(0, 0)]) == [([1], [])]


def emissions():
    same, different = np.zeros(20), np.zeros(20)
    same[14:], different[4:12] = [2e3, 4e3, 8e3, 16e3, 40e3, 80e3], [1e4, 3e4, 6e4, 6e4, 4e4, 2e4, 1e4, 5e3]
    return sequence.emissions(same, different)


def test_pair_model_posteriors():
    same, different = emissions()
    p = lambda s: sequence.posteriors(np.atleast_2d(s), sequence.FIRST, same, different)
    assert p(0.95)[0][0, 0] > 0.5 > 0.05 > p(0.4)[0][0, 0]
    one, _, counts = p(0.72)
    assert abs(counts.sum() - (2 * one[0, 0] + 3 * (1 - one[0, 0]))) < 1e-9
    rng = np.random.default_rng(3)
    for shape in ((4, 3), (1, 5), (3, 0), (0, 0), (6, 6)):
        post, _, counts = sequence.posteriors(rng.random(shape), sequence.FIRST, same, different)
        assert post.shape == shape and (post.sum(axis=0) <= 1 + 1e-9).all() and (post.sum(axis=1) <= 1 + 1e-9).all()
        assert counts[sequence.Y, sequence.X] == 0
        found = sequence.decode(post)
        assert all(a < c and b < d for (a, b), (c, d) in itertools.pairwise(found))


def test_pair_model_against_all_paths():
    same, different = emissions()
    s = np.array([[0.9, 0.3], [0.5, 0.8], [0.2, 0.7]])
    t, odds = sequence.FIRST, (same / different)[sequence.bins(s)]
    total, weight = 0.0, np.zeros_like(s)

    def walk(i, j, state, w, met):
        nonlocal total
        if (i, j) == s.shape:
            w *= t[state, 0]
            total += w
            for at in met:
                weight[at] += w
        if i < s.shape[0] and j < s.shape[1]:
            walk(i + 1, j + 1, 0, w * t[state, 0] * odds[i, j], [*met, (i, j)])
        if i < s.shape[0] and t[state, 1]:
            walk(i + 1, j, 1, w * t[state, 1], met)
        if j < s.shape[1]:
            walk(i, j + 1, 2, w * t[state, 2], met)

    walk(0, 0, 0, 1.0, [])
    post, log_likelihood, _ = sequence.posteriors(s, t, same, different)
    assert np.allclose(post, weight / total) and np.isclose(log_likelihood, np.log(total))


def test_likelihood_rises_and_ratio_is_monotone():
    same, different = emissions()
    assert (np.diff(same / different) >= -1e-12).all() and np.isclose(same.sum(), 1)
    rng = np.random.default_rng(4)
    boxes = [rng.random((rng.integers(0, 4), rng.integers(0, 4))) for _ in range(40)]
    t, seen = sequence.FIRST, []
    for _ in range(6):
        got = [sequence.posteriors(b, t, same, different) for b in boxes]
        seen.append(sum(g[1] for g in got))
        t = sequence.next_transitions(sum(g[2] for g in got))
    assert all(b >= a - 0.5 for a, b in itertools.pairwise(seen)) and t[2, 1] == 0
    assert 0 <= sequence.break_even(same, different) <= 1


def test_similarities():
    def lcs(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    rng = random.Random(5)
    words = ["".join(rng.choice("abcé ") for _ in range(rng.randint(0, 12))) for _ in range(60)]
    for a, b in itertools.product(words[:30], words[30:]):
        assert SI.common_length(a, b) == lcs(a, b)
    assert SI.indel("", "") == 1.0 and SI.jaro_winkler("", "") == 1.0 and SI.jaro_winkler("a", "") == 0.0
    assert round(SI.jaro_winkler("martha", "marhta"), 4) == 0.9611 and round(SI.jaro_winkler("gueniot", "guéniot"), 4) == 0.9238
    left, right = [("Abel", a) for a in words[:12]] + [("", "x")], [("ABEL", b) for b in words[12:24]] + [("", "")]
    full, pruned = SI.matrix(left, right), SI.matrix(left, right, least=0.75)
    assert full.dtype == np.float32 and (full[full >= 0.75] == pruned[full >= 0.75]).all()
    assert full[-1, -1] == 0 and np.isclose(full[0, 0], 0.5 + 0.5 * SI.indel(words[0], words[12]))


BAD = ("<SUBJ>a", "a</SUBJ>", "<SUBJ>a<ADDR>b</ADDR></SUBJ>", "<SUBJ>a</ADDR>", "</SUBJ>a<SUBJ>", "<SUBJ>a<SUBJ>")


def test_tagged_columns(spark):
    tagged = ["**<SUBJ>A**bel (J.)</SUBJ>, <ADDR>rue du Bac, 12</ADDR>. a &lt; b", "", "none", "<DESC></DESC>x<SUBJ> *é*  _l_ a_b\u00a0</SUBJ>", "<SUBJ>&lt;&amp;&gt;</SUBJ>", *BAD, None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tagged)], "i int, t string").select("i", "t", SP.parsed(F.col("t")).alias("p"), SP.label_texts(F.col("t")).alias("texts"))
    rows = rows.withColumn("back", SP.rendered(F.col("p.text"), F.col("p.spans"))).orderBy("i").collect()
    for r in rows[:-1]:
        try:
            text, spans = SP.parse_tagged(r["t"])
            assert (r["p"]["text"], [tuple(s) for s in r["p"]["spans"]], r["p"]["error"]) == (text, [tuple(s) for s in spans], None) and r["back"] == r["t"]
        except ValueError as error:
            assert r["t"] in BAD and r["p"]["error"] == str(error) and r["p"]["text"] is None
    assert rows[-1]["p"] is None
    texts = [r["texts"] for r in rows]
    assert texts[0] == {"SUBJ": ["Abel (J.)"], "DESC": [], "ADDR": ["rue du Bac, 12"]} and texts[3] == {"SUBJ": ["é l a_b"], "DESC": [], "ADDR": []}
    assert all(t == {"SUBJ": [], "DESC": [], "ADDR": []} for t in texts[5:])
    made = spark.createDataFrame([("abcd", [(2, 4, "ADDR", None), (0, 3, "SUBJ", 0.5)]), ("a<b", []), ("x", None)], f"t string, s {SP.SPANS}")
    assert [r["v"] for r in made.select(SP.rendered(F.col("t"), F.col("s")).alias("v")).collect()] == ["<SUBJ>abc</SUBJ>d", "a&lt;b", "x"]


def test_spans():
    tagged = "**<SUBJ>A**bel (J.)</SUBJ>, <ADDR>rue du Bac, 12</ADDR>. a &lt; b"
    text, spans = SP.parse_tagged(tagged)
    assert text == "**A**bel (J.), rue du Bac, 12. a < b"
    for bad in BAD:
        with pytest.raises(ValueError):
            SP.parse_tagged(bad)
    plain, origin = SP.plain_with_origin(" *Abel* _x_ a_b ")
    assert plain == "Abel x a_b" and [" *Abel* _x_ a_b "[i] for i in origin] == list(plain)
    back = SP.unproject(SP.project(spans, *SP.plain_with_origin(text)), SP.plain_with_origin(text)[1])
    assert [(s.start, s.end) for s in back] == [(2, 14), (16, 30)] or [s.label for s in back] == ["SUBJ", "ADDR"]
    assert SP.canonical("R. Vivienne, 44.", [Span(0, 16, "ADDR")]) == SP.canonical("R. Vivienne, 44.", [Span(0, 15, "ADDR")])


@pytest.mark.parametrize("text, spans, want", [
    ("Abel, rue", [], [0]), ("Abel, rue", [Span(0, 4, "SUBJ", 0.5), Span(6, 9, "ADDR", 0.99)], [1]), ("Abel, rue", [Span(0, 4, "SUBJ", 0.95)], [2]),
    ("Abel, rue", [Span(0, 4, "DESC"), Span(6, 9, "ADDR")], [3]), ("Abel, rue", [Span(0, 4, "SUBJ"), Span(6, 9, "SUBJ")], [4]), ("Abel, rue.", [Span(0, 4, "SUBJ", 0.9), Span(6, 9, "ADDR", 0.9)], [])])
def test_suspicion(text, spans, want):
    assert SP.suspicion(text, spans) == [SP.REASONS[i] for i in want]
    assert SP.confidence([Span(0, 1, "SUBJ")]) is None and SP.confidence([]) == 0.0


def test_span_comparison():
    text = "Abel, rue du Bac, 12"
    gold = [Span(0, 4, "SUBJ"), Span(6, 20, "ADDR")]
    assert tagging.compare_spans(text, gold, gold)["kind"] == "ok"
    assert tagging.compare_spans(text, gold, [gold[0], Span(6, 9, "DESC"), Span(10, 20, "ADDR")])["kind"] == "signature"
    moved = tagging.compare_spans(text, gold, [Span(0, 4, "SUBJ"), Span(6, 16, "ADDR")])
    assert moved["kind"] == "frontière" and (moved["tokens_right"], moved["tokens"]) == (4, 5)
    assert dict(moved["tp"])["SUBJ"] == 1 and dict(moved["fn"])["ADDR"] == 1
    assert SP.to_words(SP.word_bounds("ab cd ef"), 1, 4) == (0, 1) and SP.to_words(SP.word_bounds("ab"), 2, 2) is None


def test_annotation_forms():
    result = SP.annotation_result("Abel", [Span(0, 4, "SUBJ", 0.5)])
    assert SP.annotated_spans({"annotations": [{"result": []}, {"result": result}]}) == [Span(0, 4, "SUBJ", 0.5)]
    assert SP.annotated_spans({"annotations": [{"was_cancelled": True, "prediction": {"result": result}}], "predictions": [3]}) == [Span(0, 4, "SUBJ", 0.5)]
    assert SP.annotated_spans({"annotations": [{"result": []}], "predictions": [{"result": result}]}, "predictions") == [Span(0, 4, "SUBJ", 0.5)]
    assert SP.annotated_spans({}) is None


def test_brace_groups(spark):
    cases = [
        ("Fieffé. } *Membres du conseil*", "Pastoret. }", "Thouret. }"),
        ("I.er { Tuileries } Cuynet.", "{ Roule", "{ Mail } Barat."),
        ("Ports { S.-Bernard..... } Rive gauche.", "{ SS.-Pères..... }", "{ S.-Paul..... } Rive droite.", "{ au Blé..... }"),
        ("Commissaires. { MM. Touzet.", "{ Lalande, rue Mandar."),
        ("a } b", "c", "} d", "{ { x"),
        ("Leroux,", "Caron, } *adjoints*.", "Martin, }"),
        ("{ Lalande", "{ Perrin"),
        ("Halles { à la Viande } Places. { d'Aval.", "{ au Beurre }"),
        ("x } y { z", "  w }"),
        ("{", "}"),
        ("no signs", "here"),
        ("one { line",),
    ]
    rows = []
    for k, lines in enumerate(cases):
        ends = list(itertools.accumulate(len(line) + 1 for line in lines))
        rows.append((k, "\n".join(lines), [(z - len(line) - 1, z - 1) for z, line in zip(ends, lines, strict=True)]))
    df = spark.createDataFrame(rows, "k int, text string, segments array<struct<start:int,end:int>>")
    got = df.withColumn("g", layers.brace_groups(F.col("text"), F.col("segments"))).orderBy("k").collect()
    cut = lambda r, z: r["text"][z["start"] : z["end"]]
    zones = [r["g"] and [(cut(r, m["own"]), [cut(r, z) for z in m["inherited"]]) for m in r["g"]["members"]] for r in got]
    problems = [r["g"] and [(p["segment"], p["message"]) for p in r["g"]["problems"]] for r in got]
    assert zones[0] == [(n, ["*Membres du conseil*"]) for n in ("Fieffé.", "Pastoret.", "Thouret.")]
    assert zones[1] == [("Tuileries", ["I.er", "Cuynet."]), ("Roule", ["I.er"]), ("Mail", ["I.er", "Barat."])]
    assert zones[2] == [("S.-Bernard.....", ["Ports", "Rive gauche."]), ("SS.-Pères.....", ["Ports", "Rive gauche."]), ("S.-Paul.....", ["Ports", "Rive droite."]), ("au Blé.....", ["Ports", "Rive droite."])]
    assert [cut(got[2], z) for z in got[2]["g"]["commons"]] == ["Ports", "Rive gauche.", "Rive droite."]
    assert zones[3] == [("MM. Touzet.", ["Commissaires."]), ("Lalande, rue Mandar.", ["Commissaires."])] and problems[:4] == [[]] * 4
    assert zones[4][:3] == [("a", ["b"]), ("c", []), ("", ["d"])] and [s for s, _ in problems[4]] == [1, 2, 3]
    assert problems[5] == [(0, "no brace in a group")] and problems[6] == [(0, "{ without shared text")]
    assert problems[7] == [(0, "unexpected signs (2 {, 1 })"), (1, "{ without shared text"), (1, "} without shared text")]
    assert problems[8][0] == (0, "unexpected signs (1 {, 1 })") and zones[8] == [("x } y { z", []), ("w", [])]
    assert problems[9] == [(0, "{ without shared text"), (0, "member without text of its own"), (1, "} without shared text"), (1, "member without text of its own")]
    assert zones[10] is zones[11] is None


def test_markup():
    got = extraction.read_blocks('<!-- c --><div data-bbox="0 0 10 10" data-label="Section-Header"><h2><span data-word-confidence="0.5 0.9" data-line-bbox-estimate="1 2 3 4">Un <i>deux</i></span></h2><span>a<br>b <span>in</span> <b>c</b></span><span> </span></div><div data-bbox="1 2 3 4" data-label="Image"><span>seen</span></div><div data-bbox="1 2"><span>x</span></div><div data-bbox="1 2 3 4">loose text</div>')
    assert [(b["index"], b["error"]) for b in got] == [(1, None), (2, None), (3, "no box of four numbers"), (4, "text outside any span: loose text")]
    assert [line["markdown"] for line in got[0]["lines"]] == ["## Un *deux*", "a b in **c**"] and got[1]["lines"] == []
    assert got[0]["lines"][0]["words"] == [{"word": "Un", "score": 0.5}, {"word": "deux", "score": 0.9}] and got[0]["lines"][0]["bbox"] == [1, 2, 3, 4]
    assert got[0]["lines"][1]["words"] is None


def test_quotas():
    counts = {"a": 900, "b": 100, "c": 4}
    quotas = sampling.root_quotas(counts, 100)
    assert 95 <= sum(quotas.values()) <= 105 and quotas["a"] == pytest.approx(3 * quotas["b"], abs=2) and quotas["c"] == 4
    assert sampling.root_quotas(counts, 2000) == counts
    drawn = sampling.allocate({"courant": 800, "forme rare": 50, "désaccord": 5}, 100, 0.5)
    assert sum(drawn.values()) == 100 and drawn["désaccord"] == 5 and drawn["courant"] == 47


def test_labeller_learns():
    rng = random.Random(1)
    sequences = []
    for _ in range(30):
        ys, lines = [], []
        for _ in range(8):
            y = "B" if not ys or rng.random() < 0.5 else "I"
            ys.append(y)
            lines.append({"case": "upper" if (y == "B") ^ (rng.random() < 0.1) else "lower", "noise": str(rng.randint(0, 3))})
        sequences.append((lines, ys))
    model = crf.train(sequences)
    p = model.marginals(sequences[0][0])
    assert np.allclose(p.sum(axis=1), 1)
    right = sum((np.array(model.classes)[model.marginals(lines).argmax(axis=1)] == ys).mean() for lines, ys in sequences) / 30
    assert right > 0.85 and crf.train([([{"a": "b"}], ["B"])]) is None
    again = crf.Labeller.load(model.dump())
    assert np.allclose(again.marginals(sequences[1][0]), model.marginals(sequences[1][0]))
    assert crf.labelled_runs([{"a": "1"}, {"a": "2"}, {"a": "3"}], ["B", None, "I"]) == [([{"a": "1"}], ["B"]), ([{"a": "3"}], ["I"])]
    assert crf.group_weights(model, {"case": "shape"})["shape"] > 0


def test_chain_marginals_against_all_labellings():
    rng = np.random.default_rng(0)
    e, moves = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    w = {y: np.exp(sum(e[t, y[t]] for t in range(4)) + sum(moves[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product(range(3), repeat=4)}
    z = sum(w.values())
    p, pairs, log_z = crf._expect(e, moves)
    assert np.isclose(log_z, np.log(z))
    assert np.isclose(p[2, 1], sum(v for y, v in w.items() if y[2] == 1) / z)
    assert np.isclose(pairs[0, 2], sum(v * sum((a, b) == (0, 2) for a, b in itertools.pairwise(y)) for y, v in w.items()) / z)


def test_members_are_made_once(spark, sf_dir):
    """No filter of the plan makes groups or members again for each row."""
    from foliospark.plans.text_queries import QUERIES

    todo, filters = [QUERIES["brace_members"](spark, sf_dir)._jdf.queryExecution().optimizedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "Filter":
            filters.append(node.condition().toString())
        children = node.children()
        todo += [children.apply(k) for k in range(children.length())]
    assert filters and not any("unexpected signs" in f or "member without" in f or "array(0" in f for f in filters)
    assert max(map(len, filters)) < 5000

"""Operators on small literal inputs."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.functions import keys, shapes, text
from foliospark.operators import addresses, alignment, entities, features, layers, lines, links, overlay, sampling, sections, stats, tagging
from foliospark.plans import jobs
from foliospark.sources import pages, writes


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]


def one(spark, column, *, text_="x"):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_keys(spark):
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(["A  b", "A b", "", "A b", "é", "é", ""])], "document string, pos int, text string")
    got = values(keys.with_line_keys(df).orderBy("pos"), "key")
    assert got[1] == got[0] + "~2" and got[3] == got[0] + "~3" and got[5] == got[4] + "~2" and got[6] == got[2] + "~2"
    assert one(spark, keys.uuid5(uuid.NAMESPACE_URL, F.lit("été"))) == str(uuid.uuid5(uuid.NAMESPACE_URL, "été"))
    assert one(spark, keys.fingerprint(F.lit("a "), F.lit(None).cast("string"))) == one(spark, keys.fingerprint(F.lit(" a"), F.lit("")))


def test_titles(spark):
    assert one(spark, text.title_key(F.lit("## BOIS. ( MARCHANDS DE )"))) == one(spark, text.title_key(F.lit("## **Bois (Marchands de)**"))) == "bois marchands de"
    assert one(spark, text.title_text(F.lit("## **BAIGNEURS.**"))) == "BAIGNEURS."
    assert one(spark, text.title_level(F.lit("  ### x"))) == 3 and one(spark, text.title_level(F.lit("x"))) is None
    assert one(spark, text.alphabet_key(F.lit("Le Roux, rue"))) == "LEROU" and one(spark, text.alphabet_key(F.lit("Élan"))) == "ELAN"


def test_entities(spark):
    rows = [("I-ENTRY", "orphan "), ("B-TITLE", "# LIVRE"), ("B-ENTRY", " Abel "), ("OUT OF SCOPE", "12"), ("I-ENTRY", "rue"), ("SUB-ENTRY", "sub"), ("SUPPRIMÉE", "gone"), ("B-TITLE", "## A"), ("I-TITLE", "suite"), ("B-ENTRY", "Zoe"), ("B-TITLE", "bare"), ("B-ENTRY", "Abc"), ("B-TITLE", "## B"), ("?", "what")]
    df = spark.createDataFrame([("d", i, c, t, f"k{i}") for i, (c, t) in enumerate(rows)], "document string, pos long, class string, text string, key string")
    built = entities.with_parent(entities.with_uuid(entities.merge(df)))
    got = {r["markdown"]: r for r in built.collect()}
    assert got["Abel rue\nsub"]["key"] == "k2,k4,k5" and got["orphan "]["parent_uuid"] == keys.ROOT and "gone" not in got
    at = {m: r["uuid"] for m, r in got.items()}
    parents = {m: r["parent_uuid"] for m, r in got.items()}
    assert parents["# LIVRE"] == keys.ROOT and parents["## A suite"] == at["# LIVRE"] and parents["bare"] == at["## A suite"] and parents["## B"] == at["# LIVRE"]
    assert parents["Zoe"] == at["## A suite"] and parents["Abc"] == at["bare"] and parents["12"] == at["# LIVRE"] and parents["what"] == at["## B"]
    counts = {r["uuid"]: (r["direct"], r["subtree"]) for r in entities.tree_counts(built).collect()}
    assert counts[at["# LIVRE"]] == (1, 3) and counts[at["## A suite"]] == (1, 2) and counts[at["## B"]] == (0, 0)
    r = entities.report(df, built).first()
    assert (r["lines_deleted"], r["orphans"], r["unknown_classes"], r["unmarked_titles"], r["untitled_entries"]) == (1, 1, 1, 1, 1)
    assert values(entities.alphabet_breaks(df.where("class <> 'B-TITLE'")), "sort_key", "previous_key") == [("ABEL", "ORPHA"), ("ABC", "ZOE")]


def test_overlay_scenarios(spark):
    machine = spark.createDataFrame([("d", i, k, "B-ENTRY", t, 0.5) for i, (k, t) in enumerate([("a", "one"), ("b", "two"), ("c", "three")])], "document string, pos long, key string, class string, text string, score double")
    printed = machine.withColumn("fingerprint", keys.fingerprint(F.col("class"), F.col("text"))).withColumn("corrected", F.lit(""))
    edited = printed.where("key <> 'x'").withColumn("text", F.when(F.col("key") == "b", "TWO").otherwise(F.col("text"))).drop("score")
    state = lambda df: {r["key"]: r["state"] for r in overlay.capture(df, ["class", "text"]).collect()}
    assert state(edited) == {"a": "same", "b": "unmarked", "c": "same"}
    marked = edited.withColumn("corrected", F.when(F.col("key") == "b", " Oui ").otherwise(""))
    assert state(marked)["b"] == "corrected"
    added = marked.unionByName(spark.createDataFrame([("d", 0, "", "I-ENTRY", "zero", "", "")], "document string, pos long, key string, class string, text string, fingerprint string, corrected string").withColumn("pos", F.lit(-1))).unionByName(marked.where("key = 'c'").withColumn("pos", F.lit(5)).withColumn("key", F.lit("")).withColumn("text", F.lit("after")))
    twice = added.unionByName(marked.where("key = 'c'").withColumn("pos", F.lit(6)).withColumn("key", F.lit("c+1")).withColumn("text", F.lit("taken")))
    found = overlay.capture(twice, ["class", "text"])
    assert {r["key"]: (r["state"], r["after"]) for r in found.where("state = 'inserted'").collect()} == {"debut+1": ("inserted", ""), "c+2": ("inserted", "c"), "c+1": ("inserted", "c+2")}
    patch = found.where("state in ('corrected', 'inserted')").select("document", "key", "after", "class", "text")
    out = overlay.apply(machine, patch, ["class", "text"], machine_only=["score"]).orderBy("rank")
    assert values(out, "key", "text", "score", "corrected") == [("debut+1", "zero", None, "oui"), ("a", "one", 0.5, ""), ("b", "TWO", 0.5, "oui"), ("c", "three", 0.5, ""), ("c+2", "after", None, "oui"), ("c+1", "taken", None, "oui")]
    lost = overlay.apply(machine.where("key <> 'b'"), patch, ["class", "text"])
    assert values(lost.where("problem is not null"), "key", "rank") == [("b", None)]
    assert values(overlay.erased(machine, edited.where("key <> 'a'")), "key") == ["a"]
    swapped = printed.withColumn("pos", F.when(F.col("key") == "c", -5).otherwise(F.col("pos")))
    assert values(overlay.moved(machine, swapped), "key") == ["a", "b"]
    r = overlay.summary(patch, patch.where("key <> 'b'")).first()
    assert (r["corrections"], r["inserted"], r["removed"]) == (3, 3, 1)
    assert {r["state"] for r in overlay.capture(twice, ["class", "text"], insertions=False).where("text in ('zero', 'after')").collect()} == {"duplicate"}


def test_line_functions(spark):
    words = lines.zip_scores(F.lit("un deux trois"), F.lit("0.99 0.44 0.97"))
    assert one(spark, lines.lowest_score(words)) == 0.44 and one(spark, lines.doubtful(lines.lowest_score(words))) is True
    assert one(spark, lines.zip_scores(F.lit("un deux"), F.lit("0.5"))) is None
    assert one(spark, text.decimal_comma(F.lit(0.44))) == "0,44" and one(spark, text.decimal_comma(F.lit(None).cast("double"))) == ""
    assert one(spark, lines.parse_box(F.lit("[1, -2.5, 3, 4]"))) == [1, -2.5, 3, 4] and one(spark, lines.parse_box(F.lit("1 2"))) is None
    box = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one(spark, lines.to_frame(box(50, 100, 100, 200), box(0, 0, 100, 200))) == [500, 500, 1000, 1000]
    assert one(spark, lines.containing(box(1, 1, 2, 2), F.array(box(2, 0, 9, 9), box(0, 0, 2, 2), box(0, 0, 9, 9)))) == 2


def test_walk_keeps_document_order(spark):
    block = lambda i, *t: {"index": i, "bbox": None, "label": "Text", "chunk_index": None, "lines": [{"uid": x} for x in t]}
    df = spark.createDataFrame([("d", [{"page_index": 7, "data_blocks": [block(1, "a", "b"), block(2, "c")]}, {"page_index": 8, "data_blocks": [block(1, "d")]}])], "document string, pages array<struct<page_index:int,data_blocks:array<struct<index:int,bbox:array<double>,label:string,chunk_index:int,lines:array<struct<uid:string>>>>>>")
    got = lines.walk(df).orderBy("pos").select("line.uid", "page_index").collect()
    assert [tuple(r) for r in got] == [("a", 7), ("b", 7), ("c", 7), ("d", 8)]


def test_shapes(spark):
    s = F.lit("Bourdois, R. S.-Honoré, 87. — Pl. Vendôme.")
    assert one(spark, shapes.coarse_shape(s)) == "w , w , 9 — w"
    assert one(spark, shapes.profile(F.lit("Voy. X (Y) et Z, a, b; c, d"))) == "paren·et·renvoi·sans-num·4+virg"


def test_addresses(spark):
    cases = {"rue du Faub.-S.-Laurent, 33.": ("simple", "faubourg saint laurent", [33]), "rue de Cléry, 21-19.": ("simple", "rue clery", [19, 21]), "rue des Bourdon- nais, 14.": ("simple", "rue bourdonnais", [14]), "rue Mézières.": ("sans numéro", "rue mezieres", []), "quai de l'Horloge, 1 et 43.": ("complexe", "", []), "": ("absente", "", [])}
    df = spark.createDataFrame([(a,) for a in cases], "a string").select("a", addresses.kind(F.col("a")).alias("k"), addresses.street(F.col("a")).alias("s"), addresses.numbers(F.col("a")).alias("n"))
    assert {r["a"]: (r["k"], r["s"], r["n"]) for r in df.collect()} == cases
    arr = lambda *n: F.array(*[F.lit(x) for x in n])
    assert one(spark, addresses.substituted(arr(55), arr(53))) == "5→3" and one(spark, addresses.substituted(arr(55), arr(33))) == "" and one(spark, addresses.substituted(arr(5), arr(33))) == ""
    assert one(spark, addresses.name_within(F.lit("rue four"), F.lit("rue four saint germain"))) is True
    change = lambda a, b: one(spark, addresses.change(*[f(F.lit(x)) for x in (a, b) for f in (addresses.kind, addresses.street, addresses.numbers)]))
    assert change("rue de Sorbonne, 3", "rue Sorbonne, 3.") == "équivalence" and change("rue du Mail, 3", "rue du Mail, 4") == "changement de numéro" and change("rue du Mail, 3", "quai Voltaire, 3") == "déménagement" and change("", "x, 1 et 2") == "adresse absente"


def records(spark, rows):
    return spark.createDataFrame([("v", i, f"{s}{i}" if not u else u, s) for i, (s, u) in enumerate(rows)], "volume string, order int, uuid string, side string")


def test_natural_join(spark):
    left = spark.createDataFrame([("v", f"l{i}", i) for i in range(4)], "volume string, uuid string, order int")
    right = spark.createDataFrame([("v", f"r{i}", i) for i in range(5)], "volume string, uuid string, order int")
    join = lambda pairs: [(r["left_uuid"], r["right_uuid"]) for r in links.natural_join(spark.createDataFrame([("v", a, b, 1.0, "nw") for a, b in pairs], "volume string, left_uuid string, right_uuid string, score double, source string"), left, right).orderBy("rank").collect()]
    assert join([("l2", "r1"), ("l3", "r3"), ("gone", "r0")]) == [("l0", None), ("l1", None), (None, "r0"), ("l2", "r1"), (None, "r2"), ("l3", "r3"), (None, "r4")]
    assert join([("l0", "r1"), ("l1", "r0")])[:5] == [("l0", "r1"), (None, "r2"), (None, "r3"), (None, "r4"), ("l1", "r0")]
    assert join([("none", "none")]) == [*((f"l{i}", None) for i in range(4)), *((None, f"r{i}") for i in range(5))]


def test_alignment_of_two_editions(spark):
    names = ["Abadie", "Abel", "Acard", "Adam", "Agier", "Alard", "Allier", "Amiot", "Andry", "Arnoul", "Aubert", "Audry"]
    side = lambda rows, p: spark.createDataFrame([("s", i, f"{p}{i}", n, f"{n}, {t}") for i, (n, t) in enumerate(rows)], "segment string, order int, uuid string, subj string, text string")
    old = [(n, f"rue du {n[::-1]}, {i}.") for i, n in enumerate(names)]
    new = [x for i, x in enumerate(old) if i not in (2, 7)]
    new[4], new[5] = new[5], new[4]  # an inversion
    got, fitted = alignment.align(side(old, "l"), side(new, "r"))
    pairs = {(r["left_uuid"], r["right_uuid"]): r["source"] for r in got.collect()}
    want = {f"l{i}": f"r{new.index(x)}" for i, x in enumerate(old) if x in new}
    assert {a: b for a, b in pairs} == want and alignment.RESIDUAL in pairs.values() and len(fitted.likelihoods) >= 1
    plain, none = alignment.align(side(old, "l"), side(new, "r"), alignment.Params(context=False))
    assert none is None and {(r["left_uuid"], r["right_uuid"]) for r in plain.collect()} == set(pairs)
    assert alignment.agreement(plain, got).first().asDict() == {"both": 10, "only_first": 0, "only_second": 0, "conflicts": 0}


def test_patches_and_review(spark):
    base = spark.createDataFrame([("a", "x", 0.9, "nw"), ("b", "y", 0.8, "nw"), ("c", "z", 0.7, "nw-contexte")], "left_uuid string, right_uuid string, score double, source string")
    patch = spark.createDataFrame([(2, "a", "x", ""), (3, "b", "w", "incertaine"), (4, "", "z", "")], "line long, left_uuid string, right_uuid string, certitude string")
    assert sorted(values(links.apply_patch(base, patch), "left_uuid", "right_uuid", "score", "source"), key=str) == [("a", "x", 0.9, "manuel"), ("b", "w", None, "manuel-incertain")]
    assert links.patch_stats(base, patch).first().asDict() == {"overridden": 2, "manual_pairs": 2, "unmatched_left": 0, "unmatched_right": 1}
    assert links.validate(patch).count() == 0 and links.validate(patch.union(spark.createDataFrame([(5, "a", "", "")], patch.schema))).count() == 1
    rows = spark.createDataFrame([("nw", 0.9, 0.9, 0.88), ("nw", 0.9, 0.9, 0.5), ("nw-contexte", 0.85, None, None), ("nw-contexte", 0.6, None, None), ("candidate", 0.8, 0.8, 0.1), ("manuel", None, 0.5, 0.5)], "source string, score double, sim double, rival double")
    assert [(r["level"], len(r["reasons"])) for r in links.review(rows).collect()] == [(1, 1), (0, 0), (1, 1), (2, 1), (2, 1), (0, 0)]


def test_sections(spark):
    rows = [(10, "archi", "u1", False), (11, "archi", "u2", True), (12, "archi", "u3", True), (13, "archi", "u4", False), (14, "vins", "u5", True), (15, "vins", "u6", True)]
    df = spark.createDataFrame([("v", *r) for r in rows], "volume string, order int, section string, section_uuid string, section_inserted boolean")
    got = sections.continue_sections(df)
    assert values(got.orderBy("order"), "section_uuid") == ["u1", "u1", "u1", "u4", "u5", "u5"]
    assert values(sections.sections(got).orderBy("run"), "section_uuid", "entries") == [("u1", 3), ("u4", 1), ("u5", 2)]
    pairs = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("c", "z"), ("d", "")], "left_uuid string, right_uuid string")
    assert {(r["side"], r["uuid"]): r["group"] for r in sections.manual_groups(pairs).collect()} == {("left", "a"): "a", ("left", "b"): "a", ("right", "x"): "a", ("right", "y"): "a", ("left", "c"): "c", ("right", "z"): "c"}
    s = lambda ks: spark.createDataFrame([("p", i, k, "u") for i, k in enumerate(ks)], "pair string, run int, section string, section_uuid string")
    assert values(sections.align_sections(s(["architectes", "bains", "vins"]), s(["architecte", "vins"])).orderBy("left_run"), "left_run", "right_run") == [(0, 0), (2, 1)]
    keyed = spark.createDataFrame([(1, "left", "a", 1), (1, "left", "b", 2), (1, "right", "A", 1), (2, "left", "c", 3), (2, "right", "A", 3)], "group_rank int, side string, section string, left_rank int")
    assert {(r["side"], r["section"]): r["canonical"] for r in sections.canonical_keys(keyed).collect()} == {("left", "a"): "a", ("left", "b"): "a", ("left", "c"): "c", ("right", "A"): "c"}


def test_features(spark):
    df = spark.createDataFrame([("d", 0, "# **Titre** A", 1, "b1", "10 0 90 5"), ("d", 1, "*Abel* (J.), rue du Bac, 12.", 1, "b1", "10 0 90 5"), ("d", 2, "de la Croix-", 2, "b2", "20 0 60 5"), ("d", 3, "ROUGE", 2, "b2", "bad")], "document string, pos int, text string, page int, block string, box string")
    got = [dict(r["features"]) for r in features.with_features(df, features.group_names() + features.group_names("candidate")).orderBy("pos").collect()]
    assert got[0]["is_heading"] == "True" and got[0]["BOS"] == "True" and "prev_end" not in got[0] and got[3]["EOS"] == "True"
    assert got[3]["end_start"] == "hyphen→upper" and got[2]["prev_end"] == "period" and got[2]["is_page_start"] == "True"
    assert got[1]["italic"] == "partial" and got[1]["has_street_word"] == "True" and got[1]["ends_with_number"] == "True"
    assert got[3]["uppercase"] == "all" and got[2]["first_is_small_word"] == "True" and got[3]["block_indent"] == "missing" and got[2]["block_indent"] == "0"
    assert got[1]["same_block_as_prev"] == "missing" and got[2]["same_block_as_prev"] == "new_block" and got[1]["last_in_block"] == "True"
    with pytest.raises(ValueError):
        features.with_features(df, ["nothing"])
    placebo = features.with_features(df, features.group_names("placebo")).first()["features"]
    assert set(placebo) == {"placebo_constant", "placebo_random_1", "placebo_random_2", "placebo_random_3"}


def test_statistics(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(s), bool(p)) for i, (s, p) in enumerate(zip(rng.integers(0, 9, 200) / 10, rng.random(200) < 0.4, strict=True))]
    df = spark.createDataFrame(rows, "id int, score double, positive boolean")
    wins = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for _, a, p in rows if p for _, b, q in rows if not q])
    assert np.isclose(stats.auroc(df).first()["auroc"], wins)
    assert stats.auroc(df.where("positive")).first()["auroc"] is None
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for r in stats.review_capture(df.withColumnsRenamed({"score": "uncertainty", "positive": "error"}), [0.05, 0.3, 1.0]).collect():
        n = int(np.ceil(r["budget"] * 200))
        assert r["reviewed"] == n and np.isclose(r["share"], sum(x[2] for x in order[:n]) / sum(x[2] for x in rows))
    boot = stats.bootstrap(df.withColumn("page", F.col("id") % 40), "page", {"p": F.col("positive").cast("double"), "n": F.lit(1.0)}, {"rate": stats.ratio(F.col("p"), F.col("n"))}, 300).first()
    assert boot["low"] < boot["value"] < boot["high"] and boot["high"] - boot["low"] < 0.3
    empty = stats.calibration(spark.createDataFrame([(0.0, True), (0.1, False), (1.0, True)], "confidence double, correct boolean")).orderBy("low")
    assert values(empty, "low", "n") == [(0.0, 2), (0.9, 1)]


def test_sampling(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(100)], "id int, stratum string")
    got = sampling.draw(df, "stratum", spark.createDataFrame([("a", 15), ("b", 50)], "stratum string, quota int"), "id")
    assert {r["stratum"]: (r["n"], round(r["w"], 6)) for r in got.groupBy("stratum").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()} == {"a": (15, 75.0), "b": (25, 25.0)}
    folds = sampling.page_folds(spark.createDataFrame([("d", p) for p in range(7)], "document string, page int"), 3)
    assert values(folds.orderBy("page"), "fold") == [1, 1, 2, 2, 2, 3, 3]
    splits = sampling.leave_one_out(spark.createDataFrame([("x",), ("y",)], "volume string"))
    assert splits.where("role = 'test'").count() == 2 and splits.count() == 4
    assert sampling.leave_one_out(spark.createDataFrame([("x",)], "volume string")).count() == 0
    df = spark.createDataFrame([(1, "g", True), (2, "t", False), (3, "t", True), (4, "t", True), (5, "t", False)], "id int, text string, usable boolean")
    assert values(sampling.training_texts(df, spark.createDataFrame([("g",)], "text string")).orderBy("id"), "state") == ["gold", "unusable", "kept", "duplicate", "duplicate"]


def test_tagging(spark):
    df = spark.createDataFrame([(1, "*Abel*, md, rue du Bac, 12."), (2, "boom"), (3, "")], "id int, text string")

    def scorer(texts):
        if "boom" in texts:
            raise RuntimeError("bad text")
        return tagging.rule_scorer(texts)

    got = {r["id"]: r for r in tagging.predict(df, scorer, batch=2).collect()}
    assert [s["label"] for s in got[1]["spans"]] == ["SUBJ", "ADDR"] and got[2]["spans"] is None and got[2]["error"] == "bad text" and got[3]["spans"] == []
    spans = spark.createDataFrame([(1, 0, 10, "A"), (1, 0, 10, "A"), (1, 2, 5, "A"), (1, 2, 5, "B")], "id int, start int, end int, label string")
    assert sorted(values(tagging.prune_nested(spans), "start", "label")) == [(0, "A"), (2, "B")]
    scores = tagging.exact_scores(spans.where("label = 'A'"), spans.where("start = 2")).orderBy("label")
    assert values(scores, "label", "tp", "predicted", "gold") == [("A", 1, 1, 2), ("B", 0, 1, 0)]
    check = tagging.correction_problem(F.lit("<SUBJ>a</SUBJ>"), F.lit("b"), F.lit(True))
    assert one(spark, check) == "text has changed" and one(spark, tagging.correction_problem(F.lit("<SUBJ>a"), F.lit("a"), F.lit(True))).endswith("<SUBJ>")


def test_layers(spark):
    rows = [("r", 0, "w", "B-ENTRY", "far"), ("e", 0, "x", "B-ENTRY", " Un { a "), ("e", 1, "y", "SUB-ENTRY", "{ b"), ("t", 0, "z", "B-TITLE", "## T")]
    ln = spark.createDataFrame(rows, "uuid string, pos int, line string, class string, text string")
    ents = spark.createDataFrame([("d", "e", "t", "ENTRY", "Un { a\n{ b"), ("d", "t", keys.ROOT, "TITLE", "## T"), ("d", "q", "nowhere", "ENTRY", "lost"), ("other", "r", "t", "ENTRY", "far")], "document string, uuid string, parent_uuid string, entity string, markdown string")
    spans = spark.createDataFrame([("e", [(0, 2, "SUBJ", 1.0), (5, 6, "ADDR", 1.0)])], "uuid string, spans array<struct<start:int,end:int,label:string,score:double>>")
    got = {r["uuid"]: r for r in layers.structure(ents, ln, spans).collect()}
    assert got["e"]["kind"] == "group" and got["e"]["error"] is None and [len(m["inherited_spans"]) for m in got["e"]["members"]] == [1, 1]
    assert (got["t"]["level"], got["t"]["heading"]) == (2, "T") and got["q"]["error"] == "lines are missing" and got["r"]["error"] == "parent is no title"
    assert len({m["id"] for m in got["e"]["members"]}) == 2 and got["e"]["problems"] == [] and [m["lines"] for m in got["e"]["members"]] == [["x"], ["y"]]
    bare = layers.structure(ents, ln, spans.withColumn("spans", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (s["end"] + 3).alias("end"), F.lit("ADDR").alias("label"), s["score"].alias("score"))))).where("uuid = 'e'").first()
    assert {p["message"] for p in bare["problems"]} == {"span ADDR lies across a brace", "member without SUBJ, own or inherited"}
    told = layers.structure(ents, ln, spark.createDataFrame([("e", "<SUBJ>Un</SUBJ> { b")], "uuid string, tagged_text string")).where("uuid = 'e'").first()
    assert told["error"] == "tagged text differs from its text"
    built = layers.line_pieces(ln.where("uuid = 'e'")).join(spans, "uuid")
    objects = layers.span_objects(built).orderBy("start").collect()
    assert objects[0]["text"] == "Un" and objects[0]["pieces"][0].asDict() == {"line": "x", "start": 1, "end": 3}


def test_jobs_from_pages_to_layers(spark, tmp_path):
    raw = '<div data-bbox="0 0 9 9" data-label="Text"><h1><span>TITRE</span></h1></div><div data-bbox="0 0 9 9" data-label="Text"><span data-word-confidence="0.5 0.9">Abel, rue</span><span>du Bac, 12.</span></div>'
    import json

    (tmp_path / "v.1-2.ocr.json").write_text(json.dumps([{"page_index": 1, "page_box": [0, 0, 10, 10], "chunks": [], "raw": raw}]))
    extracted = jobs.extract(spark, str(tmp_path / "*.ocr.json"))
    assert values(extracted.orderBy("pos"), "uid", "markdown") == [("1.1.1", "# TITRE"), ("1.2.1", "Abel, rue"), ("1.2.2", "du Bac, 12.")]
    guess = {"1.1.1": "B-TITLE", "1.2.1": "B-ENTRY", "1.2.2": "I-ENTRY"}
    labelled = extracted.withColumn("prediction", F.create_map(*[F.lit(x) for p in guess.items() for x in p])[F.col("uid")])
    made = jobs.tabulate(labelled)
    assert values(made.table.where("douteuse = 'oui'"), "uid") == ["1.2.1"] and made.problems.count() == made.patch.count() == 0
    writes.write_csv(jobs.line_file(made.table), str(tmp_path / "t.csv"))
    built = jobs.assemble(jobs.read_lines(spark, str(tmp_path / "t.csv")))
    assert set(values(built, "entity", "markdown")) == {("TITLE", "# TITRE"), ("ENTRY", "Abel, rue du Bac, 12.")}
    tagged = jobs.tag(built)
    assert [s["label"] for s in tagged.table.where("entity = 'ENTRY'").first()["spans"]] == ["SUBJ", "ADDR"]
    layer = jobs.publish(jobs.tag_file(tagged.table), built, jobs.read_lines(spark, str(tmp_path / "t.csv")))
    assert layer.where("error is not null").count() == 0 and layer.count() == 2
    plan = writes.Plan(spark, apply=True)
    plan.table(str(tmp_path / "out.csv"), built.select("entity", "markdown").orderBy("entity"))
    assert plan.finish() and (tmp_path / "out.csv").read_text() == 'entity,markdown\nENTRY,"Abel, rue du Bac, 12."\nTITLE,# TITRE\n'
    plan.check("never", built)
    with pytest.raises(writes.Conflict):
        plan.finish()
    (tmp_path / "v" / "2-9").mkdir(parents=True)
    (tmp_path / "v" / "10-20").mkdir()
    for d in ("2-9", "10-20", ):
        (tmp_path / "v" / d / f"v.{d}.lines.csv").write_text("cle,apres\n a ,\n")
    assert values(pages.discover(spark, str(tmp_path), ".lines.csv"), "range_name") == ["2-9", "10-20"]
    patch = pages.read_patch(spark, str(tmp_path / "v" / "2-9" / "v.2-9.lines.csv"), ["cle", "note"])
    assert values(patch, "line", "cle", "note") == [(2, "a", "")]
    assert pages.read_patch(spark, str(tmp_path / "none.csv"), ["cle"]).count() == 0


def test_bad_page_files_fail(spark, tmp_path):
    (tmp_path / "x.ocr.json").write_text('[{"page_index": "no number"}]')
    with pytest.raises(Exception, match="not a list of pages"):
        pages.read_pages(spark, str(tmp_path / "x.ocr.json")).select("page_index").collect()


def test_reports():
    assert writes.markdown_table(["a", "b"], [(1.5, "x|y"), (None, 2)]) == "| a | b |\n|---|---|\n| 1.500 | x\\|y |\n|  | 2 |"
    assert writes.csv_text(["a"], [(None,), ("x;y",)], ";") == 'a\n""\n"x;y"\n'

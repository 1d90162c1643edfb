"""Values that run over long sequences are the same, whatever the size of a block; records; components."""

import random

import pytest
from pyspark.sql import functions as F

from foliospark.functions.text import casefold, squeeze, title_key, without_emphasis
from foliospark.operators import annotation, blocks, graph, links, sections
from foliospark.sources import pages


def sequence(spark, n=40):
    rng = random.Random(3)
    rows = [(v, k, rng.choice([None, "a", "b"]), rng.randint(-3, 5)) for v in ("x", None) for k in sorted(rng.sample(range(200), n))]
    return rows, spark.createDataFrame(rows, "volume string, order long, value string, n int")


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_running_values(spark, size):
    rows, df = sequence(spark)
    got = blocks.lagged(df, ["volume"], "order", {"value": "before", "order": "last"}, size)
    got = blocks.running_sum(got, ["volume"], "order", F.col("n"), "sum", size)
    got = blocks.filled(got, ["volume"], "order", "value", "filled", size)
    got = blocks.numbered(got, ["volume"], "order", ["n"], "number", size)
    found = {(r["volume"], r["order"]): r for r in got.collect()}
    assert len(found) == len(rows) == got.count()
    for v in ("x", None):
        last = total = number = 0
        before = place = None
        for _, k, value, n in sorted((r for r in rows if r[0] == v), key=lambda r: r[1]):
            total, number, last = total + n, number + 1, value if value is not None else last or None
            r = found[v, k]
            assert (r["before"], r["last"], r["sum"], r["filled"], r["number"]) == (before, place, total, last, number)
            before, place = value, k


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_joins_and_runs_do_not_hang_on_blocks(spark, size):
    side = lambda s, n: spark.createDataFrame([("v", f"{s}{k}", k) for k in range(n)], "volume string, uuid string, order int")
    made = lambda pairs: spark.createDataFrame([("v", a, b, 1.0, "nw") for a, b in pairs], "volume string, left_uuid string, right_uuid string, score double, source string")
    order = lambda df: [(r["left_uuid"], r["right_uuid"]) for r in df.orderBy("rank").collect()]
    got = order(links.natural_join(made([("l2", "r1"), ("l3", "r3")]), side("l", 4), side("r", 5), size=size))
    assert got == [("l0", None), ("l1", None), (None, "r0"), ("l2", "r1"), (None, "r2"), ("l3", "r3"), (None, "r4")]
    got = order(links.natural_join(made([("l0", "r1"), ("l1", "r0")]), side("l", 2), side("r", 3), size=size))
    assert got == [("l0", "r1"), (None, "r2"), ("l1", "r0")]
    rows = [("v", k, s, u, i) for k, (s, u, i) in enumerate([("a", "1", False), ("a", "2", True), ("a", "3", True), ("b", "4", True), ("b", "5", False), ("", "", False), ("", "6", True), (None, None, False)])]
    df = spark.createDataFrame(rows, "volume string, order int, section string, section_uuid string, section_inserted boolean")
    assert [r["section_uuid"] for r in sections.continue_sections(df, size).orderBy("order").collect()] == ["1", "1", "1", "4", "5", "", "6", None]
    assert [r["run"] for r in sections.runs(df, size).orderBy("order").collect()] == [0, 1, 2, 3, 4, 5, 6, 7]
    assert sections.runs(df.limit(0), size).count() == 0


def test_records_of_a_volume(spark):
    rows = [("v", 10, 0, "t2", "root", "TITLE", "## Médecins", "", "10"), ("v", 10, 1, "e3", "t2", "ENTRY", "x", "<SUBJ>C</SUBJ>", "10"), ("v", 2, 0, "e0", "root", "ENTRY", "x", "A", "2"), ("v", 2, 1, "t1", "root", "TITLE", "# AGENS de change.", "", "2"), ("v", 2, 5, "e1", "t1", "ENTRY", "x", "**B**", "3")]
    df = spark.createDataFrame(rows, "volume string, range_first int, pos int, uuid string, parent_uuid string, entity string, markdown string, tagged_text string, page string")
    got = pages.read_records(df, title_key, lambda t: squeeze(without_emphasis(t))).orderBy("order").collect()
    assert [(r["order"], r["uuid"], r["section"], r["text"]) for r in got] == [(0, "e0", "", "A"), (1, "e1", "agens de change", "B"), (2, "e3", "medecins", "<SUBJ>C</SUBJ>")]
    twice = pages.read_records(df.union(df.where("uuid = 'e1'").withColumn("pos", F.lit(7))), title_key, squeeze)
    assert [(r["uuid"], r["times"]) for r in pages.repeated_uuids(twice).collect()] == [("e1", 2)]


def test_components(spark):
    rng = random.Random(5)
    pairs = [(f"n{rng.randint(0, 80):03}", f"n{rng.randint(0, 80):03}") for _ in range(45)] + [(f"p{k:03}", f"p{k + 1:03}") for k in rng.sample(range(60), 60)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_sections_by_hand_and_by_key(spark):
    side = lambda *names: spark.createDataFrame([("p", k, s, f"{names[0]}{k}") for k, s in enumerate(names[1:])], "pair string, run int, section string, section_uuid string")
    left, right = side("l", "arts", "bois", "vins"), side("r", "arts", "boulangers", "bois a bruler", "vins")
    patch = spark.createDataFrame([("l1", "r1"), ("l1", "r2"), ("l2", "")], "left_uuid string, right_uuid string")
    got = {(r["left_run"], r["right_run"], r["source"]) for r in sections.align_pair(left, right, patch).collect()}
    assert got == {(0, 0, "auto"), (1, 1, "manual"), (1, 2, "manual")}
    assert {(r["left_run"], r["right_run"]) for r in sections.align_pair(left, right).collect()} == {(0, 0), (1, 2), (2, 3)}


def test_casefold(spark):
    rows = spark.createDataFrame([("ſaint",), ("Straße",), ("ABC",), (None,), ("Éa",)], "t string")
    assert [r["v"] for r in rows.select(casefold(F.col("t")).alias("v")).collect()] == ["saint", "strasse", "abc", None, "éa"]


def test_lines_to_annotate(spark):
    rows = spark.createDataFrame([("d", 0, "k0", " a "), ("d", 1, "k1", " "), ("d", 2, "k2", "b"), ("d", 3, "k3", None)], "document string, pos int, key string, text string")
    got = annotation.annotatable(rows).orderBy("pos").collect()
    assert [(r["text"], r["source_row"], r["follows_blank"], r["error"]) for r in got] == [("a", 1, False, None), ("b", 2, True, None), (None, 3, False, "line without a text")]
    lines = annotation.annotatable(rows.where("text is not null"))
    bound = annotation.source_hash(lines)
    assert annotation.stale_sessions(bound, lines).count() == 0
    assert annotation.stale_sessions(bound, lines.withColumn("key", F.lit("x"))).first()["problem"] == "the lines have changed"
    state = spark.createDataFrame([("d", 2, "B-ENTRY", "t")], "document string, pos int, label string, time string")
    assert [r["label"] for r in annotation.restored(state, lines).orderBy("pos").collect()] == [None, "B-ENTRY"]

"""Alignment of editions against plain versions: every pair compared, every path tried."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.functions import similarity as SI
from foliospark.operators import alignment as A
from foliospark.operators import extraction, linking, links, sections, sequence
from foliospark.plans.alignment_queries import _records, two_years
from foliospark.plans.catalogue import QUERIES


def rows_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["segment"], r["order"], r["uuid"])):
        out.setdefault(r["segment"], []).append(r)
    return out


def plain_links(left, right, params):
    """Links of one task per segment, from a full matrix made pair by pair."""
    found = set()
    for segment in left.keys() & right.keys():
        a, b = left[segment], right[segment]
        sims = np.array([[SI.pair((x["subj"], x["text"]), (y["subj"], y["text"]), params.weight) for y in b] for x in a], dtype=np.float32)
        ordered = sequence.align(sims, params.threshold)
        rest = sequence.residual(sims, ordered, np.float32(params.residual))
        for kind, pairs in ((A.ORDERED, ordered), (A.RESIDUAL, rest)):
            found |= {(segment, a[i]["uuid"], b[j]["uuid"], round(float(sims[i, j]), 5), kind) for i, j in pairs}
    return found


@pytest.mark.parametrize("sides", [lambda s, d: (_records(s, d, 0), _records(s, d, 1)), two_years])
def test_ordered_links_against_all_pairs(spark, sf_dir, sides):
    params = A.Params(context=False)
    left, right = sides(spark, sf_dir)
    got = {(r["segment"], r["left_uuid"], r["right_uuid"], round(r["score"], 5), r["source"]) for r in A.align(left, right, params)[0].collect()}
    assert got == plain_links(rows_of(left), rows_of(right), params) and got


def test_editions_find_their_records(spark, sf_dir):
    """Nearly all records that both years have, and hardly any other."""
    got = [(r["left_uuid"], r["right_uuid"]) for r in QUERIES["editions_aligned"](spark, sf_dir).collect()]
    right = sum(a[1:] == b[1:] for a, b in got)
    expected = two_years(spark, sf_dir)[1].count()
    assert right > 0.95 * expected and right > 0.97 * len(got) and len({a for a, _ in got}) == len({b for _, b in got}) == len(got)


def test_context_links_are_those_of_the_fitted_model(spark, sf_dir):
    """Windows decoded one by one with the model that was fitted over all of them."""
    left, right = _records(spark, sf_dir, 0), _records(spark, sf_dir, 1)
    found, fitted = A.align(left, right)
    assert all(b >= a - 1e-6 for a, b in itertools.pairwise(fitted.likelihoods))
    got = {(r["segment"], r["left_uuid"], r["right_uuid"]) for r in found.where(F.col("source") == A.CONTEXT).collect()}
    want, params = set(), A.Params()
    a, b = rows_of(left), rows_of(right)
    for segment in a.keys() & b.keys():
        x, y = a[segment], b[segment]
        sims = np.array([[SI.pair((p["subj"], p["text"]), (q["subj"], q["text"])) for q in y] for p in x], dtype=np.float32)
        ordered = sequence.align(sims, params.threshold)
        rest = sequence.residual(sims, ordered, np.float32(params.residual))
        anchors = [(i, j) for i, j in ordered if sims[i, j] >= np.float32(params.anchor)]
        for rows, cols in sequence.windows(anchors, len(x), len(y), rest):
            if rows and cols:
                p = sequence.posteriors(sims[np.ix_(rows, cols)], fitted.transitions, fitted.same, fitted.different)[0]
                want |= {(segment, x[rows[i]]["uuid"], y[cols[j]]["uuid"]) for i, j in sequence.decode(p)}
    assert got == want


def test_sections_in_order_against_all_pairs(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    sides = [c.where(F.col("c_custkey") % 2 == odd).orderBy("c_custkey").collect() for odd in (0, 1)]
    want = set()
    for nation in {r["c_nationkey"] for r in sides[0]}:
        a, b = ([r for r in side if r["c_nationkey"] == nation] for side in sides)
        sims = np.array([[SI.jaro_winkler(x["c_mktsegment"], y["c_mktsegment"]) for y in b] for x in a]).reshape(len(a), len(b))
        want |= {(nation, a[i]["c_custkey"], b[j]["c_custkey"]) for i, j in sequence.align(sims, sections.THRESHOLD)}
    assert {(r["pair"], r["left_run"], r["right_run"]) for r in QUERIES["section_alignment"](spark, sf_dir).collect()} == want


def test_learned_links_find_their_records(spark, sf_dir):
    got = [(r["left_uuid"], r["right_uuid"]) for r in QUERIES["learned_links"](spark, sf_dir).collect()]
    assert len(got) > 100 and sum(a[1:] == b[1:] for a, b in got) > 0.95 * len(got)
    left, right = two_years(spark, sf_dir)
    pairs = linking.compared(left, right)
    every = {(r["left_uuid"], r["right_uuid"]) for r in pairs.collect()}
    a, b = rows_of(left), rows_of(right)
    for segment in a.keys() & b.keys():
        for x in a[segment]:
            for y in b[segment]:
                assert SI.pair((x["subj"], x["text"]), (y["subj"], y["text"])) < linking.BLOCK or (x["uuid"], y["uuid"]) in every
    with pytest.raises(ValueError):
        linking.learn(pairs.withColumn("match", F.lit(0)))


def test_row_kernels():
    """Whole rows of similarities against pair by pair, with texts of several words, of none and beyond the table."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé -") for _ in range(n)) for n in (0, 1, 2, 5, 12, 63, 64, 65, 130, 200, 600) for _ in range(4)]
    numbers = SI._numbers(texts)
    signs = SI.Signs(texts, numbers)
    short = np.flatnonzero(signs.lengths <= SI.LONGEST)
    for k in range(len(texts)):
        for at in (np.arange(len(texts)), short):
            assert SI.indel_row(signs, k, signs, at).tolist() == [SI.indel(texts[k], texts[j]) for j in at]
        own = np.array([j for j in short if texts[j]])
        if texts[k]:
            assert SI.jaro_winkler_row(signs, k, signs, own).tolist() == [SI.jaro_winkler(texts[k], texts[j]) for j in own]
    records = [(rng.choice(texts[:20])[:15], rng.choice(texts)) for _ in range(60)]
    full = SI.matrix(records[:30], records[30:])
    for least in (0.3, 0.6, 0.9):
        part = SI.matrix(records[:30], records[30:], least=least)
        assert (part[full >= least] == full[full >= least]).all() and ((part == 0) | (part == full)).all()


def test_rivals_and_mutual_best(spark):
    rng = random.Random(4)
    pairs = [("s", i, j, rng.choice([0.25, 0.5, 0.75])) for i in range(6) for j in range(5) if rng.random() < 0.8]
    df = spark.createDataFrame(pairs, "segment string, i int, j int, sim double")
    got = {(r["i"], r["j"]): r["rival"] for r in links.rivals(df).collect()}
    for _, i, j, _ in pairs:
        assert got[i, j] == max([s for _, a, b, s in pairs if (a == i) != (b == j)], default=0.0)
    best = {(r["i"], r["j"]) for r in links.mutual_best(df).collect()}
    want = set()
    for _, i, j, s in pairs:
        row = min((-t, b) for _, a, b, t in pairs if a == i)
        column = min((-t, a) for _, a, b, t in pairs if b == j)
        if row == (-s, j) and column == (-s, i):
            want.add((i, j))
    assert best == want


def test_blocks_of_all_pages(spark, sf_dir):
    """The markup of whole pages, block by block, against what was put into it."""
    parts = [["plain words", "two  blanks"], ["<i>it</i> and <b>bo</b>"], ["<em>e</em>", "a<br>b", "&lt;x&gt;"], []]
    want = [["plain words", "two blanks"], ["*it* and **bo**"], ["*e*", "a b", "<x>"], []]
    page = "".join('<div data-bbox="0 0 10 10" data-label="Text">' + "".join(f"<span>{x}</span>" for x in p) + "</div>" for p in parts)
    df = spark.createDataFrame([("d", 1, page), ("e", 1, None), ("f", 2, "")], "document string, page_index int, raw string")
    rows = extraction.page_lines(df).orderBy("pos").collect()
    assert [r["markdown"] for r in rows] == [x for p in want for x in p] and [r["uid"] for r in rows][:3] == ["1.1.1", "1.1.2", "1.2.1"]
    got = QUERIES["html_blocks"](spark, sf_dir)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    import re

    count = sum(1 for p in pages for x in re.findall(r"(?s)<p[^>]*>(.*?)</p>", p["html"] or "") if re.sub(r"<[^>]+>", "", re.sub(r"(?i)</?(?:div|span)[^>]*>", "", x)).replace("&nbsp;", " ").strip())
    assert got.where("error is null").count() == count

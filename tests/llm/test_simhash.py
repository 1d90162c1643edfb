import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import simhash as S
from foliospark.llm.components import components
from tests.llm.conftest import AWKWARD


def plain_print(text, width):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if grams else 0


def groups(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("radius, bits", [(0, 64), (3, 64), (4, 64), (11, 64), (54, 256)])
def test_bit_sliced_counts(radius, bits):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2, bits, dtype=np.uint8)
    rows = np.array([np.where(rng.random(bits) < rng.choice([0.02, 0.06, 0.2, 0.5]), 1 - base, base) for _ in range(150)], dtype=np.uint8)
    want = (rows[:40, None, :] != rows[None, :, :]).sum(axis=2) <= radius
    assert (S.within(S._planes(rows), rows[:40], radius, len(rows)) == want).all()
    far = rng.integers(0, 2, (5, bits), dtype=np.uint8)
    assert (S.within(S._planes(rows), far, radius, len(rows)) == ((far[:, None, :] != rows[None]).sum(axis=2) <= radius)).all()


def test_exact_masks_lose_no_pair():
    rng = random.Random(4)
    for rows in (10, 1 << 30, 1 << 40):
        masks = [int(m[0]) for m in S.exact_masks(4, rows)]
        for _ in range(500):
            flipped = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not flipped & m for m in masks)


@pytest.mark.parametrize("part", [S.PART, 5])
def test_links_against_brute_force(spark, part):
    """Groups around some centres, split buckets included."""
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(25)} | {rng.getrandbits(64) for _ in range(80)})
    rows = [(i, [p - (1 << 64) if p >> 63 else p]) for i, p in enumerate(prints)]
    edges = S.link_edges(spark.createDataFrame(rows, "id long, prints array<long>"), S.exact_masks(4, len(rows)), 4, part=part)
    got = groups(len(prints), [(r["a"], r["b"]) for r in edges.collect()])
    want = groups(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    assert got == want


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = groups(500, pairs)
    assert all(got.get(i, i) == want[i] for i in range(500))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark, awkward, empty):
    got = S.near_components(awkward).collect()
    assert len(got) == awkward.count()
    for r in got:
        text = "no id at all" if r["id"] is None else AWKWARD[r["id"]]
        assert r["print"] & ((1 << 64) - 1) == plain_print(text, 4)
    by = defaultdict(set)
    for r in got:
        by[r["id"]].add(r["component"])
    assert by[0] == by[1] == by[2] == {0} and by[4] == by[5] == {4} and by[None] == {None}
    assert S.near_components(empty).count() == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_repeated_and_null_ids(spark, monkeypatch):
    """Fingerprints are given as texts: rows of one id are no vertex, and rows without an id join others."""
    monkeypatch.setattr(S, "fingerprint", lambda text, width: F.array(text.cast("long")))
    rng = random.Random(11)
    a, b = rng.getrandbits(64), rng.getrandbits(64)
    near = lambda x, *bits: x ^ sum(1 << i for i in bits)
    rows = [(1, near(a, 1)), (7, a), (7, b), (9, near(b, 2))]
    bridge = rng.getrandbits(64)
    rows += [(20, near(bridge, 1, 2, 3)), (None, bridge), (21, near(bridge, 4, 5, 6)), (None, rng.getrandbits(64))]
    df = spark.createDataFrame([(i, str(signed(p))) for i, p in rows], "doc_id long, text string")
    got = sorted(((r["id"] or -1, r["print"], r["component"]) for r in S.near_components(df).collect()), key=str)
    want = [(1, 1), (7, 1), (7, 7), (9, 7), (20, 20), (-1, 20), (21, 20), (-1, None)]
    assert got == sorted(((i, signed(p), c) for (_, p), (i, c) in zip(rows, want, strict=True)), key=str)
    # drawn rows, against plain groups
    prints = [c ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for c in (a, b, bridge) for _ in range(20)]
    ids = [rng.choice([None, *range(12)]) for _ in prints]
    root = groups(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    name = {r: min((i for i, q in zip(ids, root, strict=True) if q == r and i is not None), default=None) for r in root}
    df = spark.createDataFrame([(i, str(signed(p))) for i, p in zip(ids, prints, strict=True)], "doc_id long, text string")
    got = sorted(((r["id"], r["print"], r["component"]) for r in S.near_components(df).collect()), key=str)
    assert got == sorted(((i, signed(p), name[r]) for i, p, r in zip(ids, prints, root, strict=True)), key=str)


def test_drop_near_copies(spark, awkward, empty):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(30):
        base = rng.choices(words, k=rng.randint(60, 400))
        texts.append(base)
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
        half = base[: len(base) // 2] + rng.choices(words, k=len(base) // 2)
        texts.append(half)  # shares a long passage, and is no copy
    sets = [set(zip(*[t[i:] for i in range(5)], strict=False)) for t in texts]
    want = groups(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    docs = spark.createDataFrame([(i, " ".join(t), len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    kept = S.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(want)
    out = S.drop_near_copies(awkward)
    assert out.columns == awkward.columns
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in out.collect()) == [-1, 0, 3, 4, 6, 7, 8, 9]
    assert S.drop_near_copies(empty).count() == 0


def test_similar_links_against_brute_force(spark):
    rng = random.Random(12)
    sets = []
    for _ in range(12):
        base = rng.sample(range(10**6), rng.randint(1, 60))
        sets += [np.unique(np.array([rng.randrange(10**6) if rng.random() < 0.07 else x for x in base], dtype=np.uint64)) for _ in range(12)]
    plain = [set(s.tolist()) for s in sets]
    want = groups(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if len(plain[i] & plain[j]) / len(plain[i] | plain[j]) >= 0.8])
    assert groups(len(sets), S.similar_links(sets, 0.8)) == want
    for labels in (list(range(len(sets))), [w if i % 3 else i for i, w in enumerate(want)]):
        joined = [(i, w) for i, w in enumerate(labels) if i != w]
        assert groups(len(sets), S.similar_links(sets, 0.8, labels) + joined) == want
        rows = spark.createDataFrame([(i, labels[i], 0, s.tolist()) for i, s in enumerate(sets)], "node long, label long, root long, set array<long>")
        for rows_at_a_time, size in ((1024, 1 << 20), (20, 1 << 20), (1024, 5000)):
            edges = S.checked_edges(rows, 0.8, rows_at_a_time, size).collect()
            assert groups(len(sets), [(r["a"], r["b"]) for r in edges] + joined) == want


def test_copies_that_only_the_original_joins(spark):
    """1200 copies, each at 0.8 to one original, and below to each other."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    texts = [base]
    for k in range(1200):
        copy = list(base)
        for e, at in enumerate(rng.sample(range(5, 195, 6), 4)):
            copy[at] = f"x{k}.{e}"
        texts.append(copy)
    sets = [set(zip(*[t[i:] for i in range(5)], strict=False)) for t in texts]
    assert all(len(sets[0] & s) >= 0.8 * len(sets[0] | s) for s in sets)
    assert sum(len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[1:], sets[2:], strict=False)) < 20
    order = rng.sample(range(len(texts)), len(texts))
    docs = spark.createDataFrame([(i, " ".join(texts[k])) for i, k in enumerate(order)], "doc_id long, text string")
    assert [r["doc_id"] for r in S.drop_near_copies(docs).collect()] == [0]


def test_near_copies_have_a_key_in_common():
    """Pairs at 0.8 and little above, keys chosen by an order that is drawn anew."""
    rng = random.Random(3)
    for n in [*range(1, 40), 196, 1000]:
        for _ in range(40):
            both = -(-4 * n // 5)
            left, right = rng.randint(0, n - both), rng.randint(0, n - both)
            if both < 0.8 * (both + left + right):
                right = 0
            drawn = rng.sample(range(10**7), both + left + right)
            pair = [sorted(drawn[: both + left]), sorted(drawn[:both] + drawn[both + left :])]
            salt = rng.random()
            keys = []
            for own in pair:
                looked, kept, needed = S.least_hashes(len(own), 0.8)
                keys.append((set(sorted(own[:looked], key=lambda x: hash((x, salt)))[:kept]), needed))
            assert len(keys[0][0] & keys[1][0]) >= min(keys[0][1], keys[1][1]) >= 1


def test_no_near_copy_is_missed(spark):
    """600 pairs at 0.8 or little above: of eight and nine words, and of 200 with an end that differs. A line is in all long ones."""
    rng = random.Random(5)
    line = [f"l{i}" for i in range(40)]
    texts = []
    for k in range(300):
        base = [f"s{k}.{i}" for i in range(9)]
        texts += [base[:8], base]
    for k in range(300):
        base = [*line, *(f"t{k}.{i}" for i in range(148))]  # 184 shingles of five words, 164 of them in the other one
        texts += [base, [*base[:-20], *(f"u{k}.{i}" for i in range(20))]]
    sets = [set(zip(*[t[i:] for i in range(5)], strict=False)) for t in texts]
    assert all(len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True))
    order = rng.sample(range(len(texts)), len(texts))
    docs = spark.createDataFrame([(i, k, " ".join(texts[k])) for i, k in enumerate(order)], "doc_id long, k long, text string")
    assert sorted(r["k"] // 2 for r in S.drop_near_copies(docs).collect()) == list(range(600))


@pytest.mark.parametrize("pair_rows", [2, 16])
def test_near_edges_against_brute_force(spark, pair_rows):
    """Groups of one text's copies with few and many edits, common lines, short texts: all ways to a link are used."""
    rng = random.Random(21)
    lines = [[f"line{k}.{i}" for i in range(25)] for k in range(3)]
    texts = []
    for g in range(12):
        base = [f"g{g}.{i}" for i in range(rng.choice([4, 6, 9, 30, 80, 150]))] + rng.choice(lines)
        for _ in range(rng.choice([1, 2, 6, 25])):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = f"x{rng.random()}"
            texts.append(copy)
    texts += [rng.choice(lines) + [f"own{k}"] for k in range(10)]
    sets = [set(zip(*[t[i:] for i in range(5)], strict=False)) or {tuple(t)} for t in texts]
    want = groups(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8])
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "node long, text string")
    nodes = df.select("node", S._read(5, 0.8)(F.col("text")).alias("s")).select("node", "s.*")
    own = df.select("node", S._sets(5)(F.col("text")).alias("set"))
    edges = [(r["a"], r["b"]) for r in S.near_edges(nodes, S.shared_keys(nodes), own, pair_rows=pair_rows).collect()]
    assert all(len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8 for a, b in edges)
    # nodes of equal sets are one node in use; here they may stay apart only if no key tells them
    assert groups(len(texts), edges) == want


def test_columns_of_any_name_and_type(spark):
    names = ["kept_id", "__kept_id_0", "__kept_tie_0", "id", "tie", "a.b", "Node", "set"]
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six"), (3, "other"), (3, "other"), (None, None)], "doc_id long, text string")
    for c in names:
        docs = docs.withColumn(c, F.lit(c))
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.lit(1))).withColumn("deep", F.array(F.struct(F.create_map(F.lit("k"), F.lit(1)).alias("x"))))
    out = S.drop_near_copies(docs)
    assert out.columns == docs.columns
    rows = sorted(out.collect(), key=str)
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "3", "None"]
    assert all(r[c] == c for r in rows for c in names) and all(r["m"] == {"k": 1} for r in rows)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text")).collect()
    prints = [plain_print(r["text"], 4) for r in rows]
    ids = [r["doc_id"] for r in rows]
    want = groups(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.op6_simhash(spark, sf_dir).collect()}
    assert got == {d: (f"{p:016x}", ids[w]) for d, p, w in zip(ids, prints, want)}

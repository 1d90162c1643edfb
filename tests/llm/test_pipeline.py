import math
from hashlib import md5

from pyspark.sql import functions as F

import corpus_pipeline as P
from foliospark.llm.common import _WRITTEN, materialize, words_of
from foliospark.llm.mixing import OTHER, SEED, WEIGHTS
from foliospark.llm.quality import train
from tests.llm.test_simhash import groups


def read_sets(texts):
    """Shingles of five words, or the whole sequence, of each text."""
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

    # what the model's scores are is tested against a plain version of its own
    good = materialize(P.quality(spark, docs, sf_dir), "t")
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {d for d, r in rows.items() if model.score((r["text"] or "").encode()) >= 0.3}

    unique = materialize(P.near_dedup(spark, good, sf_dir), "t")
    assert unique.columns == docs.columns
    ids = sorted(r["doc_id"] for r in good.collect())
    sets = read_sets([rows[d]["text"] for d in ids])
    holders = {}
    for k, s in enumerate(sets):
        for x in s or [()]:
            holders.setdefault(x, []).append(k)
    met = {(a, b) for own in holders.values() for i, a in enumerate(own) for b in own[:i]}
    near = [(a, b) for a, b in met if not sets[a] | sets[b] or len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    want = groups(len(ids), near)
    assert len(set(want)) < len(ids)
    assert {r["doc_id"] for r in unique.collect()} == {ids[k] for k in set(want)}

    clean = materialize(P.decontamination(spark, unique, sf_dir), "t")
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words_of(r["text"].encode())
        windows |= {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    after = {r["doc_id"]: r for r in clean.collect()}
    for d, t in before.items():
        w = words_of(t.encode())
        hits = {p for i in range(len(w) - 12) if tuple(w[i : i + 13]) in windows for p in range(i, i + 13)}
        assert (d in after) == (not hits or len(hits) < 0.05 * len(w))
        if not hits:
            assert after[d]["text"] == t
        elif d in after:
            assert words_of(after[d]["text"].encode()) == [x for p, x in enumerate(w) if p not in hits] and after[d]["n_chars"] == len(after[d]["text"])

    mixed = materialize(P.mixing(spark, clean, sf_dir), "t")
    assert mixed.columns == docs.columns
    sizes, pool = {}, lambda r: r["source"] if r["source"] in WEIGHTS else None
    for r in after.values():
        sizes[pool(r)] = sizes.get(pool(r), 0) + len(r["text"] or "")
    share, total, counts = sum(WEIGHTS.values()) + OTHER, sum(sizes.values()), {}
    for d, r in after.items():
        size = sizes[pool(r)]
        rate = WEIGHTS.get(r["source"], OTHER) / share * total / size if size else 0.0
        steps = max(1, math.ceil(rate / 8))
        n = 0
        for j in range(1, steps + 1):
            u = (int(md5(f"{SEED}:{d}:{j}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            p = below = math.exp(-rate / steps)
            k = 0
            while below <= u:
                k += 1
                p *= rate / steps / k
                below += p
            n += k
        counts[d] = n
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in counts.items() if n}

    dealt = P.sharding(spark, mixed, sf_dir).collect()
    assert len(dealt) == mixed.count()
    for r in dealt:
        draws = [int(md5(f"{r['doc_id']}/{s}".encode()).hexdigest()[:13], 16) for s in range(8)]
        assert r["shard"] == draws.index(max(draws))


def test_run(spark, sf_dir):
    before = set(_WRITTEN)
    out = P.run(spark, sf_dir)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"] and out.count() > 50
    assert len(set(_WRITTEN) - before) == 1  # what the last stage reads


def test_awkward_rows(spark, awkward, empty, sf_dir):
    """All five stages, one after the other and each on all rows: columns of any name and type come through unchanged."""
    for docs in (awkward, empty):
        names, kinds = docs.columns, dict(docs.dtypes)
        whole = docs
        for name, stage in P.STAGES:
            for start in (docs, whole):
                out = materialize(stage(spark, start, sf_dir), "t")
                assert out.columns == (names if name != "sharding" else [*names, "shard_1"]) and {c: k for c, k in out.dtypes if c in kinds} == kinds
                for r in out.collect():
                    assert all(r[c] == "kept" for c in ("score", "copy", "Order_Key", "a.b", "copy.x", "__kept_id", "__kept_tie", "tie", "id")) and r["tags"] == {"k": "kept"}
            docs = out if name != "sharding" else docs
        assert (docs.count() == 0) == (whole.count() == 0)

import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import quality as Q
from foliospark.llm import toxicity as T
from foliospark.llm.sampling import labelled_sample

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("query, label, folds, held, least_auc, least_accuracy", [(Q.op9_quality, "quality", 5, 0, 0.99, 0.98), (T.op10_toxicity, "toxic", 3, 1, 0.94, 0.96)])
def test_held_out(spark, query, label, folds, held, least_auc, least_accuracy):
    rows = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").toPandas()
    assert len(rows) == 10000 and rows["score"].between(0, 1).all()
    assert (rows["held_out"] == [zlib.crc32(str(d).encode()) % folds == held for d in rows["doc_id"]]).all()
    out = rows[rows["held_out"] & rows[label].notna()]
    assert auc(out[label].to_numpy(), out["score"].to_numpy()) > least_auc
    assert (out["predicted"] == out[label]).mean() > least_accuracy


def test_views():
    assert Q.wording("Ab  C\nÉ 1".encode()) == "ab c É 1".encode()
    assert Q.skeleton(b"Abc abc DEF!! 12") == b"Aa a A! 9"
    assert Q.skeleton(b"x x x y") == b"a =1 =2 a"
    assert Q.skeleton(b"") == b"" == Q.skeleton(b" \n ") == Q.wording(b" \n ")


def test_texts_that_differ_in_words_only():
    """One skeleton for all: only the dictionaries of words can tell."""
    rng = np.random.default_rng(1)
    words = [["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(25)] for _ in range(2)]
    texts, labels = [], []
    for i in range(200):
        y = i % 2
        texts.append(" ".join(rng.choice(words[y] if rng.random() < 0.6 else words[0] + words[1]) for _ in range(40)).encode())
        labels.append(y)
    # neighbours never repeat a word, so that all skeletons are alike
    texts = [b" ".join(w for k, w in enumerate(t.split()) if not k or w != t.split()[k - 1]) for t in texts]
    model = Q.fit(texts[:150], labels[:150], {0: 75, 1: 75})
    assert auc(np.array(labels[150:]), np.array([model.score(t) for t in texts[150:]])) > 0.9


def test_quality_against_a_plain_version():
    """Each block compressed by a compressor of its own, dictionaries cut by a plain loop, the curve by its formula."""
    import zstandard

    rng = np.random.default_rng(3)
    say = lambda y: " ".join(rng.choice(["tin", "PAN", "x9!", "y"] if y else ["alpha", "beta", "gamma."]) for _ in range(rng.integers(0, 90)))
    texts, labels = [say(i % 2).encode() for i in range(60)], [i % 2 for i in range(60)]
    bounds = dict(dictionary=700, least_slice=40, most_slice=90)
    model = Q.fit(texts, labels, {0: 30, 1: 30}, **bounds)

    def dictionary(view, y):
        seen = [v for t in [t for t, k in zip(texts, labels, strict=True) if k == y][::2] if (v := view(t))]
        n = min(len(seen), 700 // 41)
        length = min(90, 700 // n - 1)
        out = []
        for k in range(n):
            own = seen[k * len(seen) // n]
            at = k * 977 % max(1, len(own) - length + 1)
            out.append(own[at : at + length])
        return b"\n".join(out)[:700]

    def size(data, content):
        total = 0
        for at in range(0, max(1, len(data)), 128):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=3)
            total += len(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(data[at : at + 128]))
        return total

    for t in [*texts[:12], b"", b"tin pan " * 100]:
        x = model.shift
        for view, slope in zip(Q.VIEWS, model.slopes, strict=True):
            bad, good = (size(view(t), dictionary(view, y)) for y in (0, 1))
            x += slope * (bad - good) / (bad + good + 80)
        assert abs(model.score(t) - 1 / (1 + math.exp(-x))) < 1e-12


def test_toxicity_against_a_plain_version():
    """Terms by plain hashing, and all pairs one by one."""
    rng = np.random.default_rng(7)
    vocabulary = [f"word{i}" for i in range(50)] + ["éclat", "straße", "a"]
    texts = [" ".join(rng.choice(vocabulary, 12)).encode() for _ in range(300)]
    labels = [int(b"word1 " in t or b"word2 " in t) for t in texts]
    model = T.fit(texts, labels, {0: labels.count(0), 1: labels.count(1)})
    assert len(model.place) > 1 and np.abs(model.factors).max() > 0

    def score(text):
        terms = set()
        for w in text.decode().translate({i: i + 32 for i in range(65, 91)}).split():
            names = ["w:" + w, *("p:" + w[:n] for n in (4, 5, 6) if len(w) >= n)]
            terms |= {xxhash.xxh64_intdigest(n.encode(), 5) % 2**22 for n in names}
        known = [model.place[t] for t in terms if t in model.place]
        x = model.bias + sum(model.weights[i] for i in known)
        for k, i in enumerate(known):
            for j in known[:k]:
                x += sum(model.factors[i][f] * model.factors[j][f] for f in range(T.RANK))
        return 1 / (1 + math.exp(-(model.slope * x + model.shift)))

    for t in [*texts[:40], b"", b"unknown words", b"WORD1 word2 word1"]:
        assert abs(model.score(t) - score(t)) < 1e-9


def test_pairs_of_terms_that_tell_nothing_alone():
    """Four words, each in half of either label: a text is toxic if those of one pair stand together."""
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(2400):
        y = i % 2
        pair = [("ann", "bob"), ("cid", "dee")][rng.integers(2)] if y else [("ann", "cid"), ("ann", "dee"), ("bob", "cid"), ("bob", "dee")][rng.integers(4)]
        texts.append(" ".join(rng.permutation([*pair, *(f"noise{k}" for k in rng.integers(0, 60, 5))])).encode())
        labels.append(y)
    sets = T.text_terms(texts)
    own = np.array(labels, dtype=float)
    assert T.telling_pairs(sets, own, np.unique(np.concatenate(sets))) and not T.telling_pairs(sets, np.array(rng.permutation(own)), np.unique(np.concatenate(sets)))
    model = T.fit(texts, labels, {0: 1200, 1: 1200})
    toxic, clean = ([model.score(t) for t in group] for group in ((b"ann bob", b"cid dee noise1"), (b"ann cid", b"bob dee", b"ann", b"dee noise2")))
    assert min(toxic) > 0.7 and max(clean) < 0.5


def test_pair_weights():
    """Toxic only where both words stand together: additive weights can't tell that."""
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for _ in range(1600):
        a, b = (rng.random(2) < 0.5).tolist()
        texts.append(" ".join(rng.permutation([f"noise{rng.integers(0, 40)}" for _ in range(4)] + ["insult"] * a + ["group"] * b)).encode())
        labels.append(int(a and b))
    model = T.fit(texts, labels, {0: labels.count(0), 1: labels.count(1)})
    scores = [model.score(t) for t in (b"insult group", b"insult alone", b"group alone", b"nothing here")]
    assert scores[0] > 0.7 and max(scores[1:]) < 0.5


@pytest.mark.parametrize("module, label", [(Q, "quality"), (T, "toxic")])
def test_awkward_rows(spark, awkward, empty, module, label):
    docs = awkward.select("doc_id", "text")
    for rows in ([], [(4, 1), (4, 0), (None, 1), (99, 1), (6, None), (7, 5)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        model = module.train(docs, labels)
        got = awkward.withColumn("__s", Q.scorer(spark, model)(F.col("text"))).collect()
        assert len(got) == awkward.count() and all(0 <= r["__s"] <= 1 for r in got)
        assert empty.withColumn("__s", Q.scorer(spark, model)(F.col("text"))).count() == 0


def test_sample_is_bounded_and_skips_conflicts(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("y")).union(spark.createDataFrame([(1, 0)], "doc_id long, y int"))
    texts, ys, counts = labelled_sample(docs, labels, "y", F.col("id") >= 0, rows_per_label=20)
    assert len(texts) == 40 and sum(ys) == 20 and counts == {0: 251, 1: 249}


def test_keep_good(spark, awkward):
    out = Q.keep_good(awkward, Q.Model([], [], 5.0))
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert Q.keep_good(awkward, Q.Model([], [], -5.0)).count() == 0

"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct lower-cased words of a whole text and their beginnings of four to six letters, hashed. The machine
gets those that occur in SUPPORT texts of the sample at least and tell the labels apart: by themselves (the TERMS most
telling ones of at least LEAST_Z standard errors), or by a pair of them that does so although neither term does (of the
PAIR_POOL terms in most texts, up to PAIR_TERMS, of at least PAIR_Z standard errors). A second-order factorization machine
learns a weight for each and, from low-rank factors, a weight for every pair that stands together, such as an insult with
the mention of a group, which additive weights miss. Then a logistic curve calibrates its output on rows that it wasn't
fitted on. What reaches the driver is bounded by `rows_per_label` and `longest`.

Defined results. Null, empty and wordless texts get the score of a text without known terms. Repeated rows score alike;
ties don't matter. Very long texts are scored in whole. Without rows of both labels, all scores are the share of
label 1 (0.5 without labels). Other columns are not read: labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import table, words_of
from foliospark.llm.quality import logistic, scorer
from foliospark.llm.sampling import LONGEST, ROWS_PER_LABEL, fold, labelled_sample

FOLDS, HELD = 3, 1
THRESHOLD = 0.7
BITS = 22
TERMS = 3000
#: A term must occur in this many texts of the sample at least.
SUPPORT = 3
#: Its share must differ between the labels by this many standard errors, or it is noise.
LEAST_Z = 4.0
#: Terms in most texts whose pairs are looked at, how many telling pairs may add, and from how many standard errors on:
#: more than for single terms, as there are some two million pairs.
PAIR_POOL = 2000
PAIR_TERMS = 500
PAIR_Z = 7.0
RANK = 6
STEPS = 300
RATE = 0.05
DECAY = 2e-4
SEED = 5
#: Words whose terms a task remembers; then it starts anew.
MEMORY = 300_000


def word_terms(word: bytes) -> list[int]:
    """Hashed terms of a word: the word itself, and its first 4, 5 and 6 letters."""
    from xxhash import xxh64_intdigest

    text = word.decode("utf-8", "replace")
    names = [b"w:" + word, *(b"p:" + text[:n].encode() for n in (4, 5, 6) if len(text) > n)]
    if 4 <= len(text) <= 6:
        names.append(b"p:" + word)
    return [xxh64_intdigest(n, SEED) & ((1 << BITS) - 1) for n in names]


class Model:
    """score = curve(bias + sum of weights + sum over pairs of factor products) of a text's known terms."""

    def __init__(self, terms: list[int], bias: float, weights: np.ndarray, factors: np.ndarray, slope: float, shift: float):
        self.place = {t: i for i, t in enumerate(terms)}
        self.bias, self.weights, self.factors, self.slope, self.shift = bias, weights, factors, slope, shift
        self._known: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def places(self, text: bytes) -> list[int]:
        known, place, out = self._known, self.place, set()
        for w in set(words_of(text)):
            own = known.get(w)
            if own is None:
                if len(known) >= MEMORY:
                    known.clear()
                own = known[w] = tuple(place[t] for t in word_terms(w) if t in place)
            if own:
                out.update(own)
        return sorted(out)

    def raw(self, text: bytes) -> float:
        at = self.places(text)
        if not at:
            return self.bias
        v = self.factors[at]
        return float(self.bias + self.weights[at].sum() + 0.5 * ((v.sum(axis=0) ** 2) - (v**2).sum(axis=0)).sum())

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.raw(text) + self.shift, -500, 500))))


def text_terms(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct terms of each text, packed: a sample's terms take four bytes each."""
    known: dict[bytes, list[int]] = {}
    out = []
    for text in texts:
        own: list[int] = []
        for w in set(words_of(text)):
            terms = known.get(w)
            if terms is None:
                if len(known) >= MEMORY // 4:
                    known.clear()
                terms = known[w] = word_terms(w)
            own += terms
        out.append(np.unique(np.array(own, dtype=np.uint32)))
    return out


def _z(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """By how many standard errors the shares a / n1 and b / n0 differ."""
    p = (a + b) / (n1 + n0)
    return np.abs(a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)


def telling_terms(sets: list[np.ndarray], labels: np.ndarray, most: int) -> list[int]:
    """The terms whose shares in the two labels differ most, and those of telling pairs of other terms."""
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    counts = np.zeros((2, 1 << BITS), dtype=np.int32)
    for s, y in zip(sets, labels, strict=True):
        counts[int(y), s] += 1
    terms = np.flatnonzero(counts.sum(axis=0) >= SUPPORT)
    z = _z(counts[1, terms].astype(float), counts[0, terms].astype(float), n1, n0)
    order = np.lexsort((terms, -z))
    single = [int(terms[i]) for i in order[:most] if z[i] >= LEAST_Z]
    pool = terms[z < LEAST_Z]
    pool = np.sort(pool[np.lexsort((pool, -counts[:, pool].sum(axis=0)))][:PAIR_POOL])
    return single + telling_pairs(sets, labels, pool)


def telling_pairs(sets: list[np.ndarray], labels: np.ndarray, pool: np.ndarray) -> list[int]:
    """Terms of the pool whose pairs stand together in other shares of the two labels, most telling pairs first."""
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    x = np.zeros((len(sets), len(pool)), dtype=np.float32)
    for i, s in enumerate(sets):
        at = np.searchsorted(pool, s)
        hit = at < len(pool)
        hit[hit] = pool[at[hit]] == s[hit]
        x[i, at[hit]] = 1.0
    a, b = (x[labels == y].T @ x[labels == y] for y in (1, 0))
    left, right = np.nonzero(np.triu(a + b >= SUPPORT, 1))
    z = _z(a[left, right].astype(float), b[left, right].astype(float), n1, n0)
    found: dict[int, None] = {}
    for k in np.lexsort((right, left, -z)).tolist():
        if z[k] < PAIR_Z or len(found) >= PAIR_TERMS:
            break
        found |= {int(pool[left[k]]): None, int(pool[right[k]]): None}
    return list(found)


def _machine(rows: list[list[int]], labels: np.ndarray, weight: np.ndarray, n_terms: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by Adam on the whole sample: weighted logistic loss with decay."""
    x = np.zeros((len(rows), n_terms), dtype=np.float32)
    for i, at in enumerate(rows):
        x[i, at] = 1.0
    rng = np.random.default_rng(SEED)
    bias, w, v = np.zeros(1, dtype=np.float32), np.zeros(n_terms, dtype=np.float32), rng.normal(0, 0.01, (n_terms, RANK)).astype(np.float32)
    share = weight / weight.sum()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (bias, w, v)]
    for step in range(1, STEPS + 1):
        xv = x @ v
        out = bias + x @ w + 0.5 * ((xv**2).sum(axis=1) - x @ (v**2).sum(axis=1))
        error = (share * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels)).astype(np.float32)
        by_term = x.T @ error
        gradients = [np.array([error.sum()]), by_term + DECAY * w, x.T @ (error[:, None] * xv) - v * by_term[:, None] + DECAY * v]
        for p, g, (m, s) in zip((bias, w, v), gradients, moments, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return float(bias[0]), w.astype(float), v.astype(float)


def fit(texts: list[bytes], labels: list[int], counts: dict[int, int]) -> Model:
    """Three of four rows fit the machine, weighted to the labels' true shares; the fourth the curve, both labels alike."""
    y, total = np.array(labels, dtype=float), sum(counts.values())
    if min(y.sum(), len(y) - y.sum()) < 8:
        share = (counts[1] + 1) / (total + 2)
        return Model([], 0.0, np.zeros(0), np.zeros((0, RANK)), 1.0, float(np.log(share / (1 - share))))
    weight = np.where(y == 1, counts[1] / total / y.sum(), counts[0] / total / (len(y) - y.sum()))
    own = np.arange(len(y)) % 4 != 3
    sets = text_terms(texts)
    fitted = np.flatnonzero(own)
    terms = telling_terms([sets[i] for i in fitted], y[own], TERMS)
    place = {t: i for i, t in enumerate(terms)}
    bias, w, v = _machine([[place[t] for t in sets[i].tolist() if t in place] for i in fitted], y[own], weight[own], len(terms))
    model = Model(terms, bias, w, v, 1.0, 0.0)
    raw = np.array([[model.raw(texts[i])] for i in np.flatnonzero(~own)])
    held = y[~own]
    even = np.where(held == 1, 0.5 / max(1.0, held.sum()), 0.5 / max(1.0, len(held) - held.sum())) * len(held)
    (model.slope,), model.shift = logistic(raw, held, even, ridge=0.01)
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows_per_label: int = ROWS_PER_LABEL, longest: int = LONGEST) -> Model:
    return fit(*labelled_sample(docs, labels, "toxic", fold(F.col("id"), FOLDS) != HELD, key, text, rows_per_label, longest))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), scorer(spark, model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

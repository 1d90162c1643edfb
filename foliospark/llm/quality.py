"""Quality classifier by compression with zstandard dictionaries of good and of bad labelled text.

A text is compressed in two views: its words, lower-cased, one blank apart; and its skeleton, in which runs of lower-case,
upper-case and digit characters shrink to one sign, other signs stay, and a word that repeats the one before becomes its
rank in the run. Of each view there are two dictionaries. The whole view is compressed in short blocks with either, so
that a text can't serve as its own dictionary; the difference of the compressed sizes over their sum is normalised. The
two differences go through a logistic curve, fitted on labelled rows that are not in the dictionaries, to a probability.

Bounds, all parameters of `train`: at most `rows_per_label` rows of each label, of texts of at most `longest` characters,
are sampled. Half of them make the dictionaries, `dictionary` bytes for each view and label: slices of `least_slice` to
`most_slice` bytes, as long as lets all rows in, or, where that is below `least_slice`, of evenly chosen rows.

Defined results. Null and empty texts get the score of an empty view. Repeated rows score alike; ties don't matter.
Very long texts are scored in whole. Without rows of both labels, all scores are the share of label 1 (0.5 without
labels). Other columns are not read: labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import as_bytes, bounded_batches, by_name, fresh, table
from foliospark.llm.sampling import LONGEST, ROWS_PER_LABEL, fold, labelled_sample

FOLDS = 5
THRESHOLD = 0.3
#: Bytes of a dictionary, of a row's slice in it, and of a block that is compressed by itself.
DICTIONARY = 110_000
LEAST_SLICE, MOST_SLICE = 200, 1500
BLOCK = 128
LEVEL = 3
#: Bytes added to the sum of sizes, so that the few bytes of a very short text decide little.
SHRINK = 80

_SIGNS = bytes(0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x39 if 0x30 <= b <= 0x39 else b for b in range(256))


def wording(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def skeleton(text: bytes) -> bytes:
    words = text.split()
    signs = np.frombuffer(b" ".join(words).translate(_SIGNS), dtype=np.uint8)
    if not len(signs):
        return b""
    keep = np.concatenate(([True], signs[1:] != signs[:-1]))
    out = signs[keep].tobytes()
    repeats = [i for i in range(1, len(words)) if words[i] == words[i - 1]]
    if repeats:
        shaped, last, rank = out.split(), -2, 0
        for i in repeats:
            rank = rank + 1 if i == last + 1 else 1
            last = i
            shaped[i] = b"=%d" % rank
        out = b" ".join(shaped)
    return out


VIEWS = (wording, skeleton)


class Compressors:
    """Sizes of a view under the bad and the good dictionary."""

    def __init__(self, bad: bytes, good: bytes):
        import zstandard

        self.pair = []
        for content in (bad, good):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.pair.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, seen: bytes) -> float:
        """Above 0: the good dictionary makes it smaller."""
        blocks = [seen[i : i + BLOCK] for i in range(0, max(1, len(seen)), BLOCK)]
        bad, good = (sum([len(c.compress(b)) for b in blocks]) for c in self.pair)
        return (bad - good) / (bad + good + SHRINK)


class Model:
    """score = curve(shift + slopes * differences); dictionaries: (bad, good) of each view."""

    def __init__(self, dictionaries: list[tuple[bytes, bytes]], slopes: list[float], shift: float):
        self.dictionaries, self.slopes, self.shift = dictionaries, slopes, shift
        self._compressors: list[Compressors] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def differences(self, text: bytes) -> list[float]:
        if self._compressors is None:
            self._compressors = [Compressors(*pair) for pair in self.dictionaries]
        return [c.difference(view(text)) for c, view in zip(self._compressors, VIEWS, strict=True)]

    def score(self, text: bytes) -> float:
        x = self.shift
        if self.dictionaries:
            x += sum(a * d for a, d in zip(self.slopes, self.differences(text), strict=True))
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[list[float], float]:
    """Slopes of the columns of x, and shift, of the weighted logistic curve, by Newton steps."""
    spread = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    a = np.concatenate([x / spread, np.ones((len(x), 1))], axis=1)
    w = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - ridge * w
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        size = np.abs(step).max()
        w += step / max(1.0, size / 4)
        if size < 1e-9:
            break
    return (w[:-1] / spread).tolist(), float(w[-1])


def slices(seen: list[bytes], dictionary: int, least: int, most: int) -> bytes:
    """A dictionary's content: a slice of each view, or, if they'd be shorter than `least`, of evenly chosen ones."""
    seen = [s for s in seen if s]
    n = min(len(seen), max(1, dictionary // (least + 1)))
    length = min(most, dictionary // max(1, n) - 1)
    parts = []
    for k in range(n):
        own = seen[k * len(seen) // n]
        at = (k * 977) % max(1, len(own) - length + 1)
        parts.append(own[at : at + length])
    return b"\n".join(parts)[:dictionary]


def fit(texts: list[bytes], labels: list[int], counts: dict[int, int], dictionary: int = DICTIONARY, least_slice: int = LEAST_SLICE, most_slice: int = MOST_SLICE) -> Model:
    """Even rows of each label make the dictionaries, odd ones the curve, weighted to the labels' true shares."""
    total = sum(counts.values())
    by_label = [[t for t, y in zip(texts, labels, strict=True) if y == k] for k in (0, 1)]
    if min(map(len, by_label)) < 4:
        share = (counts[1] + 1) / (total + 2)
        return Model([], [], float(np.log(share / (1 - share))))
    made = [tuple(slices([view(t) for t in own[::2]], dictionary, least_slice, most_slice) for own in by_label) for view in VIEWS]
    model = Model(made, [0.0] * len(VIEWS), 0.0)
    x = np.array([model.differences(t) for own in by_label for t in own[1::2]])
    y = np.array([k for k in (0, 1) for _ in by_label[k][1::2]], dtype=float)
    weight = np.array([counts[k] / total / max(1, len(by_label[k][1::2])) for k in (0, 1) for _ in by_label[k][1::2]]) * len(x)
    model.slopes, model.shift = logistic(x, y, weight)
    return model


def scorer(spark: SparkSession, model):
    """A UDF that scores texts with a broadcast model of bounded size."""
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(model)

    def score(column: pa.Array) -> pa.Array:
        return pa.array([held.value.score(t) for t in as_bytes(column)], type=pa.float64())

    return F.arrow_udf(score, "double")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows_per_label: int = ROWS_PER_LABEL, longest: int = LONGEST, **bounds: int) -> Model:
    """A model from the labelled rows outside fold 0. bounds: dictionary, least_slice, most_slice, as `fit` takes them."""
    return fit(*labelled_sample(docs, labels, "quality", fold(F.col("id"), FOLDS) != 0, key, text, rows_per_label, longest), **bounds)


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score the threshold or more. Same columns."""
    score = fresh(docs, base="score")
    return docs.withColumn(score, scorer(docs.sparkSession, model)(by_name(docs, text))).where(F.col(score) >= threshold).drop(score)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), scorer(spark, model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

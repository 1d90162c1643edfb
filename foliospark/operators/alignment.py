"""Two editions aligned entry by entry: similarities, ordered pairs, residual pairs, and a pair model between anchors.

Entries meet only inside corresponding sections (segments). Similarities are computed in tiles, so a large segment is
many tasks; those that may reach a threshold then meet in one task per segment, which gives its pairs and its windows as
rows. The pair model is fitted over all windows of all segments, with nine sums per round on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.similarity import Records, matrix, pair
from foliospark.operators import sequence as S

#: Where a link comes from.
ORDERED, CONTEXT, RESIDUAL = "nw", "nw-contexte", "nw-residuel"
MANUAL, MANUAL_UNCERTAIN, CANDIDATE, LEARNED = "manuel", "manuel-incertain", "candidate", "dedupe"
NEIGHBOURS = (1, 2, 3)


@dataclass(frozen=True)
class Params:
    threshold: float = 0.75
    residual: float = 0.85
    weight: float = 0.5
    anchor: float = 0.9
    context: bool = True
    rounds: int = 50
    tolerance: float = 1.0


_OUT = "segment string, kind string, left_uuid string, right_uuid string, score double, bin int, n long, window int, rows array<string>, cols array<string>, sims array<float>"


#: Left and right records of a tile: the similarities of a section are computed tile by tile, in tasks of their own.
TILE = (256, 4096)
_RECORDS = ["segment", "side", "at", "uuid", "subj", "text"]


def numbered(df: DataFrame, side: int) -> DataFrame:
    """Records (segment, order, uuid, subj, text) with their place in the segment, from 0."""
    own = df.select(F.col("segment").cast("string").alias("segment"), F.lit(side).alias("side"), "order", F.col("uuid").cast("string").alias("uuid"), F.coalesce("subj", F.lit("")).alias("subj"), F.coalesce("text", F.lit("")).alias("text"))
    at = F.row_number().over(Window.partitionBy("segment").orderBy("order", "uuid")) - 1
    return own.withColumn("at", at).select(*_RECORDS)


def _tile(weight: float, least: float):
    def work(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.float32)]
        if len(left) and len(right):
            records = Records(list(zip(left["subj"], left["text"], strict=True)), list(zip(right["subj"], right["text"], strict=True)), weight)
            rows, columns = left["at"].to_numpy(np.int32), right["at"].to_numpy(np.int32)
            for k in range(len(left)):
                met, values = records.row(k, least)
                out[0].append(np.full(len(met), rows[k]))
                out[1].append(columns[met])
                out[2].append(values.astype(np.float32))
        i, j, sim = (np.concatenate(x) for x in out)
        return pd.DataFrame({"segment": pd.Series([key[0]] * len(i), dtype=object), "i": i, "j": j, "sim": sim})

    return work


def tiles(left: DataFrame, right: DataFrame, tile: tuple[int, int] = TILE):
    """Blocks of left and blocks of right rows (segment, at, ...) of a segment, grouped together; a row goes to all tiles of its block."""
    rows, columns = tile
    blocks = [df.groupBy("segment").agg((F.floor(F.max("at") / n) + 1).cast("int").alias("blocks")) for df, n in ((left, rows), (right, columns))]
    # few bytes are much work: by a number of its own, no tasks are put together
    tasks, dealt = 4 * left.sparkSession.sparkContext.defaultParallelism, []
    for df, other, names, n in ((left, blocks[1], ("r", "c"), rows), (right, blocks[0], ("c", "r"), columns)):
        met = df.join(other, "segment").withColumn(names[0], F.floor(F.col("at") / n).cast("int"))
        dealt.append(met.withColumn(names[1], F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks").repartition(tasks, "segment", "r", "c").groupBy("segment", "r", "c"))
    return dealt[0].cogroup(dealt[1])


def cells(left: DataFrame, right: DataFrame, weight: float, least: float, tile: tuple[int, int] = TILE) -> DataFrame:
    """segment, i, j, sim: the pairs of records (segment, at, subj, text) of a segment that may reach `least`."""
    return tiles(left, right, tile).applyInPandas(_tile(weight, least), "segment string, i int, j int, sim float")


def contents(records: DataFrame) -> DataFrame:
    """The distinct (subj, text) of numbered records, numbered in the order of their first records."""
    own = records.groupBy("segment", "subj", "text").agg(F.min("at").alias("first"))
    return own.select("segment", (F.row_number().over(Window.partitionBy("segment").orderBy("first")) - 1).alias("at"), "subj", "text")


class _Cells:
    """Similarities of a segment's records, held once for each two contents; those not found are 0."""

    def __init__(self, left: list[tuple[str, str]], right: list[tuple[str, str]], found: pd.DataFrame):
        numbers: list[dict] = [{}, {}]
        self.left, self.right = (np.array([n.setdefault(x, len(n)) for x in side], dtype=np.int64) for n, side in zip(numbers, (left, right), strict=True))
        i, j = found["i"].to_numpy(), found["j"].to_numpy()
        order = np.lexsort((j, i))
        self.j, self.sim = j[order], found["sim"].to_numpy(dtype=np.float32)[order]
        self.begin = np.searchsorted(i[order], np.arange(len(numbers[0]) + 1))
        self.row = np.zeros(len(numbers[1]), dtype=np.float32)

    def at(self, i: int, columns: np.ndarray) -> np.ndarray:
        k = self.left[i]
        own = slice(self.begin[k], self.begin[k + 1])
        self.row[self.j[own]] = self.sim[own]
        out = self.row[self.right[columns]]
        self.row[self.j[own]] = 0
        return out

    def gains(self, i: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """The columns whose similarity is above the threshold, and by how much."""
        gain = self.at(i, slice(None)) - threshold
        at = np.flatnonzero(gain > 0)
        return at, gain[at]

    def __getitem__(self, ij: tuple[int, int]) -> np.float32:
        return self.at(ij[0], np.array([ij[1]]))[0]


def _segment(params: Params):
    def work(key, records: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        left, right = (records[records["side"] == side].sort_values("at") for side in (0, 1))
        a, b = left["uuid"].tolist(), right["uuid"].tolist()
        fields_a, fields_b = list(zip(left["subj"], left["text"], strict=True)), list(zip(right["subj"], right["text"], strict=True))
        # pairs that can't reach any threshold stay 0: no pair is made of them; where lower values count, they are computed
        sims = _Cells(fields_a, fields_b, found)
        exact = lambda rows, cols: matrix([fields_a[i] for i in rows], [fields_b[j] for j in cols], params.weight)
        compared = lru_cache(1 << 18)(lambda x, y: pair(x, y, params.weight))
        one = lambda i, j: compared(fields_a[i], fields_b[j])
        ordered = S.align_gains((sims.gains(i, params.threshold) for i in range(len(a))), len(b))
        rest = S.residual_rows(sims.at, len(a), len(b), ordered, np.float32(params.residual))
        out = [dict(kind=RESIDUAL, left_uuid=a[i], right_uuid=b[j], score=float(sims[i, j])) for i, j in rest]
        if not params.context:
            out += [dict(kind=ORDERED, left_uuid=a[i], right_uuid=b[j], score=float(sims[i, j])) for i, j in ordered]
            return _frame(key[0], out)
        anchors = [(i, j) for i, j in ordered if sims[i, j] >= np.float32(params.anchor)]
        out += [dict(kind=ORDERED, left_uuid=a[i], right_uuid=b[j], score=float(sims[i, j])) for i, j in anchors]
        near = [one(x, y) for i, j in anchors for d in NEIGHBOURS for x, y in ((i, j - d), (i, j + d), (i - d, j), (i + d, j)) if 0 <= x < len(a) and 0 <= y < len(b)]
        once = []
        low_l, low_r = left["subj"].str.lower(), right["subj"].str.lower()
        n_l, n_r = low_l.value_counts(), low_r.value_counts()
        at = {s: j for j, s in enumerate(low_r)}
        for i, s in enumerate(low_l):
            if s and n_l[s] == 1 and n_r.get(s, 0) == 1:
                once.append(one(i, at[s]))
        for kind, values in (("different", near), ("same", once)):
            counts = S.histogram(np.array(values, dtype=np.float32))
            out += [dict(kind=kind, bin=k, n=int(n)) for k, n in enumerate(counts) if n]
        for k, (rows, cols) in enumerate(S.windows(anchors, len(a), len(b), rest)):
            out.append(dict(kind="window", window=k, rows=[a[i] for i in rows], cols=[b[j] for j in cols], sims=exact(rows, cols).ravel().tolist()))
        return _frame(key[0], out)

    return work


def _frame(segment, rows: list[dict]) -> pd.DataFrame:
    blank = dict(segment=segment, left_uuid=None, right_uuid=None, score=float("nan"), bin=-1, n=0, window=-1, rows=[], cols=[], sims=[])
    names = ["segment", "kind", "left_uuid", "right_uuid", "score", "bin", "n", "window", "rows", "cols", "sims"]
    columns = {n: [(blank | r)[n] for r in rows] for n in names}
    texts = {n: pd.Series(columns[n], dtype=object) for n in ("segment", "kind", "left_uuid", "right_uuid", "rows", "cols", "sims")}
    numbers = {"score": pd.Series(columns["score"], dtype="float64"), "bin": pd.Series(columns["bin"], dtype="int32"), "n": pd.Series(columns["n"], dtype="int64"), "window": pd.Series(columns["window"], dtype="int32")}
    return pd.DataFrame(texts | numbers)[names]


@dataclass
class Fit:
    transitions: np.ndarray
    same: np.ndarray
    different: np.ndarray
    likelihoods: list[float]


def _expect(transitions, same, different):
    def work(batches):
        counts, total = np.zeros((3, 3)), 0.0
        for batch in batches:
            for k, l, sims, n in zip(batch["k"], batch["l"], batch["sims"], batch["n"], strict=True):  # noqa: E741
                _, log_likelihood, own = S.posteriors(np.asarray(sims, dtype=np.float32).reshape(k, l), transitions, same, different)
                counts, total = counts + n * own, total + n * log_likelihood
        yield pd.DataFrame({"k": range(10), "v": [*counts.ravel(), total]})

    return work


def fit(windows: DataFrame, same_counts: np.ndarray, different_counts: np.ndarray, params: Params = Params()) -> Fit:
    """Transitions by expectation maximisation over all windows(rows, cols, sims); emissions stay as they are counted.

    Windows of the same sizes and similarities, as most small ones are, are one form that counts as often as it comes.
    """
    tasks = 4 * windows.sparkSession.sparkContext.defaultParallelism
    forms = windows.groupBy(F.size("rows").alias("k"), F.size("cols").alias("l"), "sims").agg(F.count(F.lit(1)).alias("n")).repartition(tasks).persist()
    same, different = S.emissions(same_counts, different_counts)
    found = Fit(S.FIRST.copy(), same, different, [])
    for _ in range(params.rounds):
        sums = forms.mapInPandas(_expect(found.transitions, same, different), "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        v = np.zeros(10)
        for r in sums:
            v[r["k"]] = r["v"]
        found.likelihoods.append(float(v[9]))
        found.transitions = S.next_transitions(v[:9].reshape(3, 3))
        if len(found.likelihoods) > 1 and found.likelihoods[-1] - found.likelihoods[-2] <= params.tolerance:
            break
    forms.unpersist()
    return found


def _decode(fitted: Fit):
    def work(batches):
        for batch in batches:
            out = []
            for segment, rows, cols, sims in zip(batch["segment"], batch["rows"], batch["cols"], batch["sims"], strict=True):
                if len(rows) and len(cols):
                    p, _, _ = S.posteriors(np.asarray(sims, dtype=np.float32).reshape(len(rows), len(cols)), fitted.transitions, fitted.same, fitted.different)
                    out += [(segment, rows[i], cols[j], float(p[i, j]), CONTEXT) for i, j in S.decode(p)]
            yield pd.DataFrame({n: pd.Series([r[k] for r in out], dtype="float64" if n == "score" else object) for k, n in enumerate(["segment", "left_uuid", "right_uuid", "score", "source"])})

    return work


def align(left: DataFrame, right: DataFrame, params: Params = Params()) -> tuple[DataFrame, Fit | None]:
    """links(segment, left_uuid, right_uuid, score, source) of records(segment, order, uuid, subj, text), and the fitted model."""
    own = [numbered(left, 0), numbered(right, 1)]
    least = min(params.threshold, params.residual, params.anchor)
    near = cells(*[contents(df) for df in own], params.weight, least)
    found = own[0].unionByName(own[1]).groupBy("segment").cogroup(near.groupBy("segment")).applyInPandas(_segment(params), _OUT).persist()
    links = found.where(F.col("kind").isin(ORDERED, RESIDUAL)).select("segment", "left_uuid", "right_uuid", "score", F.col("kind").alias("source"))
    if not params.context:
        return links, None
    counts = {"same": np.zeros(S.BINS), "different": np.zeros(S.BINS)}
    for r in found.where(F.col("kind").isin(*counts)).groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["kind"]][r["bin"]] = r["n"]
    windows = found.where(F.col("kind") == "window").select("segment", "rows", "cols", "sims")
    fitted = fit(windows, counts["same"], counts["different"], params)
    more = windows.mapInPandas(_decode(fitted), "segment string, left_uuid string, right_uuid string, score double, source string")
    return links.unionByName(more), fitted


def summary(links: DataFrame) -> DataFrame:
    """source, links, lowest and mean score, and counts by band of score."""
    bands = [(0.5, 0.7), (0.7, 0.8), (0.8, 0.9), (0.9, 1.01)]
    return links.groupBy("source").agg(F.count(F.lit(1)).alias("links"), F.min("score").alias("lowest"), F.avg("score").alias("mean"), *[F.count_if((F.col("score") >= a) & (F.col("score") < b)).alias(f"from_{int(a * 100)}") for a, b in bands])


def agreement(one: DataFrame, other: DataFrame) -> DataFrame:
    """One row: pairs in both, only in one, only in the other, and lefts that both pair differently."""
    a, b = (df.select("left_uuid", "right_uuid").distinct() for df in (one, other))
    both = a.intersect(b).agg(F.count(F.lit(1)).alias("both"))
    left = a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_first"))
    right = b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_second"))
    apart = a.exceptAll(b).join(b.exceptAll(a).select("left_uuid").distinct(), "left_uuid", "left_semi").agg(F.countDistinct("left_uuid").alias("conflicts"))
    return both.join(left, F.lit(True)).join(right, F.lit(True)).join(apart, F.lit(True))

"""A linear-chain sequence labeller: training per document, marginals, the choice of what to annotate next.

The numeric core is numpy inside grouped-map functions; documents are trained and labelled independently.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

C1, C2, ROUNDS = 0.1, 0.01, 50


class Labeller:
    """State weights (feature x class) and transition weights (class x class)."""

    def __init__(self, features: list[str], classes: list[str], state: np.ndarray, moves: np.ndarray):
        self.features, self.classes, self.state, self.moves = {f: i for i, f in enumerate(features)}, list(classes), state, moves

    def emissions(self, lines: list[dict[str, str]]) -> np.ndarray:
        out = np.zeros((len(lines), len(self.classes)))
        for t, line in enumerate(lines):
            at = [self.features[f] for f in (f"{k}={v}" for k, v in line.items()) if f in self.features]
            out[t] = self.state[at].sum(axis=0)
        return out

    def marginals(self, lines: list[dict[str, str]]) -> np.ndarray:
        return _expect(self.emissions(lines), self.moves)[0] if lines else np.zeros((0, len(self.classes)))

    def pruned(self) -> Labeller:
        """The same without features of no weight."""
        names, used = list(self.features), np.flatnonzero(self.state.any(axis=1))
        return Labeller([names[i] for i in used], self.classes, self.state[used], self.moves)

    def dump(self) -> str:
        return json.dumps({"features": list(self.features), "classes": self.classes, "state": self.state.tolist(), "moves": self.moves.tolist()})

    @staticmethod
    def load(text: str) -> Labeller:
        d = json.loads(text)
        return Labeller(d["features"], d["classes"], np.array(d["state"]).reshape(len(d["features"]), len(d["classes"])), np.array(d["moves"]))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _expect(e: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each line, expected moves, log of the partition sum."""
    n, k = e.shape
    f, b = np.zeros((n, k)), np.zeros((n, k))
    f[0] = e[0]
    for t in range(1, n):
        f[t] = e[t] + _lse(f[t - 1][:, None] + moves, 0)
    for t in range(n - 2, -1, -1):
        b[t] = _lse(moves + (e[t + 1] + b[t + 1])[None, :], 1)
    z = float(_lse(f[-1], 0))
    pairs = np.exp(f[:-1, :, None] + moves[None] + (e[1:] + b[1:])[:, None, :] - z).sum(axis=0) if n > 1 else np.zeros((k, k))
    return np.exp(f + b - z), pairs, z


class Packed:
    """Runs of numbered lines side by side: line t of all runs that have one, longest runs first, then line t + 1."""

    def __init__(self, runs: list[list[int]]):
        lengths = np.array([len(r) for r in runs], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.active = (len(runs) - np.cumsum(np.bincount(lengths, minlength=1)))[: int(lengths.max(initial=0))]
        self.starts = np.concatenate(([0], np.cumsum(self.active)))
        rank = np.empty(len(runs), dtype=np.int64)
        rank[self.order] = np.arange(len(runs))
        owner = np.repeat(np.arange(len(runs)), lengths)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        #: Where line after line of run after run, as they were given, stands.
        self.at = self.starts[place] + rank[owner]
        self.owner = np.empty(len(owner), dtype=np.int64)
        self.owner[self.at] = owner
        self.lines = self.put(np.array([x for r in runs for x in r], dtype=np.int64))

    def put(self, values: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[self.at] = values
        return out

    def expect(self, e: np.ndarray, moves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of each line, expected moves of all runs, as often as they count, and the log of each run's partition sum, as given.

        Each step is scaled to a sum of 1, so it takes one product instead of logarithms of sums.
        """
        n, k = e.shape
        top, shift = e.max(axis=1, keepdims=True, initial=-np.inf), moves.max()
        x, m = np.exp(e - top), np.exp(moves - shift)
        f, scale, b = np.empty((n, k)), np.empty((n, 1)), np.ones((n, k))
        pairs, weight = np.zeros((k, k)), counts[self.order][:, None]
        steps = [slice(int(s), int(s + a)) for s, a in zip(self.starts, self.active)]
        for t, own in enumerate(steps):
            raw = x[own] if t == 0 else x[own] * (f[steps[t - 1]][: self.active[t]] @ m)
            scale[own] = raw.sum(axis=1, keepdims=True)
            f[own] = raw / scale[own]
        for t in range(len(steps) - 2, -1, -1):
            own, then, a = steps[t], steps[t + 1], self.active[t + 1]
            ahead = x[then] * b[then] / scale[then]
            b[own][:a] = ahead @ m.T
            pairs += m * (f[own][:a].T @ (ahead * weight[:a]))
        z = np.bincount(self.owner, weights=(np.log(scale) + top).ravel(), minlength=len(self.order)) + shift * np.maximum(np.bincount(self.owner, minlength=len(self.order)) - 1, 0)
        return f * b, pairs, z


def train(sequences: list[tuple[list[dict[str, str]], list[str]]], c1: float = C1, c2: float = C2, rounds: int = ROUNDS) -> Labeller | None:
    """Penalised likelihood (c1 on absolute values, c2 on squares) by orthant-wise quasi-Newton steps; None with fewer than two classes."""
    return train_runs([([[f"{k}={v}" for k, v in line.items()] for line in lines], ys, 1) for lines, ys in sequences], c1, c2, rounds)


def train_runs(runs: list[tuple[list[list[str]], list[str], int]], c1: float = C1, c2: float = C2, rounds: int = ROUNDS) -> Labeller | None:
    """The same from runs (the features of each line, labels, how often there is this run); equal runs and equal lines are computed once."""
    classes = sorted({y for _, ys, _ in runs for y in ys})
    if len(classes) < 2:
        return None
    names = sorted({f for lines, _, _ in runs for line in lines for f in line})
    at, of = {f: i for i, f in enumerate(names)}, {c: i for i, c in enumerate(classes)}
    nf, k = len(names), len(classes)
    kinds: dict[tuple[str, ...], int] = {}
    found: dict[tuple, int] = {}
    for lines, ys, n in runs:
        if ys:
            key = tuple(kinds.setdefault(tuple(line), len(kinds)) for line in lines), tuple(of[y] for y in ys)
            found[key] = found.get(key, 0) + n
    packed, counts = Packed([r for r, _ in found]), np.array(list(found.values()), dtype=float)
    y = packed.put(np.array([c for _, ys in found for c in ys], dtype=np.int64))
    weight = counts[packed.owner]
    flat = np.array([at[f] for line in kinds for f in line], dtype=np.int64)
    owner = np.repeat(np.arange(len(kinds)), [len(line) for line in kinds])
    # what is told of lines and moves, as often as it counts
    told = np.bincount(packed.lines * k + y, weights=weight, minlength=len(kinds) * k).reshape(-1, k)
    went, starts = np.zeros((k, k)), packed.starts
    for t in range(1, len(packed.active)):
        then = slice(starts[t], starts[t] + packed.active[t])
        before = y[starts[t - 1] : starts[t - 1] + packed.active[t]]
        went += np.bincount(before * k + y[then], weights=weight[then], minlength=k * k).reshape(k, k)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        state, moves = w[: nf * k].reshape(nf, k), w[nf * k :].reshape(k, k)
        of_kind = np.stack([np.bincount(owner, weights=state[flat, c], minlength=len(kinds)) for c in range(k)], axis=1)
        p, pairs, z = packed.expect(of_kind[packed.lines], moves, counts)
        value = float(counts @ z - (told * of_kind).sum() - (went * moves).sum())
        rest = np.stack([np.bincount(packed.lines, weights=p[:, c] * weight, minlength=len(kinds)) for c in range(k)], axis=1) - told
        g_state = np.stack([np.bincount(flat, weights=rest[owner, c], minlength=nf) for c in range(k)], axis=1)
        return value + c2 * (w @ w), np.concatenate([g_state.ravel(), (pairs - went).ravel()]) + 2 * c2 * w

    w = np.zeros(nf * k + k * k)
    value, g = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        # the steepest way down with the penalty of absolute values
        steep = np.where(w != 0, g + c1 * np.sign(w), np.where(g > c1, g - c1, np.where(g < -c1, g + c1, 0.0)))
        d, kept = -steep.copy(), []
        for s, y in reversed(past):
            a = (s @ d) / (s @ y)
            d -= a * y
            kept.append(a)
        if past:
            d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, y), a in zip(past, reversed(kept), strict=True):
            d += s * (a - (y @ d) / (s @ y))
        d[d * steep >= 0] = 0.0
        if not d.any():
            break
        side = np.where(w != 0, np.sign(w), -np.sign(steep))
        step, cost = (1.0 if past else 1 / max(1.0, np.abs(steep).sum())), value + c1 * np.abs(w).sum()
        for _ in range(30):
            new = w + step * d
            new[new * side < 0] = 0.0
            new_value, new_g = loss(new)
            if new_value + c1 * np.abs(new).sum() <= cost + 1e-4 * (steep @ (new - w)):
                break
            step /= 2
        else:
            break
        s, y = new - w, new_g - g
        if s @ y > 1e-10:
            past = [*past[-5:], (s, y)]
        gain = cost - new_value - c1 * np.abs(new).sum()
        w, value, g = new, new_value, new_g
        if gain < 1e-5 * max(1.0, abs(cost)):
            break
    return Labeller(names, classes, w[: nf * k].reshape(nf, k), w[nf * k :].reshape(k, k))


def labelled_runs(lines: list[dict[str, str]], labels: list[str | None]) -> list[tuple[list[dict[str, str]], list[str]]]:
    """The contiguous stretches of labelled lines."""
    out, held = [], ([], [])
    for line, y in [*zip(lines, labels, strict=True), ({}, None)]:
        if y is not None:
            held[0].append(line)
            held[1].append(y)
        elif held[1]:
            out.append(held)
            held = ([], [])
    return out


def label_documents(lines: DataFrame, classes: list[str], c1: float = C1, c2: float = C2, rounds: int = ROUNDS) -> DataFrame:
    """document, pos, prediction, probability, margin, marginals: a model per document from its labelled lines, over all its lines.

    lines: document, pos, features (map), label (null where none). A class that a document's labels lack has probability
    0. A document with fewer than two classes gets none.
    """

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        features = [dict(f) for f in frame["features"]]
        model = train(labelled_runs(features, [y if isinstance(y, str) else None for y in frame["label"]]), c1, c2, rounds)
        if model is None:
            return pd.DataFrame({"document": pd.Series(dtype=object), "pos": pd.Series(dtype="int64"), "prediction": pd.Series(dtype=object), "probability": pd.Series(dtype=float), "margin": pd.Series(dtype=float), "marginals": pd.Series(dtype=object)})
        p = np.zeros((len(frame), len(classes)))
        own = [i for i, c in enumerate(model.classes) if c in classes]
        raw = model.marginals(features)[:, own]
        p[:, [classes.index(model.classes[i]) for i in own]] = raw / raw.sum(axis=1, keepdims=True)
        top = np.sort(p, axis=1)[:, ::-1]
        return pd.DataFrame({"document": frame["document"].tolist(), "pos": frame["pos"].tolist(), "prediction": [classes[i] for i in p.argmax(axis=1)], "probability": top[:, 0], "margin": top[:, 0] - top[:, 1], "marginals": p.tolist()})

    return lines.groupBy("document").applyInPandas(work, "document string, pos long, prediction string, probability double, margin double, marginals array<double>")


def next_lines(scored: DataFrame, labelled: DataFrame) -> DataFrame:
    """document, pos, neighbour: of each document the unlabelled line of the smallest margin, with the line before it, else after it, if that is unlabelled too."""
    free = scored.join(labelled.select("document", "pos"), ["document", "pos"], "left_anti")
    order = Window.partitionBy("document").orderBy("pos")
    near = free.withColumn("before", F.lag("pos").over(order)).withColumn("after", F.lead("pos").over(order))
    pick = near.groupBy("document").agg(F.min_by(F.struct("pos", "before", "after"), F.struct("margin", "pos")).alias("p"))
    at = F.col("p.pos")
    return pick.select("document", at.alias("pos"), F.when(F.col("p.before") == at - 1, F.col("p.before")).when(F.col("p.after") == at + 1, F.col("p.after")).alias("neighbour"))


def seed_lines(lines: DataFrame, guess: str = "guess", size: int = 20) -> DataFrame:
    """The first lines to annotate: in turn of the classes guessed, rarest first, in document order."""
    counts = lines.groupBy("document", guess).agg(F.count(F.lit(1)).alias("n"))
    ranked = lines.join(counts, ["document", guess]).withColumn("turn", F.row_number().over(Window.partitionBy("document", guess).orderBy("pos")))
    nth = F.row_number().over(Window.partitionBy("document").orderBy("turn", "n", "pos"))
    return ranked.withColumn("nth", nth).where(F.col("nth") <= size).select("document", "pos", guess, "nth")


def group_weights(model: Labeller, group_of: dict[str, str]) -> dict[str, float]:
    """Sum of absolute state weights of each feature group; group_of: feature key to group."""
    out: dict[str, float] = {}
    for name, i in model.features.items():
        g = group_of.get(name.split("=", 1)[0], "other")
        out[g] = out.get(g, 0.0) + float(np.abs(model.state[i]).sum())
    return out

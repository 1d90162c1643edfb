"""Cross-validated evaluation of the line labeller: splits, experiments, scored lines, noise floor, choice of groups.

An experiment is a set of feature groups. Each (experiment, split) is one grouped-map task that learns from the distinct
runs of its split; lines are scored where their documents lie. Every line is scored once in each experiment.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators import crf, features
from foliospark.operators.sampling import page_folds
from foliospark.operators.stats import ratio

#: Verdicts.
BETTER, WORSE, EVEN = "améliore", "dégrade", "neutre"


@dataclass(frozen=True)
class Experiment:
    name: str
    family: str
    groups: tuple[str, ...]
    c1: float = crf.C1
    c2: float = crf.C2


def experiments(grid: list[tuple[float, float]] = (), singles: bool = True, candidates: bool = True) -> list[Experiment]:
    """The production groups, placebos, each group left out, each by itself, each candidate added, and other penalties."""
    base = tuple(features.group_names("production"))
    out = [Experiment("production", "reference", base)]
    out += [Experiment(f"+{g}", "placebo", (*base, g)) for g in features.group_names("placebo")]
    out += [Experiment(f"-{g}", "ablation", tuple(x for x in base if x != g)) for g in base if g != "bias"]
    if singles:
        out += [Experiment(f"only {g}", "single", ("bias", g)) for g in base if g != "bias"]
    if candidates:
        out += [Experiment(f"+{g}", "candidate", (*base, g)) for g in features.group_names("candidate")]
    out += [Experiment(f"c1={a:g} c2={b:g}", "penalty", base, a, b) for a, b in grid]
    return out


def page_splits(lines: DataFrame, folds: int = 5) -> DataFrame:
    """lines(document, page, ...) with split: the fold, of contiguous pages of a document, in which a line is scored."""
    pages = page_folds(lines.select("document", "page").distinct(), folds)
    return lines.join(pages.withColumnRenamed("fold", "split"), ["document", "page"])


def _score(frame: pd.DataFrame, kept: set[str], learn: np.ndarray, held: np.ndarray, e: Experiment, classes: list[str], rounds: int) -> tuple[list[int], list[list[float]]]:
    """Rows that are held, and their marginals, by a model of the labelled rows to learn from; frame: sorted, with gold and features."""
    rows = [{k: v for k, v in dict(f).items() if k in kept} for f in frame["features"]]
    label = [y if ok and isinstance(y, str) else None for ok, y in zip(learn, frame["gold"], strict=True)]
    documents = frame["document"].to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], documents[1:] != documents[:-1]))).tolist() if len(frame) else []
    parts = list(zip(starts, [*starts[1:], len(frame)], strict=True))
    runs = [run for a, z in parts for run in crf.labelled_runs(rows[a:z], label[a:z])]
    model = crf.train(runs, e.c1, e.c2, rounds)
    at, out = [], []
    for a, z in parts:
        if not held[a:z].any():
            continue
        p = np.zeros((z - a, len(classes)))
        if model is None:
            p[:, [classes.index(y) for y in {y for _, ys in runs for y in ys} if y in classes] or slice(None)] = 1.0
        else:
            own = [i for i, c in enumerate(model.classes) if c in classes]
            p[:, [classes.index(model.classes[i]) for i in own]] = model.marginals(rows[a:z])[:, own]
        p /= p.sum(axis=1, keepdims=True)
        for k in np.flatnonzero(held[a:z]).tolist():
            at.append(a + k)
            out.append(p[k].tolist())
    return at, out


#: Runs that a task counts before it hands them on.
HELD_RUNS = 50_000


def _documents(lines: DataFrame, tried: list[Experiment]) -> DataFrame:
    """document, lines: its lines in order, with the features that each experiment reads."""
    groups = list(dict.fromkeys(g for e in tried for g in e.groups))
    kept = [F.array(*[F.lit(k) for k in sorted({k for g in e.groups for k in features.keys_of(g)})]) for e in tried]
    own = lambda keys: F.transform(F.array_sort(F.map_entries(F.map_filter("features", lambda k, _: F.array_contains(keys, k)))), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    whole = features.with_features(lines, groups)
    line = F.struct(F.col("pos").cast("long").alias("pos"), F.col("split").cast("int").alias("own"), F.col("label").alias("gold"), F.array(*[own(k) for k in kept]).alias("kinds"))
    return whole.groupBy("document").agg(F.array_sort(F.collect_list(line)).alias("lines"))


def _runs(tried: list[Experiment], splits: list[int]):
    """experiment, split, run, n: the labelled stretches of lines that a model learns from, equal ones counted together."""

    def frame(found: Counter) -> pd.DataFrame:
        rows = [(e, s, run, n) for (e, s, run), n in found.items()]
        return pd.DataFrame(rows, columns=["experiment", "split", "run", "n"])

    def work(batches):
        found: Counter = Counter()
        for batch in batches:
            for lines in batch["lines"]:
                own, gold = [x["own"] for x in lines], [x["gold"] for x in lines]
                here = set(own)
                for k, e in enumerate(tried):
                    told = [json.dumps([list(x["kinds"][k]), y]) if y is not None else None for x, y in zip(lines, gold, strict=True)]
                    for split in [*here, None]:
                        texts, run = [], []
                        for s, t in [*zip(own, told, strict=True), (None, None)]:
                            if t is not None and (split is None or s != split):
                                run.append(t)
                            elif run:
                                texts.append("[" + ",".join(run) + "]")
                                run = []
                        for s in [split] if split is not None else [s for s in splits if s not in here]:
                            found.update((e.name, s, t) for t in texts)
            if len(found) > HELD_RUNS:
                yield frame(found)
                found = Counter()
        yield frame(found)

    return work


def _marginals(tried: list[Experiment], models: dict[tuple[str, int], tuple[crf.Labeller | None, list[str]]], classes: list[str]):
    """A row for each line and experiment, scored by the model that hasn't seen its split; equal documents of a batch are computed once."""

    def scored(model: crf.Labeller | None, seen: list[str], sequences: list[tuple[tuple[str, ...], ...]]) -> list[np.ndarray]:
        if model is None:
            one = np.zeros(len(classes))
            one[[classes.index(y) for y in seen if y in classes] or slice(None)] = 1.0
            return [np.tile(one / one.sum(), (len(s), 1)) for s in sequences]
        kinds: dict[tuple[str, ...], int] = {}
        packed = crf.Packed([[kinds.setdefault(line, len(kinds)) for line in s] for s in sequences])
        e = np.array([model.state[[model.features[f] for f in line if f in model.features]].sum(axis=0) for line in kinds])
        raw = packed.expect(e[packed.lines], model.moves, np.ones(len(sequences)))[0][packed.at]
        own = [i for i, c in enumerate(model.classes) if c in classes]
        p = np.zeros((len(raw), len(classes)))
        p[:, [classes.index(model.classes[i]) for i in own]] = raw[:, own]
        p /= p.sum(axis=1, keepdims=True)
        return np.split(p, np.cumsum([len(s) for s in sequences])[:-1])

    def work(batches):
        for batch in batches:
            for k, e in enumerate(tried):
                wanted: dict[int, dict[tuple, list[int]]] = {}
                rows = list(batch["lines"])
                for d, lines in enumerate(rows):
                    sequence = tuple(tuple(x["kinds"][k]) for x in lines)
                    for split in {x["own"] for x in lines}:
                        wanted.setdefault(split, {}).setdefault(sequence, []).append(d)
                for split, of in wanted.items():
                    out = {c: [] for c in ("document", "pos", "gold", "marginals")}
                    for p, at in zip(scored(*models[e.name, split], list(of)), of.values(), strict=True):
                        values = p.tolist()
                        for d in at:
                            held = [(x["pos"], x["gold"], v) for x, v in zip(rows[d], values, strict=True) if x["own"] == split]
                            out["document"] += [batch["document"].iat[d]] * len(held)
                            for c, v in zip(("pos", "gold", "marginals"), zip(*held), strict=True):
                                out[c] += v
                    yield pd.DataFrame({"experiment": e.name, "split": np.int32(split), "document": pd.Series(out["document"], dtype=object), "pos": np.array(out["pos"], dtype=np.int64), "gold": pd.Series(out["gold"], dtype=object), "marginals": out["marginals"]})

    return work


def cross_validate(lines: DataFrame, tried: list[Experiment], classes: list[str], rounds: int = crf.ROUNDS) -> DataFrame:
    """experiment, split, document, pos, gold, marginals of lines(document, pos, label, split, and what features read).

    A line is scored by a model that learned from the labelled lines of all other splits; contiguous ones are a sequence.
    Documents are cut into runs where they lie, and equal runs are counted; a model is one task, which gets each distinct
    run once. The models, learned when this is called, then go to the documents.
    """
    of = {e.name: e for e in tried}
    if len(of) != len(tried):
        raise ValueError("two experiments of one name")
    documents = _documents(lines, tried).persist()
    splits = sorted(r[0] for r in documents.select(F.explode(F.array_distinct("lines.own"))).distinct().collect())
    runs = documents.mapInPandas(_runs(tried, splits), "experiment string, split int, run string, n long").groupBy("experiment", "split", "run").agg(F.sum("n").alias("n"))

    def learn(key, frame: pd.DataFrame) -> pd.DataFrame:
        e, data = of[key[0]], []
        for run, n in zip(frame["run"], frame["n"], strict=True):
            read = json.loads(run)
            data.append(([line for line, _ in read], [y for _, y in read], int(n)))
        model = crf.train_runs(data, e.c1, e.c2, rounds)
        seen = sorted({y for _, ys, _ in data for y in ys})
        return pd.DataFrame({"experiment": [key[0]], "split": [int(key[1])], "seen": [json.dumps(seen)], "model": [model and model.pruned().dump()]})

    learned = runs.groupBy("experiment", "split").applyInPandas(learn, "experiment string, split int, seen string, model string").collect()
    models: dict[tuple[str, int], tuple[crf.Labeller | None, list[str]]] = {(e.name, s): (None, []) for e in tried for s in splits}
    models |= {(r["experiment"], r["split"]): (crf.Labeller.load(r["model"]) if r["model"] else None, json.loads(r["seen"])) for r in learned}
    return documents.mapInPandas(_marginals(tried, models, classes), "experiment string, split int, document string, pos long, gold string, marginals array<double>")


def learning_runs(lines: DataFrame, budgets: list[int], seeds: int, classes: list[str], groups: tuple[str, ...] | None = None, rounds: int = crf.ROUNDS) -> DataFrame:
    """budget, seed, lines, f1: accuracy on the lines that a model which learned from so many pages, drawn by a seed, hasn't seen.

    lines: document, page, pos, label and what features read. Each (budget, seed) is one grouped-map task.
    """
    e = Experiment("curve", "curve", groups or tuple(features.group_names("production")))
    kept = {k for g in e.groups for k in features.keys_of(g)}
    pages = lines.select("document", "page").distinct().withColumn("seed", F.explode(F.sequence(F.lit(1), F.lit(seeds))))
    order = Window.partitionBy("seed").orderBy(F.md5(F.concat_ws("#", F.col("seed").cast("string"), "document", F.col("page").cast("string")).cast("binary")), "document", "page")
    drawn = pages.withColumn("turn", F.row_number().over(order))
    whole = features.with_features(lines, list(e.groups)).select("document", "page", "pos", F.col("label").alias("gold"), "features")
    dealt = whole.join(drawn, ["document", "page"]).withColumn("budget", F.explode(F.array(*[F.lit(b) for b in budgets])))

    def work(key, frame: pd.DataFrame) -> pd.DataFrame:
        budget, seed = key
        frame = frame.sort_values(["document", "pos"])
        learn = (frame["turn"] <= budget).to_numpy()
        held = ~learn & frame["gold"].notna().to_numpy()
        at, marginals = _score(frame, kept, learn, held, e, classes, rounds)
        gold = frame["gold"].to_numpy()[at]
        right = sum(classes[int(np.argmax(p))] == y for p, y in zip(marginals, gold, strict=True))
        return pd.DataFrame({"budget": [int(budget)], "seed": [int(seed)], "lines": [len(at)], "f1": [right / len(at) if at else 0.0]})

    return dealt.groupBy("budget", "seed").applyInPandas(work, "budget int, seed int, lines long, f1 double")


def scored_lines(found: DataFrame, classes: list[str], marginals: str = "marginals") -> DataFrame:
    """found with predicted, confidence (the largest marginal) and margin (over the second); the first class wins a tie."""
    p = F.col(marginals)
    top = F.sort_array(p, asc=False)
    names = F.array(*[F.lit(c) for c in classes])
    return found.withColumn("predicted", F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))).withColumn("confidence", top[0]).withColumn("margin", top[0] - F.coalesce(F.get(top, F.lit(1)), F.lit(0.0)))


def labelled_both(scored: DataFrame) -> DataFrame:
    """The lines that have a gold label and a prediction."""
    return scored.where(F.col("gold").isNotNull() & F.col("predicted").isNotNull())


def accuracy(scored: DataFrame) -> DataFrame:
    """experiment, lines, right, accuracy."""
    rows = labelled_both(scored).groupBy("experiment").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("gold") == F.col("predicted")).alias("right"))
    return rows.withColumn("accuracy", F.col("right") / F.col("lines"))


def noise_floor(values: DataFrame, metric: str = "accuracy", reference: str = "production", placebo: str = "placebo") -> DataFrame:
    """One row: floor, the largest change that a placebo makes to the reference. values: experiment, family, metric."""
    base = values.where(F.col("experiment") == reference).agg(F.max(metric).alias("__base"))
    return values.where(F.col("family") == placebo).join(base, F.lit(True)).agg(F.max(F.abs(F.col(metric) - F.col("__base"))).alias("floor"))


def verdicts(values: DataFrame, metric: str = "accuracy", reference: str = "production") -> DataFrame:
    """experiment, family, delta, verdict: an interval (low, high) of the change, if there is one, must lie beyond 0, and the change beyond the floor."""
    base = values.where(F.col("experiment") == reference).agg(F.max(metric).alias("__base"))
    met = values.join(base, F.lit(True)).join(noise_floor(values, metric, reference), F.lit(True)).withColumn("delta", F.col(metric) - F.col("__base"))
    low, high = (F.col(c) if c in values.columns else F.col("delta") for c in ("low", "high"))
    floor = F.coalesce("floor", F.lit(0.0))
    told = F.when((high < 0) & (-F.col("delta") > floor), WORSE).when((low > 0) & (F.col("delta") > floor), BETTER).otherwise(EVEN)
    return met.select("experiment", "family", "delta", told.alias("verdict"))


def selection(told: DataFrame, constant: list[str] = ()) -> tuple[list[str], list[str]]:
    """The groups to use and the reasons: production groups, without constant ones and those better left out, with candidates that help.

    told: rows of verdicts, as many as there are experiments.
    """
    rows = {(r["family"], r["experiment"]): r["verdict"] for r in told.collect()}
    groups, reasons = [g for g in features.group_names("production") if g not in constant], [f"without {g} (constant)" for g in constant]
    for g in list(groups):
        if rows.get(("ablation", f"-{g}")) == BETTER:
            groups.remove(g)
            reasons.append(f"without {g} (better left out)")
    for g in features.group_names("candidate"):
        if rows.get(("candidate", f"+{g}")) == BETTER:
            groups.append(g)
            reasons.append(f"with {g}")
    return groups, reasons


def constant_groups(unpivoted: DataFrame, group_of: dict[str, str]) -> DataFrame:
    """group: those of which every feature has one value throughout. unpivoted: feature, value."""
    of = F.create_map(*[F.lit(x) for p in group_of.items() for x in p])
    values = unpivoted.groupBy("feature").agg(F.count_distinct("value").alias("values"))
    return values.groupBy(of[F.col("feature")].alias("group")).agg(F.max("values").alias("values")).where(F.col("values") <= 1).select("group")


def page_entity_counts(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """document, page, kind, tp, predicted, gold of entities (document, kind, page of the first line, lines): right if all lines are the same."""
    key = F.concat_ws(",", F.array_sort("lines"))
    g, p = (df.select("document", "page", "kind", key.alias("key"), F.lit(1).alias(n)).distinct() for df, n in ((gold, "g"), (predicted, "p")))
    met = g.join(p, ["document", "page", "kind", "key"], "full")
    return met.groupBy("document", "page", "kind").agg(F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count("p").alias("predicted"), F.count("g").alias("gold"))


def counts_table(df: DataFrame, group: str, label: str, weight: str, labels: list[str], yes: str) -> DataFrame:
    """group, and of each label the rows and their weight, and the weighted share of `yes`; labels are compared without case and blanks."""
    own = F.upper(F.trim(label))
    n = [F.count_if(own == x).alias(f"n_{x.lower()}") for x in labels]
    w = [F.sum(F.when(own == x, F.col(weight)).otherwise(0.0)).alias(f"weight_{x.lower()}") for x in labels]
    out = df.groupBy(group).agg(*n, *w)
    total = sum((F.col(f"weight_{x.lower()}") for x in labels[1:]), F.col(f"weight_{labels[0].lower()}"))
    return out.withColumn("share", ratio(F.col(f"weight_{yes.lower()}"), total, None))


def model_weights(model: crf.Labeller) -> pd.DataFrame:
    """kind (state or move), name, class, weight: a row for each weight that isn't 0."""
    names = list(model.features)
    rows = [("state", names[i], model.classes[k], float(model.state[i, k])) for i, k in zip(*np.nonzero(model.state), strict=True)]
    rows += [("move", model.classes[i], model.classes[k], float(model.moves[i, k])) for i, k in zip(*np.nonzero(model.moves), strict=True)]
    return pd.DataFrame(rows, columns=["kind", "name", "class", "weight"])


def threshold_sweep(rows: DataFrame, thresholds: list[float], score: str = "score", gold: Column | None = None) -> DataFrame:
    """threshold, kept, right, precision, recall: what a system gives at each threshold of its score; gold: whether a row is right."""
    good = F.col("good") if gold is None else gold
    dealt = rows.select(F.col(score).alias("__s"), good.alias("__g"), F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"))
    out = dealt.groupBy("threshold").agg(F.count_if(F.col("__s") >= F.col("threshold")).alias("kept"), F.count_if((F.col("__s") >= F.col("threshold")) & F.col("__g")).alias("right"), F.count_if("__g").alias("__all"))
    return out.withColumn("precision", ratio(F.col("right"), F.col("kept"))).withColumn("recall", ratio(F.col("right"), F.col("__all"))).drop("__all")

"""Evaluation statistics as aggregates: confusion, F1, calibration, ranking, information, cluster bootstrap."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column, empty: float | None = 0.0) -> Column:
    """a / b; `empty` where b is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(empty).cast("double"))


def confusion(df: DataFrame, *by: str, gold: str = "gold", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(*by, gold, predicted).agg(F.count(F.lit(1)).alias("n"))


def per_class(df: DataFrame, gold: str = "gold", predicted: str = "predicted", weight: Column | None = None) -> DataFrame:
    """class, tp, fp, fn, precision, recall, f1: one partial aggregate over (class) of both columns; 0 / 0 is 0."""
    w = F.lit(1.0) if weight is None else weight
    rows = df.select(F.explode(F.when(F.col(gold) == F.col(predicted), F.array(F.struct(F.col(gold).alias("class"), w.alias("tp"), F.lit(0.0).alias("fp"), F.lit(0.0).alias("fn")))).otherwise(F.array(F.struct(F.col(gold).alias("class"), F.lit(0.0).alias("tp"), F.lit(0.0).alias("fp"), w.alias("fn")), F.struct(F.col(predicted).alias("class"), F.lit(0.0).alias("tp"), w.alias("fp"), F.lit(0.0).alias("fn"))))).alias("r")).select("r.*")
    sums = rows.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.withColumn("precision", p).withColumn("recall", r).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def overall(df: DataFrame, gold: str = "gold", predicted: str = "predicted") -> DataFrame:
    """One row: accuracy, macro_f1 over the classes that gold has."""
    known = df.groupBy(F.col(gold).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    macro = per_class(df, gold, predicted).join(known, "class").agg(F.avg("f1").alias("macro_f1"))
    return df.agg(F.avg((F.col(gold) == F.col(predicted)).cast("double")).alias("accuracy")).join(macro, F.lit(True))


def entity_f1(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """kind, tp, predicted, gold, f1 of entities (document, kind, lines): right if all lines are the same."""
    key = F.concat_ws(",", F.array_sort("lines"))
    g, p = (df.select("document", "kind", key.alias("key"), F.lit(1).alias(n)).distinct() for df, n in ((gold, "g"), (predicted, "p")))
    met = g.join(p, ["document", "kind", "key"], "full")
    sums = met.groupBy("kind").agg(F.count(F.when(F.col("g").isNotNull() & F.col("p").isNotNull(), 1)).alias("tp"), F.count("p").alias("predicted"), F.count("g").alias("gold"))
    return sums.withColumn("f1", ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("gold")))


def calibration(df: DataFrame, confidence: str = "confidence", correct: str = "correct", bins: int = 10) -> DataFrame:
    """low, high, n, confidence, accuracy by right-closed bins; 0 is in the first."""
    k = F.greatest(F.ceil(F.col(confidence) * bins) - 1, F.lit(0)).cast("int")
    k = F.least(k, F.lit(bins - 1))
    return df.groupBy(k.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(confidence).alias("confidence"), F.avg(F.col(correct).cast("double")).alias("accuracy")).select((F.col("bin") / bins).alias("low"), ((F.col("bin") + 1) / bins).alias("high"), "n", "confidence", "accuracy")


def calibration_error(df: DataFrame, confidence: str = "confidence", correct: str = "correct", bins: int = 10) -> DataFrame:
    t = calibration(df, confidence, correct, bins)
    return t.agg((F.sum(F.col("n") * F.abs(F.col("confidence") - F.col("accuracy"))) / F.sum("n")).alias("ece"))


def running_sums(counts: DataFrame, key: str, sums: list[str], descending: bool = False, blocks: int = 64) -> DataFrame:
    """counts with before_<c>: the sum of each c over all rows that come before in the order of key (distinct numbers).

    Rows are dealt into blocks by quantiles of the key, summed within each, and shifted by the sums of the blocks before:
    no task sees all keys. What reaches the driver is one number per block.
    """
    cuts = counts.agg(F.percentile_approx(key, [i / blocks for i in range(1, blocks)])).first()[0] or []
    block = F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts))]), lambda c: c < F.col(key))) if cuts else F.lit(0)
    dealt = counts.withColumn("__block", block)
    order = F.desc if descending else F.asc
    totals = dealt.groupBy("__block").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    earlier = Window.orderBy(order("__block")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = F.broadcast(totals.select("__block", *[F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}") for c in sums]))
    own = Window.partitionBy("__block").orderBy(order(key)).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.join(shifts, "__block").select(*counts.columns, *[(F.coalesce(F.sum(c).over(own), F.lit(0)) + F.col(f"__{c}")).alias(f"before_{c}") for c in sums])


def auroc(df: DataFrame, score: str = "score", positive: str = "positive") -> DataFrame:
    """One row: the chance that a positive scores above a negative, ties half; null with one class."""
    counts = df.groupBy(score).agg(F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg"))
    wins = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2))
    return running_sums(counts, score, ["neg"]).agg(F.when((F.sum("pos") > 0) & (F.sum("neg") > 0), wins / (F.sum("pos") * F.sum("neg"))).alias("auroc"))


def review_capture(df: DataFrame, budgets: list[float], uncertainty: str = "uncertainty", error: str = "error", order: str = "id") -> DataFrame:
    """budget, reviewed, share: errors found in the most uncertain share of rows, ties in order.

    The rank comes from running counts per uncertainty; only the tie at the edge of each budget is ordered.
    """
    total = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(error).alias("errors"))
    cuts = total.select("rows", "errors", F.explode(F.array(*[F.lit(float(b)) for b in budgets])).alias("budget")).withColumn("reviewed", F.ceil(F.col("budget") * F.col("rows")))
    counts = df.groupBy(uncertainty).agg(F.count(F.lit(1)).alias("n"), F.count_if(error).alias("e"))
    steps = running_sums(counts, uncertainty, ["n", "e"], descending=True)
    edge = F.broadcast(cuts).join(steps, (F.col("before_n") < F.col("reviewed")) & (F.col("before_n") + F.col("n") >= F.col("reviewed")))
    tie = df.join(F.broadcast(edge.select("budget", "reviewed", "before_n", F.col(uncertainty))), uncertainty).withColumn("nth", F.row_number().over(Window.partitionBy("budget").orderBy(order)))
    inside = tie.where(F.col("nth") <= F.col("reviewed") - F.col("before_n")).groupBy("budget").agg(F.count_if(error).alias("more"))
    found = edge.join(inside, "budget", "left").select("budget", F.coalesce("before_e", F.lit(0)).alias("before_e"), F.coalesce("more", F.lit(0)).alias("more"))
    return cuts.join(found, "budget", "left").select("budget", F.col("reviewed").cast("long").alias("reviewed"), ratio((F.coalesce("before_e", F.lit(0)) + F.coalesce("more", F.lit(0))).cast("double"), F.col("errors"), None).alias("share"))


def information(df: DataFrame, cls: str = "class", feature: str = "feature", value: str = "value") -> DataFrame:
    """Of each feature: rows, values, entropy (bits), mutual information with the class, its bias, normalised, top share."""
    cells = df.groupBy(feature, value, cls).agg(F.count(F.lit(1)).cast("double").alias("n"))
    by_f, by_v, by_c = Window.partitionBy(feature), Window.partitionBy(feature, value), Window.partitionBy(feature, cls)
    cells = cells.withColumn("all", F.sum("n").over(by_f)).withColumn("nv", F.sum("n").over(by_v)).withColumn("nc", F.sum("n").over(by_c))
    mutual = F.sum(F.col("n") / F.col("all") * F.log2(F.col("n") * F.col("all") / (F.col("nv") * F.col("nc"))))
    # each value's own share is spread over its cells in proportion
    entropy = -F.sum(F.col("n") / F.col("all") * F.log2(F.col("nv") / F.col("all")))
    class_entropy = -F.sum(F.col("n") / F.col("all") * F.log2(F.col("nc") / F.col("all")))
    out = cells.groupBy(feature).agg(F.max("all").cast("long").alias("rows"), F.countDistinct(value).alias("values"), F.countDistinct(cls).alias("classes"), entropy.alias("entropy"), class_entropy.alias("class_entropy"), mutual.alias("mutual"), (F.max("nv") / F.max("all")).alias("top_share"))
    bias = (F.col("values") - 1) * (F.col("classes") - 1) / (2 * F.col("rows") * F.log(F.lit(2.0)))
    return out.withColumn("bias", bias).withColumn("normalized", ratio(F.col("mutual"), F.col("class_entropy")))


def rules(df: DataFrame, k: int = 3, support: int = 30, cls: str = "class", feature: str = "feature", value: str = "value") -> DataFrame:
    """The k best rules `feature = value => class` of each class by F1, of at least `support` rows."""
    cells = df.groupBy(feature, value, cls).agg(F.count(F.lit(1)).alias("tp"))
    of_value = cells.groupBy(feature, value).agg(F.sum("tp").alias("n"))
    of_class = cells.groupBy(feature, cls).agg(F.sum("tp").alias("m"))
    met = cells.join(of_value, [feature, value]).join(of_class, [feature, cls]).where(F.col("n") >= support)
    scored = met.withColumn("precision", F.col("tp") / F.col("n")).withColumn("recall", F.col("tp") / F.col("m")).withColumn("f1", 2 * F.col("tp") / (F.col("n") + F.col("m")))
    rank = F.row_number().over(Window.partitionBy(cls).orderBy(F.desc("f1"), feature, value))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select(cls, "rank", feature, value, "tp", "precision", "recall", "f1")


def redundancy(df: DataFrame, row: str = "id", feature: str = "feature", value: str = "value") -> DataFrame:
    """Symmetric uncertainty of every two features: 2 I(a; b) / (H(a) + H(b)).

    Rows meet themselves only: an equi-join on the row of as many pairs as there are features.
    """
    a, b = df.select(row, F.col(feature).alias("a"), F.col(value).alias("va")), df.select(row, F.col(feature).alias("b"), F.col(value).alias("vb"))
    cells = a.join(b, row).where(F.col("a") < F.col("b")).groupBy("a", "b", "va", "vb").agg(F.count(F.lit(1)).cast("double").alias("n"))
    w = Window.partitionBy("a", "b")
    cells = cells.withColumn("all", F.sum("n").over(w)).withColumn("na", F.sum("n").over(Window.partitionBy("a", "b", "va"))).withColumn("nb", F.sum("n").over(Window.partitionBy("a", "b", "vb")))
    p = F.col("n") / F.col("all")
    sums = cells.groupBy("a", "b").agg(F.sum(p * F.log2(F.col("n") * F.col("all") / (F.col("na") * F.col("nb")))).alias("i"), (-F.sum(p * F.log2(F.col("na") / F.col("all")))).alias("ha"), (-F.sum(p * F.log2(F.col("nb") / F.col("all")))).alias("hb"))
    return sums.select("a", "b", ratio(2 * F.col("i"), F.col("ha") + F.col("hb")).alias("uncertainty"))


def flags(df: DataFrame, thresholds: list[float], score: str = "score", error: str = "error", weight: str = "weight") -> DataFrame:
    """Of each threshold: the weighted share of rows flagged (score below it), of errors caught, and of flagged that are errors; null for 0 / 0."""
    rows = df.select(F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"), F.col(score).alias("s"), F.col(error).cast("double").alias("e"), F.col(weight).alias("w"))
    flagged = F.when(F.col("s") < F.col("threshold"), F.col("w")).otherwise(0.0)
    sums = rows.groupBy("threshold").agg(F.sum("w").alias("all"), F.sum(flagged).alias("f"), F.sum(F.col("w") * F.col("e")).alias("bad"), F.sum(flagged * F.col("e")).alias("hit"))
    return sums.select("threshold", ratio(F.col("f"), F.col("all"), None).alias("flagged"), ratio(F.col("hit"), F.col("bad"), None).alias("caught"), ratio(F.col("hit"), F.col("f"), None).alias("precision"))


def breakdown(df: DataFrame, key: str, value: Column, weight: str = "weight", limit: int = 20) -> DataFrame:
    """The largest groups: key, n, weighted rate. A report, hence the limit."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), ratio(F.sum(value.cast("double") * F.col(weight)), F.sum(weight), None).alias("rate")).orderBy(F.desc("n"), key).limit(limit)


def verdict(delta: Column, noise: Column) -> Column:
    return F.when(delta > noise, "improves").when(delta < -noise, "degrades").otherwise("neutral")


def _poisson_steps(terms: int = 15) -> list[float]:
    """The probabilities that a Poisson number of mean 1 is at most 0, 1, ...."""
    p, total, out = math.exp(-1.0), 0.0, []
    for k in range(terms):
        p = p / k if k else p
        total += p
        out.append(total)
    return out[:-1]


POISSON = _poisson_steps()


def draws(seed: int, sample: Column, cluster: Column) -> Column:
    """How often a sample draws a cluster: a Poisson number of mean 1 hashed from all three."""
    text = F.concat_ws(":", F.lit(str(seed)), sample.cast("string"), F.coalesce(cluster.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    return F.size(F.filter(F.array(*[F.lit(s) for s in POISSON]), lambda s: s <= u))


def _stack(df: DataFrame, metrics: Iterable[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics])).alias("r")).select("r.*")


def bootstrap(df: DataFrame, cluster: str, sums: dict[str, Column], metrics: dict[str, Column], samples: int = 1000, seed: int = 0, level: float = 0.95) -> DataFrame:
    """metric, value, low, high: metrics of resampled sums; clusters are resampled, rows never.

    Clusters are summed first, so one row per cluster meets each sample. How often a sample draws a cluster is hashed,
    which needs no driver-made table of weights and tends to the multinomial as clusters grow in number.
    """
    per = df.groupBy(cluster).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    point = per.agg(*[F.sum(n).alias(n) for n in sums]).select(*[c.alias(m) for m, c in metrics.items()])
    drawn = per.withColumn("__sample", F.explode(F.sequence(F.lit(1), F.lit(samples)))).withColumn("__draws", draws(seed, F.col("__sample"), F.col(cluster)))
    resampled = drawn.groupBy("__sample").agg(*[F.sum(F.col(n) * F.col("__draws")).alias(n) for n in sums]).select(*[c.alias(m) for m, c in metrics.items()])
    a = (1 - level) / 2
    spread = _stack(resampled, metrics).groupBy("metric").agg(F.percentile("v", F.lit(a)).alias("low"), F.percentile("v", F.lit(1 - a)).alias("high"))
    return _stack(point, metrics).join(spread, "metric").select("metric", F.col("v").alias("value"), "low", "high")


def paired_deltas(one: DataFrame, other: DataFrame, cluster: str, sums: dict[str, Column], metrics: dict[str, Column], samples: int = 1000, seed: int = 0, level: float = 0.95) -> DataFrame:
    """metric, delta, low, high: metrics of other less those of one, both resampled by the same draws of their clusters."""
    sides = [df.groupBy(cluster).agg(*[F.sum(c).alias(f"{side}_{n}") for n, c in sums.items()]) for side, df in (("one", one), ("other", other))]
    names = [f"{side}_{n}" for side in ("one", "other") for n in sums]
    per = sides[0].join(sides[1], cluster, "full").na.fill(0.0, names)
    total = lambda df: df.agg(*[F.sum(n).alias(n) for n in names])

    def deltas(df: DataFrame) -> DataFrame:
        values = {side: df.select("*", F.struct(*[F.col(f"{side}_{n}").alias(n) for n in sums]).alias("x")).select("*", "x.*").select(*[c for c in df.columns if c not in sums], *[c.alias(f"{side}__{m}") for m, c in metrics.items()]) for side in ("one", "other")}
        met = values["one"].join(values["other"].select("__sample", *[f"other__{m}" for m in metrics]), "__sample")
        return met.select("__sample", *[(F.col(f"other__{m}") - F.col(f"one__{m}")).alias(m) for m in metrics])

    drawn = per.withColumn("__sample", F.explode(F.sequence(F.lit(1), F.lit(samples)))).withColumn("__draws", draws(seed, F.col("__sample"), F.col(cluster)))
    resampled = drawn.groupBy("__sample").agg(*[F.sum(F.col(n) * F.col("__draws")).alias(n) for n in names])
    a = (1 - level) / 2
    spread = _stack(deltas(resampled), metrics).groupBy("metric").agg(F.percentile("v", F.lit(a)).alias("low"), F.percentile("v", F.lit(1 - a)).alias("high"))
    point = _stack(deltas(total(per).withColumn("__sample", F.lit(0))), metrics)
    return point.join(spread, "metric").select("metric", F.col("v").alias("delta"), "low", "high")


def cut(value: Column, bounds: list[float]) -> Column:
    """The bin (a, b] that a number falls in, null outside."""
    out = None
    for a, b in zip(bounds, bounds[1:]):
        inside, name = (value > a) & (value <= b), f"({a}, {b}]"
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out


def described(df: DataFrame, by: str, value: str) -> DataFrame:
    """count, mean, min, quartiles and max of a value, by group."""
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)]))
    out = df.groupBy(by).agg(F.count(value).alias("count"), F.round(F.avg(value), 6).alias("mean"), F.min(value).alias("min"), q.alias("__q"), F.max(value).alias("max"))
    return out.select(by, "count", "mean", "min", *[F.col("__q")[k].alias(n) for k, n in enumerate(("q25", "q50", "q75"))], "max")

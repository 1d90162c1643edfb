"""Entity tagging: a pluggable scorer in batches, comparison with gold spans, training data for a word-level tagger."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import spans as SP
from foliospark.functions.spans import SPANS, Span

#: A scorer takes plain texts and gives, for each, spans with scores. It may raise on a batch, or on a single text.
Scorer = Callable[[list[str]], list[list[Span]]]


def rule_scorer(texts: list[str]) -> list[list[Span]]:
    """Subject up to the first comma, address from the last comma that a number follows: a stand-in without a model."""
    import re

    out = []
    for t in texts:
        cut = t.find(",")
        spans = [Span(0, cut if cut > 0 else len(t), "SUBJ", 0.95)] if t else []
        m = re.search(r",\s*([^,]*,\s*\d+)\s*\.?$", t)
        if m and m.start(1) > (cut if cut > 0 else len(t)):
            spans.append(Span(m.start(1), m.end(1), "ADDR", 0.9))
        out.append(spans)
    return out


def predict(entries: DataFrame, scorer: Scorer, text: str = "text", batch: int = 16) -> DataFrame:
    """entries with spans on the plain text (null where the scorer fails on the text alone) and error."""
    kind = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("score", pa.float64())]))), ("error", pa.string())])

    def run(column: pa.Array) -> pa.Array:
        texts = [SP.plain_with_origin(t or "")[0] for t in column.to_pylist()]
        out = []
        for at in range(0, len(texts), batch):
            own = texts[at : at + batch]
            try:
                found = [(s, None) for s in scorer(own)]
            except Exception:  # one bad text may sink a batch: try each by itself
                found = []
                for t in own:
                    try:
                        found.append((scorer([t])[0], None))
                    except Exception as error:
                        found.append((None, str(error)))
            out += [{"spans": None if s is None else [x._asdict() for x in SP.trim(t, s)], "error": e} for t, (s, e) in zip(own, found, strict=True)]
        return pa.array(out, type=kind)

    return entries.withColumn("__p", F.arrow_udf(run, f"struct<spans:{SPANS},error:string>")(F.col(text))).withColumn("spans", F.col("__p.spans")).withColumn("error", F.col("__p.error")).drop("__p")


COMPARED = "struct<exact:boolean,kind:string,tp:map<string,int>,fp:map<string,int>,fn:map<string,int>,tokens_right:int,tokens:int>"


def compare_spans(text: str, gold: list[Span], predicted: list[Span]) -> dict:
    g, p = set(SP.canonical(text, gold)), set(SP.canonical(text, predicted))
    kind = "ok" if g == p else "signature" if SP.signature(gold) != SP.signature(predicted) else "frontière"

    def labels(spans):
        for a, z in SP.word_bounds(text):
            at = next((i for i in range(a, z) if text[i].isalnum() or text[i] == "_"), None)
            yield None if at is None else next((s.label for s in spans if s.start <= at < s.end), "O")

    pairs = [(x, y) for x, y in zip(labels(gold), labels(predicted), strict=True) if x is not None]
    count = lambda s: [(label, sum(x[0] == label for x in s)) for label in SP.LABELS]
    return {"exact": g == p, "kind": kind, "tp": count(g & p), "fp": count(p - g), "fn": count(g - p), "tokens_right": sum(x == y for x, y in pairs), "tokens": len(pairs)}


def compare(text: Column, gold: Column, predicted: Column) -> Column:
    """How a prediction differs from gold: exact, kind of error, counts by label, right tokens. A missing prediction is an empty one."""
    counts = pa.map_(pa.string(), pa.int32())
    kind = pa.struct([("exact", pa.bool_()), ("kind", pa.string()), ("tp", counts), ("fp", counts), ("fn", counts), ("tokens_right", pa.int32()), ("tokens", pa.int32())])

    def run(t: pa.Array, g: pa.Array, p: pa.Array) -> pa.Array:
        return pa.array([compare_spans(a, SP._as_spans(b), SP._as_spans(c)) for a, b, c in zip(t.to_pylist(), g.to_pylist(), p.to_pylist(), strict=True)], type=kind)

    return F.arrow_udf(run, COMPARED)(text, gold, predicted)


def weighted_metrics(compared: DataFrame, weight: str = "weight", into: str = "c") -> DataFrame:
    """One row: exactness, F1 by label and micro, token accuracy, weighted; NaN for 0 / 0."""
    w, c = F.col(weight), F.col(into)
    total = lambda k, label: F.sum(w * F.coalesce(F.try_element_at(c[k], F.lit(label)), F.lit(0)))
    nan = F.lit(float("nan"))
    div = lambda a, b: F.when(b > 0, a / b).otherwise(nan)
    sums = compared.agg(F.sum(w * c["exact"].cast("double")).alias("exact"), F.sum(w).alias("w"), F.sum(w * c["tokens_right"]).alias("right"), F.sum(w * c["tokens"]).alias("tokens"), *[total(k, label).alias(f"{k}_{label}") for label in SP.LABELS for k in ("tp", "fp", "fn")])
    f1 = lambda tp, fp, fn: div(2 * tp, 2 * tp + fp + fn)
    every = [sum(F.col(f"{k}_{label}") for label in SP.LABELS) for k in ("tp", "fp", "fn")]
    return sums.select(div(F.col("exact"), F.col("w")).alias("exactness"), *[f1(*[F.col(f"{k}_{label}") for k in ("tp", "fp", "fn")]).alias(f"f1_{label.lower()}") for label in SP.LABELS], f1(*every).alias("f1_micro"), div(F.col("right"), F.col("tokens")).alias("token_accuracy"))


def prune_nested(spans: DataFrame) -> DataFrame:
    """spans(id, start, end, label) without repeats and without those inside a longer one of the same label."""
    own = spans.select("id", "start", "end", "label").distinct()
    other = own.select("id", "label", F.col("start").alias("a"), F.col("end").alias("z"))
    inside = (own["id"] == other["id"]) & (own["label"] == other["label"]) & (F.col("a") <= F.col("start")) & (F.col("z") >= F.col("end")) & ((F.col("z") - F.col("a")) > (F.col("end") - F.col("start")))
    return own.join(other, inside, "left_anti")


def to_word_spans(text: Column, spans: Column) -> Column:
    """array<struct<first,last,label>>: spans widened to the words they overlap."""
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("label", pa.string())]))

    def run(t: pa.Array, s: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(t.to_pylist(), s.to_pylist(), strict=True):
            bounds = SP.word_bounds(x or "")
            met = [(SP.to_words(bounds, p["start"], p["end"]), p["label"]) for p in y or ()]
            out.append([{"first": w[0], "last": w[1], "label": label} for w, label in met if w])
        return pa.array(out, type=kind)

    return F.arrow_udf(run, "array<struct<first:int,last:int,label:string>>")(text, spans)


def train_test(tasks: DataFrame, page: Column, test: float = 0.1) -> DataFrame:
    """tasks with role: pages go whole to one side, by the first four bytes of the page's sha1."""
    share = F.conv(F.substring(F.sha1(page.cast("binary")), 1, 8), 16, 10).cast("long") / float(1 << 32)
    return tasks.withColumn("role", F.when(share < test, "test").otherwise("train"))


def exact_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """label, tp, predicted, gold, precision, recall, f1 of spans (id, start, end, label) matched exactly."""
    g, p = (df.select("id", "start", "end", "label").distinct().withColumn(n, F.lit(1)) for df, n in ((gold, "g"), (predicted, "p")))
    sums = g.join(p, ["id", "start", "end", "label"], "full").groupBy("label").agg(F.count(F.when(F.col("g").isNotNull() & F.col("p").isNotNull(), 1)).alias("tp"), F.count("p").alias("predicted"), F.count("g").alias("gold"))
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return sums.withColumn("precision", div(F.col("tp"), F.col("predicted"))).withColumn("recall", div(F.col("tp"), F.col("gold"))).withColumn("f1", div(2 * F.col("tp"), F.col("predicted") + F.col("gold")))


def correction_problem(tagged: Column, current: Column, parent_known: Column) -> Column:
    """Why a hand-tagged text can't be applied: bad tags, a text that has changed, a parent that is gone; null if it can."""
    p = SP.parsed(tagged)
    return F.when((F.coalesce(tagged, F.lit("")) != "") & p["error"].isNotNull(), p["error"]).when((F.coalesce(tagged, F.lit("")) != "") & (p["text"] != F.trim(current)), "text has changed").when(~parent_known, "parent is gone")


def preferred(entries: DataFrame, curated: str = "curated", model: str = "spans") -> DataFrame:
    """Spans to train on: curated if there are any, else the model's; usable if they begin with a subject."""
    pick = F.coalesce(F.when(F.size(curated) > 0, F.col(curated)), F.col(model))
    return entries.withColumn("chosen", pick).withColumn("usable", (F.size("chosen") > 0) & SP.signature_of(F.col("chosen")).startswith("SUBJ"))


def latest_by_text(df: DataFrame, text: str, order: str) -> DataFrame:
    """The last row of each text."""
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(text).orderBy(F.desc(order)))).where("__nth = 1").drop("__nth")


def from_tasks(tasks: list[dict], prefer: str = "annotations") -> pd.DataFrame:
    """key, text, spans of annotation tasks that were read as JSON."""
    rows = [(t["data"].get("key"), t["data"]["text"], SP.annotated_spans(t, prefer)) for t in tasks]
    return pd.DataFrame([{"key": k, "text": x, "spans": None if s is None else [y._asdict() for y in s]} for k, x, s in rows])

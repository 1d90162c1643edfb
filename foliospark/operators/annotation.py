"""Lines to annotate, the state of annotation and its checks, and the annotated document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import strip
from foliospark.operators.lines import walk

#: Where a label comes from.
USER, MODEL, NONE = "user", "model", "unclassified"


def annotatable(lines: DataFrame) -> DataFrame:
    """Lines (document, pos, text) that aren't blank, stripped, with source_row from 1 and follows_blank.

    A line without a text is an error: `error` names it. follows_blank: the line right before is blank.
    """
    order = Window.partitionBy("document").orderBy("pos")
    text = strip(F.coalesce("text", F.lit("")))
    blank = (text == "") & F.col("text").isNotNull()
    own = lines.withColumn("follows_blank", F.coalesce(F.lag(blank).over(order), F.lit(False))).withColumn("error", F.when(F.col("text").isNull(), "line without a text")).where(~blank)
    return own.withColumn("text", strip(F.col("text"))).withColumn("source_row", F.row_number().over(order))


def source_hash(lines: DataFrame) -> DataFrame:
    """document, sha256 of its annotatable lines (source_row, key, text): what a session is bound to."""
    row = F.struct("source_row", F.concat_ws("\t", F.coalesce("key", F.lit("")), "text").alias("line"))
    return lines.groupBy("document").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["line"]), "\n"), 256).alias("sha256"))


def stale_sessions(sessions: DataFrame, lines: DataFrame) -> DataFrame:
    """document, problem: sessions (document, sha256) of lines that have changed, or are gone, since."""
    met = sessions.select("document", F.col("sha256").alias("__bound")).join(source_hash(lines), "document", "left")
    problem = F.when(F.col("sha256").isNull(), "no such lines").when(F.col("sha256") != F.col("__bound"), "the lines have changed")
    return met.select("document", problem.alias("problem")).where(F.col("problem").isNotNull())


def restored(state: DataFrame, lines: DataFrame) -> DataFrame:
    """The labels (document, pos, label, time) of a session on the lines that it was made on; lines without one have none."""
    return lines.join(state.select("document", "pos", "label", "time"), ["document", "pos"], "left")


def session_problems(labels: DataFrame, history: DataFrame, classes: list[str]) -> DataFrame:
    """document, problem, pos of a session: labels(document, pos, label, time) and history(document, n, pos).

    Labels must be classes; the history must name each labelled line once and no other; only labelled lines have times.
    """
    known = F.col("label").isin(*classes)
    unknown = labels.where(F.col("label").isNotNull() & ~known).select("document", F.lit("unknown label").alias("problem"), "pos")
    timed = labels.where(F.col("label").isNull() & F.col("time").isNotNull()).select("document", F.lit("time without a label"), "pos")
    given = labels.where(F.col("label").isNotNull()).select("document", "pos")
    counts = history.groupBy("document", "pos").agg(F.count(F.lit(1)).alias("__n"))
    twice = counts.where(F.col("__n") > 1).select("document", F.lit("twice in the history"), "pos")
    missing = given.join(counts, ["document", "pos"], "left_anti").select("document", F.lit("not in the history"), "pos")
    other = counts.join(given, ["document", "pos"], "left_anti").select("document", F.lit("in the history without a label"), "pos")
    return unknown.union(timed).union(twice).union(missing).union(other)


def annotated(lines: DataFrame, state: DataFrame, predictions: DataFrame) -> DataFrame:
    """Annotatable lines with prediction, provenance, probability (four digits) and timestamp.

    state: document, pos, label, time, as people gave them; predictions: document, pos, prediction, probability. What
    neither has is unclassified.
    """
    s = state.select("document", "pos", F.col("label").alias("__label"), F.col("time").alias("timestamp"))
    p = predictions.select("document", "pos", F.col("prediction").alias("__guess"), F.col("probability").alias("__p"))
    met = lines.join(s, ["document", "pos"], "left").join(p, ["document", "pos"], "left")
    user, model = F.col("__label").isNotNull(), F.col("__guess").isNotNull()
    met = met.withColumn("prediction", F.coalesce("__label", "__guess", F.lit(""))).withColumn("provenance", F.when(user, USER).when(model, MODEL).otherwise(NONE))
    return met.withColumn("probability", F.round(F.when(user, 1.0).when(model, F.col("__p")).otherwise(0.0), 4)).drop("__label", "__guess", "__p")


def any_annotated(lines: DataFrame, prediction: str = "prediction") -> DataFrame:
    """document, annotated: whether a line has a prediction; corrections apply to such documents only."""
    return lines.groupBy("document").agg(F.max(F.col(prediction).isNotNull()).alias("annotated"))


def annotated_pages(pages: DataFrame, marks: DataFrame) -> DataFrame:
    """pages(document, pages) with each line's prediction, provenance, probability and timestamp set from marks.

    marks: document, pos (as `walk` gives it) and the four fields. Lines without a mark, blank ones, stay as they are.
    """
    fields = ("prediction", "provenance", "probability", "timestamp")
    held = marks.groupBy("document").agg(F.map_from_entries(F.collect_list(F.struct("pos", F.struct(*fields)))).alias("__marks"))
    met = pages.join(held, "document", "left")
    mark = lambda *at: F.try_element_at("__marks", F.shiftleft(at[0].cast("long"), 42) + F.shiftleft(at[1].cast("long"), 21) + at[2])

    def line(x: Column, *at: Column) -> Column:
        m = mark(*at)
        out = x
        for f in fields:
            out = out.withField(f, F.when(m.isNotNull(), m[f]).otherwise(x[f]))
        return out

    new = F.transform("pages", lambda page, i: page.withField("data_blocks", F.transform(page["data_blocks"], lambda b, j: b.withField("lines", F.transform(b["lines"], lambda x, k: line(x, i, j, k))))))
    return met.withColumn("pages", new).drop("__marks")


def missing_lines(pages: DataFrame, marks: DataFrame) -> DataFrame:
    """document, pos of marks that no line of the pages has."""
    return marks.join(walk(pages).select("document", "pos"), ["document", "pos"], "left_anti").select("document", "pos")


def context(lines: DataFrame) -> DataFrame:
    """Annotatable lines as the feature groups read them: page, block, ocr_label and box under the names these expect."""
    block = F.concat_ws(".", F.col("page_pos").cast("string"), F.col("block_pos").cast("string"))
    return lines.select("document", "pos", "text", "source_row", "follows_blank", F.col("page_pos").alias("page"), block.alias("block"), F.col("block_label").alias("ocr_label"), F.col("block_bbox").cast("string").alias("box"))

"""Lines: nested pages flattened in document order, quality columns, fingerprints, features of single lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOUBT = 0.9
#: The classes of a line, that of one left undecided, and that of one deleted by hand.
UNDECIDED = "¯\\_(ツ)_/¯"
CLASSES = ["B-ENTRY", "I-ENTRY", "SUB-ENTRY", "B-TITLE", "I-TITLE", UNDECIDED, "OUT OF SCOPE"]
DELETED = "SUPPRIMÉE"


def walk(pages: DataFrame, document: str = "document", nested: str = "pages") -> DataFrame:
    """A row per line of nested pages -> data_blocks -> lines, with the ranks of each level and `pos` in the document.

    pos packs the three ranks, so the order needs no shuffle.
    """
    rows = pages.select(document, F.posexplode(nested).alias("page_pos", "page"))
    rows = rows.select(document, "page_pos", F.col("page.page_index").alias("page_index"), F.posexplode("page.data_blocks").alias("block_pos", "block"))
    rows = rows.select(document, "page_pos", "page_index", "block_pos", F.col("block.index").alias("block_index"), F.col("block.label").alias("block_label"), F.col("block.bbox").alias("block_bbox"), F.col("block.chunk_index").alias("chunk_index"), F.posexplode("block.lines").alias("line_pos", "line"))
    pos = F.shiftleft(F.col("page_pos").cast("long"), 42) + F.shiftleft(F.col("block_pos").cast("long"), 21) + F.col("line_pos")
    return rows.withColumn("pos", pos)


def split_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """document, pos (from 0), text: a row per line of each text."""
    return docs.select(F.col(key).cast("string").alias("document"), *keep, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("pos", "text"))


def lowest_score(words: Column) -> Column:
    """The least score of an array of (word, score), null without."""
    return F.array_min(F.transform(words, lambda w: w["score"]))


def doubtful(score: Column, least: float = DOUBT) -> Column:
    return F.coalesce(score < least, F.lit(False))


def zip_scores(words: Column, scores: Column) -> Column:
    """array<struct<word,score>> of two blank-separated strings; null if their counts differ."""
    w, s = F.split(F.trim(words), r"\s+"), F.split(F.trim(scores), r"\s+")
    zipped = F.zip_with(w, s, lambda a, b: F.struct(a.alias("word"), b.cast("double").alias("score")))
    return F.when((F.size(w) == F.size(s)) & (F.trim(scores) != ""), zipped)


def is_corrected(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit("")))) == "oui"


def known_class(c: Column) -> Column:
    return c.isin(*CLASSES, DELETED)


def parse_box(c: Column) -> Column:
    """The four numbers of a box written in a string, else null."""
    numbers = F.regexp_extract_all(c, F.lit(r"(-?\d+(?:\.\d+)?)"), 1).cast("array<double>")
    return F.when(F.size(numbers) == 4, numbers)


def to_frame(box: Column, frame: Column, size: int = 1000) -> Column:
    """A box in a frame that is `size` wide and high."""
    width, height = frame[2] - frame[0], frame[3] - frame[1]
    return F.array((box[0] - frame[0]) / width * size, (box[1] - frame[1]) / height * size, (box[2] - frame[0]) / width * size, (box[3] - frame[1]) / height * size)


def containing(box: Column, chunks: Column) -> Column:
    """The index from 1 of the first chunk box that holds a box, borders included; null if none does."""
    hit = F.transform(chunks, lambda c: (c[0] <= box[0]) & (c[1] <= box[1]) & (c[2] >= box[2]) & (c[3] >= box[3]))
    at = F.array_position(hit, True)
    return F.when(at > 0, at)

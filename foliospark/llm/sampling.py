"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import by_name, materialize, scratch

#: Rows of a label at most, and the longest text that may be in a sample (whole texts only).
ROWS_PER_LABEL = 4000
LONGEST = 20_000


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo folds."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, key: str = "doc_id", text: str = "text", rows_per_label: int = ROWS_PER_LABEL, longest: int = LONGEST, seed: int = 11) -> tuple[list[bytes], list[int], dict[int, int]]:
    """Texts and labels (0, 1), and how many rows each label has in all of `train`.

    train: a condition on the column `id`. The rows with the smallest hash of seed and key are taken, rows_per_label of
    each label at most, so what reaches the driver is bounded by 2 * rows_per_label * longest characters. A key labelled
    twice counts once, with its smallest label; labels other than 0 and 1 are left out.
    """
    own = labels.select(by_name(labels, key).alias("id"), by_name(labels, label).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    with scratch():
        own = materialize(own.groupBy("id").agg(F.min("y").alias("y")).where(train), "labels")
        counts = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
        order = F.xxhash64(F.lit(seed), F.col("id").cast("string"))
        # half as many again, for texts that are null or too long
        ids = [own.where(F.col("y") == y).orderBy(order, "id").limit(rows_per_label * 3 // 2) for y in (0, 1)]
        chosen = F.broadcast(ids[0].unionByName(ids[1]))  # at most 3 * rows_per_label rows of id and label
        texts = docs.select(by_name(docs, key).alias("id"), by_name(docs, text).alias("text")).where(F.length("text") <= longest)
        # the documents are read once; both labels are then taken from a table of the chosen ones
        rows = materialize(texts.join(chosen, "id").groupBy("id", "y").agg(F.min("text").alias("text")), "sample")
        got = [rows.where(F.col("y") == y).orderBy(order, "id").limit(rows_per_label) for y in (0, 1)]
        taken = got[0].unionByName(got[1]).toArrow()
    texts_out, ys = taken.column("text").to_pylist(), taken.column("y").to_pylist()
    return [t.encode() for t in texts_out], ys, {0: counts.get(0, 0), 1: counts.get(1, 0)}

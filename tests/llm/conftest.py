import pytest
from pyspark.sql import functions as F

#: Every awkward text that the operators must take: null, empty, blank, very long, tied, repeated, beyond ASCII.
AWKWARD = [None, "", "   \n\t ", "a", "same text here twice over", "same text here twice over", "Élan vital, œuvre — 第一   été!", "%%% &&& ###", "x " * 30000, "word" * 20000]


@pytest.fixture(scope="session")
def awkward(spark):
    """doc_id with a repeat and a null, awkward texts, and columns whose names clash with what operators add."""
    rows = [(i, t, None if i % 3 == 0 else "src1", f"s{i}") for i, t in enumerate(AWKWARD)]
    rows += [(4, AWKWARD[4], "src1", "s4"), (None, "no id at all", "src2", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard string")
    for c in ("score", "leak", "component", "print", "id", "key", "copy.x", "Secrets", "row", "words", "copy", "Order_Key", "a.b", "__kept_id", "__kept_tie", "slot", "tie"):
        df = df.withColumn(c, F.lit("kept"))
    df = df.withColumn("tags", F.create_map(F.lit("k"), F.lit("kept")))
    return df.withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)

import random

import pyarrow as pa
import pytest

from foliospark.llm.chat import ADDED, OP8_SQL, _format_rows, assemble, format_conversations, op8_chat, parse, unescape
from tests.llm.compare import same

PARTS = ["", "a", "é", "第", "\\", "[", "<", "[/INST]", " [/INST]", "</s>", "<s> ", "<<SYS>>", "\\[INST] ", "[ROLE x[:] y [/ROLE]", "\n", " "]


def test_round_trip():
    rng = random.Random(8)
    for _ in range(1500):
        turns = [(rng.choice(["user", "assistant", "system", "", "tool", "a] b[:] c", "\\"]), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 6)))) for _ in range(rng.randint(1, 6))]
        roles, texts = [r.encode() for r, _ in turns], [t.encode() for _, t in turns]
        out, offsets, starts, stops = assemble(roles, texts)
        assert parse(out.tobytes()) == list(zip(roles, texts, strict=True))
        assert [unescape(out[a:z].tobytes()).decode() for a, z in zip(starts, stops, strict=True)] == [t for r, t in turns if r == "assistant"]
        assert offsets[-1] == len(out)


def test_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (None, 0, None, "x"), (2, None, "user", "first"), (2, 0, "assistant", ADDED), (3, 0, "assistant", "z" * 200000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in format_conversations(df).collect()}
    assert [got[c]["n_turns"] for c in (1, 2, 3, None)] == [3, 2, 1, 1]
    assert parse(got[2]["formatted"].encode()) == [(b"user", b"first"), (b"assistant", ADDED.encode())]
    assert len(got[1]["loss"]) == 2 and got[None]["loss"] == []
    assert format_conversations(df.limit(0)).count() == 0


def test_conversation_over_many_batches(spark):
    spark_rows = spark.range(7000).selectExpr("id % 2 as conv_id", "id as turn", "'user' as role", "cast(id as string) as text")
    got = {r["conv_id"]: r for r in format_conversations(spark_rows).collect()}
    assert [t.decode() for _, t in parse(got[1]["formatted"].encode())] == [str(i) for i in range(1, 7000, 2)]


def test_output_is_cut_by_size():
    """Batches hold whole conversations, within the limit; one that is too long by itself is named."""
    rows = pa.table({"conv_id": [1, 1, 2, 3, 3, None], "role": ["user"] * 6, "text": ["[" * 40, "b", "c" * 60, "d", "é" * 30, "f"]})
    whole = pa.Table.from_batches(list(_format_rows(rows)))
    assert whole.num_rows == 4
    for most in (200, 300, 900):
        parts = list(_format_rows(rows, most))
        assert pa.Table.from_batches(parts).to_pylist() == whole.to_pylist() and all(sum(len(t.encode()) for t in p.column(2).to_pylist()) <= most for p in parts)
    with pytest.raises(ValueError, match="conversation 1 "):
        list(_format_rows(rows, 90))


def test_query(spark, sf_dir):
    assert same(op8_chat(spark, sf_dir), OP8_SQL, sf_dir)

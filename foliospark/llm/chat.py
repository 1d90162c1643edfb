"""Chat formatting by columnar byte assembly.

Every turn becomes header, escaped text and trailer. All turns of a batch are assembled at once: numpy finds the bytes
to escape, turns segment lengths into cumulative offsets and scatter indices, and copies headers and contents into one
preallocated buffer, which becomes the Arrow column without further copies.

Template: user `[INST] text [/INST]`, assistant `<s> text </s>`, system `<<SYS>> text <</SYS>>`, any other role
`[ROLE role[:] text [/ROLE]`. A backslash goes before each backslash, `[` and `<` of a text or role, so no control string
can stand in a text, and unescaping is exact.

Defined results. Null text or role: empty. A null conv_id is a conversation of its own; turns go by turn (nulls first),
then role, then text, so ties and repeated rows have one order, and repeated rows are turns each. Empty texts keep their
marks. Empty tables give only the conversation that the query adds. Other columns are not read. A conversation's output
is one string, so it takes the memory of that conversation at least; one of 2 GB or more can be no Spark string, and
fails with an error that names it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import as_bytes, bounded_batches, by_name, table

ESCAPE = 0x5C
SPECIAL = np.zeros(256, dtype=bool)
SPECIAL[[ESCAPE, 0x5B, 0x3C]] = True
MARKS = {b"user": (b"[INST] ", b" [/INST]"), b"assistant": (b"<s> ", b" </s>"), b"system": (b"<<SYS>> ", b" <</SYS>>")}
OTHER = (b"[ROLE ", b"[:] ", b" [/ROLE]")


def escape(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The escaped bytes, and of each byte its place among them."""
    marked = SPECIAL[data]
    place = np.arange(len(data)) + np.cumsum(marked)
    out = np.full(len(data) + int(marked.sum()), ESCAPE, dtype=np.uint8)
    out[place] = data
    return out, place


def _pack(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer and its offsets."""
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[k], ..., starts[k] + lengths[k] - 1 of each k, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def assemble(roles: list[bytes], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer and offsets of the formatted turns, and where in the buffer each loss span starts and stops."""
    heads, tails = [], []
    for r in roles:
        head, tail = MARKS.get(r) or (OTHER[0] + escape(np.frombuffer(r, dtype=np.uint8))[0].tobytes() + OTHER[1], OTHER[2])
        heads.append(head)
        tails.append(tail)
    raw, at = _pack(texts)
    body, place = escape(raw)
    body_at = np.concatenate((place, [len(body)])) if len(raw) else np.zeros(1, dtype=np.int64)
    # place is that of the byte itself; its escape, if any, stands right before it
    if len(raw):
        body_at[:-1] -= SPECIAL[raw]
    bounds = body_at[at]
    head, head_at = _pack(heads)
    tail, tail_at = _pack(tails)
    n_head, n_body, n_tail = np.diff(head_at), np.diff(bounds), np.diff(tail_at)
    offsets = np.concatenate(([0], np.cumsum(n_head + n_body + n_tail)))
    out = np.empty(int(offsets[-1]), dtype=np.uint8)
    out[_spread(offsets[:-1], n_head)] = head
    out[_spread(offsets[:-1] + n_head, n_body)] = body
    out[_spread(offsets[:-1] + n_head + n_body, n_tail)] = tail
    own = np.array([r == b"assistant" for r in roles], dtype=bool)
    starts = offsets[:-1] + n_head
    return out, offsets, starts[own], (starts + n_body)[own]


def unescape(data: bytes) -> bytes:
    out, at = [], 0
    while (i := data.find(b"\\", at)) >= 0:
        out += [data[at:i], data[i + 1 : i + 2]]
        at = i + 2
    return b"".join([*out, data[at:]])


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """The turns (role, text) of a formatted conversation, from its marks alone."""
    turns, at = [], 0
    heads = [(head, role, tail) for role, (head, tail) in MARKS.items()]
    while at < len(formatted):
        for head, role, tail in heads:
            if formatted.startswith(head, at):
                at += len(head)
                break
        else:
            if not formatted.startswith(OTHER[0], at):
                raise ValueError(f"no turn starts at byte {at}")
            at += len(OTHER[0])
            stop = _find(formatted, OTHER[1], at)
            role, tail, at = unescape(formatted[at:stop]), OTHER[2], stop + len(OTHER[1])
        stop = _find(formatted, tail, at)
        turns.append((role, unescape(formatted[at:stop])))
        at = stop + len(tail)
    return turns


def _find(data: bytes, mark: bytes, at: int) -> int:
    """Where a mark stands that is not escaped: all hold `[` or `<`, which texts and roles never do bare."""
    while (i := data.find(mark, at)) >= 0:
        sign = next(k for k, b in enumerate(mark) if b != 0x20)
        j = i + sign
        n = 0
        while j - n - 1 >= 0 and data[j - n - 1] == ESCAPE:
            n += 1
        if n % 2 == 0:
            return i
        at = i + 1
    raise ValueError(f"no {mark!r} after byte {at}")


FORMATTED = "conv_id bigint, n_turns bigint, formatted string, loss array<struct<start:bigint,stop:bigint>>"


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, n_turns, formatted, loss: byte spans of the assistant texts in formatted, escapes included.

    One shuffle of the turns by conversation; a task streams through its sorted conversations batch by batch and holds
    one batch and one conversation.
    """
    bounded_batches(turns.sparkSession)
    own = turns.select(by_name(turns, conv).cast("long").alias("conv_id"), by_name(turns, turn).alias("turn"), F.coalesce(by_name(turns, role), F.lit("")).alias("role"), F.coalesce(by_name(turns, text), F.lit("")).alias("text"))
    dealt = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(_format_batches, FORMATTED)


def _format_batches(batches):
    """Held are slices of the last conversation seen, which may go on; only the ids of a new batch are looked at."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        ids = batch.column(0).to_pylist()
        if not ids:
            continue
        cut = len(ids)
        while cut and ids[cut - 1] == ids[-1]:
            cut -= 1
        if cut or (held and last != ids[-1]):
            yield from _format_rows(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        held.append(batch.slice(cut))
        last = ids[-1]
    if held:
        yield from _format_rows(pa.Table.from_batches(held))


#: Bytes of a string column, or of one string, that offsets of 32 bits reach.
MOST_BYTES = (1 << 31) - 1


def _format_rows(rows: pa.Table, most: int = MOST_BYTES):
    """Batches of whole conversations, each of at most `most` bytes."""
    ids = rows.column("conv_id").to_pylist()
    first = [i for i, x in enumerate(ids) if not i or x != ids[i - 1]]
    # escapes double a text at most, and a mark is short
    if len(first) > 1 and 2 * rows.nbytes + 64 * len(ids) > most:
        middle = first[len(first) // 2]
        yield from _format_rows(rows.slice(0, middle), most)
        yield from _format_rows(rows.slice(middle), most)
        return
    roles, texts = (as_bytes(pa.concat_arrays([c.cast(pa.large_binary()) for c in rows.column(n).chunks])) for n in ("role", "text"))
    out, offsets, loss_start, loss_stop = assemble(roles, texts)
    if len(out) > most:
        raise ValueError(f"conversation {ids[0]} takes {len(out)} bytes, more than a string holds")
    bounds = np.append(np.array(first, dtype=np.int64), len(ids))
    starts = offsets[bounds]
    formatted = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(starts.astype(np.int32).tobytes()), pa.py_buffer(out)])
    of = np.searchsorted(starts, loss_start, side="right") - 1
    loss: list[list[dict]] = [[] for _ in first]
    for k, a, z in zip(of.tolist(), loss_start.tolist(), loss_stop.tolist(), strict=True):
        base = int(starts[k])
        loss[k].append({"start": a - base, "stop": z - base})
    yield pa.RecordBatch.from_arrays(
        [pa.array([ids[i] for i in first], pa.int64()), pa.array(np.diff(bounds)), formatted, pa.array(loss, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
        names=["conv_id", "n_turns", "formatted", "loss"])


READ_BACK = "struct<n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string,formatted_chars:bigint>"


def read_back():
    """A UDF that parses formatted conversations and digests what it finds."""
    kind = pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(formatted: pa.Array, loss: pa.Array) -> pa.Array:
        out = []
        for data, spans in zip(as_bytes(formatted), loss.to_pylist(), strict=True):
            turns = parse(data)
            under = b"".join(unescape(data[s["start"] : s["stop"]]) for s in spans)
            out.append({"n_turns": len(turns), "turns_sha256": hashlib.sha256(b"".join(r + b"\n" + t + b"\n" for r, t in turns)).hexdigest(), "loss_chars": len(under.decode()), "loss_sha256": hashlib.sha256(under).hexdigest(), "formatted_chars": len(data.decode())})
        return pa.array(out, type=kind)

    return F.arrow_udf(read, READ_BACK)


ADDED = "</s>[INST] ok [/INST]"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED).alias("text"))
    formatted = format_conversations(rows.unionByName(added))
    return formatted.select("conv_id", read_back()("formatted", "loss").alias("r")).select("conv_id", "r.*")


OP8_SQL = rf"""
WITH rows_ AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{ADDED}' UNION ALL SELECT -1, 1, 'assistant', '{ADDED}'),
n AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\\[<]', '', 'g')) AS escaped, length(role) + length(regexp_replace(role, '[^\\\[<]', '', 'g')) AS named FROM rows_)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(escaped + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17 ELSE 19 + named END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""

"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items are built into suffix automata over word ids, at most `block_words` words each: tasks
build them, and each is broadcast by itself. A worker keeps as many as fit RESIDENT bytes; of a larger benchmark it
loads the others once for each Arrow batch of texts. Training tokens are numbered once per batch and streamed through
each automaton; the longest matching length at each position gives the hit words, and spans over the length or coverage
limits are removed.

Defined results. Null or wordless text: no words, no hits, not contaminated. Items without words: never match. Items of
fewer words than the window: one window, the whole item. Repeated item_ids count once; a null item_id is the empty
string. Repeated rows and rows with equal texts are judged alike, one result row each. Empty benchmark: no hits.
Very long texts are streamed in whole; other columns are never touched, whatever their names, and the added one gets a
number if its name is taken (leak_1). Items shorter than the length limit count as hits, and towards coverage, but are
no passage to cut: a few words by themselves are an ordinary phrase.
"""

from __future__ import annotations

import itertools
import pickle
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import _WORD_BYTES, as_bytes, bounded_batches, by_name, chunks, free_name, fresh, table, words_of

WINDOW = 13
#: Words of the benchmark in one automaton: bounds what is broadcast and held at a time.
BLOCK_WORDS = 100_000
#: Bytes of packed automata that a worker keeps between batches; those beyond are loaded anew for each batch.
RESIDENT = 128 << 20
#: Blocks up to which it is cheaper to look each word up in each of them.
FEW = 2
RESULT = "struct<n_words:bigint,n_hit:bigint,longest:int,spans:array<struct<start:int,stop:int>>,items:array<string>>"
_FILTER_BITS = 22


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word ids.

    States are numbers; `step` maps state * radix + word to a state, `link` is the suffix link, `length` the length of
    a state's longest string.
    """

    def __init__(self, sequences: list[list[int]], radix: int):
        self.radix, self.step, self.link, self.length = radix, {}, [-1], [0]
        self._out: list[list[int]] = [[]]
        for words in sequences:
            last = 0
            for w in words:
                last = self._extend(last, w)
        del self._out

    def _new(self, length: int, link: int, like: int = -1) -> int:
        state = len(self.length)
        self.length.append(length)
        self.link.append(link)
        self._out.append(list(self._out[like]) if like >= 0 else [])
        if like >= 0:
            for w in self._out[like]:
                self.step[state * self.radix + w] = self.step[like * self.radix + w]
        return state

    def _split(self, before: int, w: int, there: int) -> int:
        """A copy of `there` that holds its strings of up to length[before] + 1 words."""
        copy = self._new(self.length[before] + 1, self.link[there], there)
        self.link[there] = copy
        while before >= 0 and self.step.get(before * self.radix + w) == there:
            self.step[before * self.radix + w] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, w: int) -> int:
        there = self.step.get(last * self.radix + w)
        if there is not None:
            return there if self.length[there] == self.length[last] + 1 else self._split(last, w, there)
        state, at = self._new(self.length[last] + 1, 0), last
        while at >= 0 and at * self.radix + w not in self.step:
            self.step[at * self.radix + w] = state
            self._out[at].append(w)
            at = self.link[at]
        if at >= 0:
            there = self.step[at * self.radix + w]
            self.link[state] = there if self.length[there] == self.length[at] + 1 else self._split(at, w, there)
        return state


class Block:
    """An automaton of some items, with what it takes to name them."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items]
        automaton = SuffixAutomaton([ids for _, ids in coded], max(1, len(self.vocabulary)))
        self.radix, self.step, self.link, self.length = automaton.radix, automaton.step, automaton.link, automaton.length
        self.shortest = min([window, *(len(ids) for _, ids in coded)])
        #: Of each state, the state on its way to the root whose strings include the one of `window` words; else 0.
        self.at_window = [0] * len(self.length)
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            if self.length[state] >= window:
                up = self.link[state]
                self.at_window[state] = self.at_window[up] if self.length[up] >= window else state
        names: dict[int, set[str]] = {}
        short: dict[int, dict[int, set[str]]] = {}
        for name, ids in coded:
            state = length = 0
            for w in ids:
                state, length = self.step[state * self.radix + w], length + 1
                if length >= window:
                    names.setdefault(self.at_window[state], set()).add(name)
            if length < window:
                short.setdefault(state, {}).setdefault(length, set()).add(name)
        self.names = {k: tuple(sorted(v)) for k, v in names.items()}
        #: Of each state, the short items that end its strings: (length, names).
        self.short: dict[int, list[tuple[int, tuple[str, ...]]]] = {}
        if short:
            for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                own = [(k, tuple(sorted(v))) for k, v in short.get(state, {}).items()] + self.short.get(self.link[state], [])
                if own:
                    self.short[state] = own
        #: Exact prefilter: which pairs of neighbouring words occur in an item, by a hashed bitmap.
        self.pairs = np.zeros(1 << _FILTER_BITS, dtype=bool)
        for _, ids in coded:
            a = np.asarray(ids, dtype=np.int64)
            self.pairs[self._slot(a[:-1], a[1:])] = True

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a * 0x9E3779B1 + b * 0x85EBCA6B) >> 7) & ((1 << _FILTER_BITS) - 1)

    def runs(self, ids: np.ndarray):
        """Stretches of words that may hold a window: neighbours all occur as pairs, and there are enough of them."""
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return
        # known words whose next word is known too, and stands behind it in an item
        first = known[:-1][np.diff(known) == 1]
        first = first[self.pairs[self._slot(ids[first].astype(np.int64), ids[first + 1].astype(np.int64))]]
        if self.shortest == 1:
            alone = np.setdiff1d(known, np.concatenate((first, first + 1)), assume_unique=False)
            yield from ((int(i), int(i) + 1) for i in alone)
        if not len(first):
            return
        breaks = np.flatnonzero(np.diff(first) > 1)
        starts, stops = first[np.concatenate(([0], breaks + 1))], first[np.concatenate((breaks, [len(first) - 1]))] + 2
        enough = stops - starts >= self.shortest
        yield from zip(starts[enough].tolist(), stops[enough].tolist(), strict=True)

    def number(self, words: list[bytes], places: dict[bytes, int] | None, at: np.ndarray | None) -> np.ndarray:
        """The block's own numbers of a text's words, -1 for unknown ones; places: the distinct words, at: which of them stands where."""
        if places is None:
            return np.fromiter(map(self.vocabulary.get, words, itertools.repeat(-1)), dtype=np.int32, count=len(words))
        met = list(places.keys() & self.vocabulary.keys())
        own = np.full(len(places), -1, dtype=np.int32)
        own[list(map(places.__getitem__, met))] = list(map(self.vocabulary.__getitem__, met))
        return own[at]

    def scan(self, ids: np.ndarray, hit: np.ndarray, longest: np.ndarray, found):
        """Mark the hit words and the longest matching lengths; call found(position, names)."""
        step, link, length, radix, window = self.step, self.link, self.length, self.radix, self.window
        for start, stop in self.runs(ids):
            state = matched = 0
            for i, w in enumerate(ids[start:stop].tolist(), start):
                there = step.get(state * radix + w)
                while there is None and state:
                    state = link[state]
                    matched = length[state]
                    there = step.get(state * radix + w)
                if there is None:
                    continue
                state, matched = there, matched + 1
                longest[i] = max(longest[i], matched)
                if matched >= window:
                    hit[i - matched + 1 : i + 1] = True
                    found(i, self.names[self.at_window[state]])
                for m, names in self.short.get(state, ()):
                    if matched >= m:
                        hit[i - m + 1 : i + 1] = True
                        found(i, names)


def cut_blocks(items, block_words: int):
    """Lists of (item_id, words), of at most block_words words each (one item at least), from (item_id, text) rows."""
    held, n = [], 0
    for item_id, text in items:
        words = words_of((text or "").encode())
        if not words:
            continue
        if held and n + len(words) > block_words:
            yield held
            held, n = [], 0
        held.append(("" if item_id is None else str(item_id), words))
        n += len(words)
    if held:
        yield held


_BREAK = b"\x01"


def scan_texts(texts: list[bytes], blocks) -> list[dict]:
    """The result of each text against all blocks (which have a length). Of more than FEW, distinct words are numbered first."""
    words = (b" " + _BREAK + b" ").join([t.translate(_WORD_BYTES) for t in texts]).split() if texts else []
    breaks = [-1, *(i for i, w in enumerate(words) if w == _BREAK), len(words)] if len(texts) > 1 else [-1, len(words)]
    places = at = None
    if len(blocks) > FEW:
        places = {w: k for k, w in enumerate(dict.fromkeys(words))}
        at = np.fromiter(map(places.__getitem__, words), dtype=np.int32, count=len(words))
    hit, longest = np.zeros(len(words), dtype=bool), np.zeros(len(words), dtype=np.int32)
    names: dict[int, set[str]] = {}
    starts = np.asarray(breaks[:-1]) + 1

    def found(i: int, got) -> None:
        names.setdefault(int(np.searchsorted(starts, i, side="right")) - 1, set()).update(got)

    for block in blocks:
        block.scan(block.number(words, places, at), hit, longest, found)
    out, total = [], np.concatenate(([0], np.cumsum(hit)))
    for k in range(len(texts)):
        a, z = breaks[k] + 1, breaks[k + 1]
        n = int(total[z] - total[a])
        spans = []
        if n:
            edges = np.flatnonzero(np.diff(np.concatenate(([False], hit[a:z], [False])).astype(np.int8))).tolist()
            spans = [{"start": s, "stop": e} for s, e in zip(edges[::2], edges[1::2], strict=True)]
        out.append({"n_words": z - a, "n_hit": n, "longest": int(longest[a:z].max()) if n else 0, "spans": spans, "items": sorted(names.get(k, ()))})
    return out


#: What a worker keeps between tasks: the automata of one benchmark, by number.
_HELD: dict[str, dict[int, Block]] = {}


class Blocks:
    """The automata of a benchmark as a worker sees them: broadcast in packed form, and kept while they fit `resident` bytes."""

    def __init__(self, packed: list, sizes: list[int], resident: int):
        self.packed, self.name = packed, uuid.uuid4().hex
        self.kept = [total <= resident for total in itertools.accumulate(sizes)]

    def __len__(self):
        return len(self.packed)

    def parts(self, text: pa.Array):
        """The texts of a batch, some at a time if the automata are all at hand, else all at once."""
        for start, stop in chunks(text, 1 << 20 if all(self.kept) else 1 << 40):
            yield as_bytes(text.slice(start, stop - start))

    def __iter__(self):
        if self.name not in _HELD:
            _HELD.clear()
        held = _HELD.setdefault(self.name, {})
        for k, packed in enumerate(self.packed):
            block = held.get(k)
            if block is None:
                block = pickle.loads(packed.value)
                del packed._value  # read again from its file when asked for
                if self.kept[k]:
                    held[k] = block
            yield block


def _build(window: int):
    def build(batches):
        for batch in batches:
            for k, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packed = pickle.dumps(Block(pickle.loads(items), window))
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([packed])], names=["k", "packed"])

    return build


def automata(spark: SparkSession, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, resident: int = RESIDENT) -> Blocks:
    """The automata of a benchmark, built by tasks. The driver sees its items, and one packed automaton, at a time."""
    bounded_batches(spark)
    rows = benchmark.select(by_name(benchmark, item_id).cast("string"), by_name(benchmark, item_text)).toLocalIterator()
    cut = [(k, bytearray(pickle.dumps(items))) for k, items in enumerate(cut_blocks(rows, block_words))]
    packed, sizes = [], []
    if cut:
        tasks = spark.createDataFrame(cut, "k long, items binary").repartition(len(cut), "k")
        for r in tasks.mapInArrow(_build(window), "k long, packed binary").toLocalIterator():
            packed.append(spark.sparkContext.broadcast(bytes(r["packed"])))
            sizes.append(len(r["packed"]))
    return Blocks(packed, sizes, resident)


def _scanner(blocks: Blocks):
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int32()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("items", pa.list_(pa.string()))])

    @F.arrow_udf(RESULT)
    def scan(text: pa.Array) -> pa.Array:
        return pa.array([r for own in blocks.parts(text) for r in scan_texts(own, blocks)], type=kind)

    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, into: str = "leak", resident: int = RESIDENT) -> DataFrame:
    """docs with a struct column `into` (or the first free of `into`_1, ...): n_words, n_hit, longest match, hit word spans, ids of items that occur."""
    blocks = automata(docs.sparkSession, benchmark, item_id, item_text, window, block_words, resident)
    return docs.withColumn(free_name(docs, into), _scanner(blocks)(by_name(docs, text)))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of these spans and what stands between them."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORD_BYTES))]
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at : places[start][0]])
        at = places[stop - 1][1]
    return b"".join([*out, text[at:]])


def _cleaner(blocks: Blocks, max_span: int, max_coverage: float):
    """A UDF of one pass: whether a text goes, and what it becomes if spans are cut (null if it stays as it is).

    It is declared not deterministic only so that Catalyst runs it once, not again for a filter on its result.
    """
    kind = pa.struct([("goes", pa.bool_()), ("text", pa.string())])

    def clean(text: pa.Array) -> pa.Array:
        out = []
        for t, r in ((t, r) for own in blocks.parts(text) for t, r in zip(own, scan_texts(own, blocks), strict=True)):
            goes = r["n_hit"] > 0 and r["n_hit"] >= max_coverage * r["n_words"]
            long = [] if goes else [(s["start"], s["stop"]) for s in r["spans"] if s["stop"] - s["start"] >= max_span]
            out.append({"goes": goes, "text": cut_spans(t, long).decode() if long else None})
        return pa.array(out, type=kind)

    return F.arrow_udf(clean, "struct<goes:boolean,text:string>").asNondeterministic()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_span: int = WINDOW, max_coverage: float = 0.05, n_chars: str | None = "n_chars") -> DataFrame:
    """docs without benchmark passages: texts covered up to max_coverage or more go, of others spans of max_span words or more are cut.

    Same columns as docs. Texts without hits stay byte for byte. Where a text is cut, the n_chars column (if there is
    one) follows it.
    """
    found = fresh(docs, base="leak")
    blocks = automata(docs.sparkSession, benchmark)
    kept = docs.withColumn(found, _cleaner(blocks, max_span, max_coverage)(by_name(docs, text))).where(~F.col(found)["goes"])
    cut = F.col(found)["text"]
    columns = []
    for c in docs.columns:
        own = by_name(kept, c)
        if c == text:
            own = F.coalesce(cut, own)
        elif n_chars and c == n_chars:
            own = F.coalesce(F.length(cut).cast(docs.schema[c].dataType), own)
        columns.append(own.alias(c))
    return kept.select(columns)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    leak = F.col("leak")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        leak["n_words"].alias("n_words"),
        leak["n_hit"].alias("n_hit"),
        F.size(leak["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", leak["items"]), 256).alias("items_sha256"),
        ((leak["n_hit"] > 0) & (20 * leak["n_hit"] >= leak["n_words"])).alias("contaminated"),
    )


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT r, i, m, item FROM dw JOIN win USING (m, g)),
marked AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT r, i, m FROM hits)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN items USING (r)
"""

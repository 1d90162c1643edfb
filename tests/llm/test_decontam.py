import random

from foliospark.llm.common import words_of
from foliospark.llm.decontam import Block, automata, cut_blocks, cut_spans, decontaminate, find_leaks, op1_decontaminate, OP1_SQL, scan_texts
from tests.llm.compare import same


def brute(text, items, window):
    words = words_of((text or "").encode())
    hit, names = [False] * len(words), set()
    for name, t in items:
        own = words_of((t or "").encode())
        m = min(window, len(own))
        wins = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in wins:
                names.add(name)
                hit[i : i + m] = [True] * m
    return len(words), sum(hit), sorted(names)


def test_automaton_against_brute_force():
    rng = random.Random(3)
    for trial in range(150):
        alphabet = [f"w{i}" for i in range(rng.choice([2, 3, 8]))]
        say = lambda n: " ".join(rng.choice(alphabet) for _ in range(n))
        items = [(str(i), say(rng.randint(0, 12))) for i in range(rng.randint(0, 6))]
        texts = [say(rng.randint(0, 60)) for _ in range(4)] + [None, "zzz yyy"]
        window = rng.randint(1, 6)
        for block_words in (10**6, 8):
            blocks = [Block(own, window) for own in cut_blocks(items, block_words)]
            got = scan_texts([(t or "").encode() for t in texts], blocks)
            for t, r in zip(texts, got, strict=True):
                assert (r["n_words"], r["n_hit"], r["items"]) == brute(t, items, window), (items, t, window)


def test_longest_match_is_that_of_the_whole_run():
    block = Block([("a", words_of(b"one two three four five"))], 2)
    assert scan_texts([b"x one two three four y two three"], [block])[0]["longest"] == 4


def test_awkward_rows(spark, awkward, empty):
    bench = spark.createDataFrame([(1, "same text here twice over and more"), (2, None), (3, "same text here"), (3, "text here twice"), (None, "no id at all")], "item_id long, text string")
    got = find_leaks(awkward, bench, window=3).select("doc_id", "leak_1.*", "score", "leak").collect()
    assert len(got) == awkward.count() and all(r["score"] == r["leak"] == "kept" for r in got)
    hits = [r for r in got if r["doc_id"] == 4]
    assert len(hits) == 2 and all(r["n_hit"] == 5 and r["items"] == ["1", "3"] for r in hits)
    assert next(r for r in got if r["doc_id"] is None)["items"] == [""]
    assert find_leaks(empty, bench).count() == 0
    assert all(r["leak_1"]["n_hit"] == 0 for r in find_leaks(awkward, bench.limit(0)).collect())


def test_many_blocks_in_little_memory(spark):
    """A block for each item, of which a worker keeps none, one or all."""
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    items = [(i, say(9)) for i in range(12)]
    docs = spark.createDataFrame([(i, say(80), "mine") for i in range(60)], "doc_id long, text string, Leak string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {r["doc_id"]: brute(r["text"], [(str(i), t) for i, t in items], 13) for r in docs.collect()}
    for resident in (0, 5000, 1 << 30):
        blocks = automata(spark, bench, block_words=9, resident=resident)
        assert len(blocks.packed) == 12 and sum(blocks.kept) == {0: 0, 5000: sum(blocks.kept), 1 << 30: 12}[resident]
        out = find_leaks(docs.repartition(9), bench, block_words=9, resident=resident)
        assert out.columns == ["doc_id", "text", "Leak", "leak_1"]
        assert {r["doc_id"]: (r["leak_1"]["n_words"], r["leak_1"]["n_hit"], r["leak_1"]["items"]) for r in out.collect()} == want


def test_short_items_are_counted_and_not_cut(spark):
    long = "clean words here " * 100
    docs = spark.createDataFrame([(1, long + "very short item"), (2, "very short item"), (3, None), (4, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "very short item")], "item_id long, text string")
    assert [r["leak"]["n_hit"] for r in find_leaks(docs, bench).orderBy("doc_id").collect()] == [3, 3, 0, 0]
    assert {r["doc_id"]: r["text"] for r in decontaminate(docs, bench).collect()} == {1: long + "very short item", 3: None, 4: ""}


def test_cut_keeps_the_rest():
    assert cut_spans("Ab, cd! éf gh.".encode(), [(1, 3)]).decode() == "Ab,  gh."


def test_decontaminate(spark, awkward):
    item = " ".join(f"k{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    long = "Clean words. " * 400
    docs = spark.createDataFrame([(1, item, 0), (2, long + item + "! " + long, 0), (3, long, 0)], "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: r for r in decontaminate(docs, bench).collect()}
    assert sorted(got) == [2, 3] and got[3]["text"] == long and got[3]["n_chars"] == 0
    assert got[2]["text"] == long + "! " + long and got[2]["n_chars"] == len(got[2]["text"])
    out = decontaminate(awkward, bench)
    assert out.columns == awkward.columns and out.count() == awkward.count()


def test_query(spark, sf_dir):
    assert same(op1_decontaminate(spark, sf_dir), OP1_SQL, sf_dir)

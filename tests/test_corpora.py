"""Corpora, logs and views on small literal inputs."""

from pyspark.sql import functions as F

from foliospark.operators import corpus, lines, sampling, views
from foliospark.streaming import sessions


def test_silver(spark):
    observed = spark.createDataFrame([("d", i, k, "B-ENTRY") for i, k in enumerate("abcde")], "document string, pos int, key string, machine string")
    curated = spark.createDataFrame([("d", "a", "B-ENTRY", False), ("d", "b", "I-ENTRY", True), ("d", "c", lines.UNDECIDED, False), ("d", "d", lines.DELETED, True)], "document string, key string, class string, corrected boolean")
    got = corpus.silver(observed, curated).orderBy("pos").collect()
    assert [r["gold"] for r in got] == ["B-ENTRY", "I-ENTRY", None, None, None] and [r["changed"] for r in got] == [False, True, False, False, False]
    assert corpus.silver_stats(corpus.silver(observed, curated)).first().asDict() == {"document": "d", "lines": 5, "missing": 1, "unlabelled": 3, "changed": 1}


def test_annotation_log(spark):
    log = [("set", 1, "A"), ("set", 2, "B"), ("undo", None, None), ("set", 2, "C"), ("set", 1, "D"), ("undo", None, None), ("undo", None, None), ("set", 3, "E")]
    df = spark.createDataFrame([("d", n, *x, f"t{n}", None) for n, x in enumerate(log)], "document string, n int, action string, pos int, label string, time string, page int")
    state = corpus.annotation_state(df)
    assert sorted((r["pos"], r["label"]) for r in state.collect()) == [(1, "A"), (3, "E")]
    problems = corpus.annotation_problems(state, spark.createDataFrame([("d", 1)], "document string, pos int"), ["E"])
    assert sorted((r["pos"], r["problem"]) for r in problems.collect()) == [(1, "unknown label"), (3, "no such line")]


def test_gold_tasks_and_samples(spark):
    kind = "array<struct<start:int,end:int,label:string,score:double>>"
    spans = [(0, 1, "SUBJ", 1.0), (2, 3, "ADDR", 1.0)]
    df = spark.createDataFrame([("d", "1", "A, rue 3", spans, None), ("d", "2", "B, rue 4", spans, spans), ("d", "3", "C", spans[:1], None)], f"document string, page string, text string, model {kind}, curated {kind}")
    got = {r["page"]: r["stratum"] for r in corpus.gold_tasks(df, rare=2).collect()}
    assert got == {"1": "courant", "2": "désaccord", "3": "signature rare"}
    assert corpus.one_per_text(df.unionByName(df).drop("model", "curated")).count() == 3
    tagged = spark.createDataFrame([("d", "u", spans, True)], f"document string, uid string, spans {kind}, corrected boolean")
    row = corpus.span_corpus(spark.createDataFrame([("d", "u", "3,4")], "document string, uid string, page string"), tagged).first()
    assert row["page"] == "3" and row["model"] is None and len(row["curated"]) == 2
    assert [sampling.similarity_band(F.lit(0.9)), sampling.band(F.lit(51))] and spark.range(1).select(sampling.similarity_band(F.lit(0.9)), sampling.band(F.lit(51))).first()[:] == ("0.90+", ">50")


def test_views(spark):
    rows = spark.createDataFrame([("v", 1, "a", "x", 0.9, "nw", "pair", 0, []), ("v", 2, "b", None, None, None, "left", None, None), ("v", 3, "c", "y", None, "manuel", "pair", 0, []), ("v", 4, None, "z", None, None, "right", None, None)], "volume string, rank int, left_uuid string, right_uuid string, score double, source string, kind string, level int, reasons array<string>")
    side = lambda ids: spark.createDataFrame([(u, "v", "1", f"S{u}", f"text {u}", f"<SUBJ>{u}</SUBJ>, <ADDR>r</ADDR> <ADDR>q</ADDR>") for u in ids], "uuid string, volume string, page string, section_title string, text string, tagged_text string")
    out = views.export_table(views.export_rows(rows, side("abc"), side("xyz"))).collect()
    assert [r["statut"] for r in out] == ["apparié", "gauche seulement", "apparié", "droite seulement"]
    assert [r["certitude"] for r in out] == ["automatique", "", "relue", ""] and [r["niveau_incertitude"] for r in out] == ["faible", "", "", ""]
    assert out[0]["score"] == "0.9000" and out[0]["gauche_adresse"] == "r | q" and out[1]["droite_sujet"] == ""
    shown = views.export_rows(rows, side("abc"), side("xyz")).withColumnsRenamed({"left_section_title": "left_section", "right_section_title": "right_section"})
    ranks = lambda **k: sorted(r["rank"] for r in views.filtered(shown, **k).collect())
    assert ranks(kinds=["pair"]) == [1, 3] and ranks(low=0.95) == [2, 3, 4] and ranks(section="Sy") == [3] and ranks(text="TEXT B") == [2] and ranks(manual_only=True) == [3] and ranks(least_level=1) == []
    paged = views.page(shown.drop("volume", "left_volume").withColumn("volume", F.lit("v")), 2, 2).orderBy("rank").collect()
    assert [(r["rank"], r["banner"]) for r in paged] == [(3, True), (4, False)]
    table = views.section_table(spark.createDataFrame([("left", "a", "S"), ("left", "b", "S")], "side string, uuid string, section string"), rows.where("kind = 'pair'"))
    assert table.first()["rate"] == 0.5


def test_error_reports(spark):
    df = spark.createDataFrame([("d", i, g, p, g != p) for i, (g, p) in enumerate([("A", "A"), ("A", "B"), ("B", "A"), ("A", "B")])], "document string, pos int, gold string, predicted string, error boolean")
    assert [(r["gold"], r["predicted"], r["n"]) for r in corpus.error_pairs(df).collect()] == [("A", "B", 2), ("B", "A", 1)]
    assert {r["gold"]: r["rate"] for r in corpus.error_rates(df, "gold", least=1).collect()} == {"A": 2 / 3, "B": 1.0}
    seen = corpus.in_context(df.withColumn("text", F.col("pos").cast("string")), F.col("gold") == "B").first()
    assert (seen["before"], seen["after"]) == ("1", "3")
    curve = corpus.learning_curve(spark.createDataFrame([(1, 0.5), (1, 0.7)], "budget int, f1 double")).first()
    assert abs(curve["mean"] - 0.6) < 1e-9 and abs(curve["deviation"] - 0.1) < 1e-9


def test_log_as_a_stream(spark, sf_dir, tmp_path):
    """The same plan on a stream gives the batch's sessions, but for the last ones that late rows may still reach."""
    source = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "user_id").where(F.col("user_id").isNotNull())
    source.coalesce(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = sessions.activity(spark.readStream.schema(source.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("activity_test").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    streamed = {tuple(r) for r in spark.table("activity_test").collect()}
    assert streamed <= {tuple(r) for r in sessions.activity(source).collect()} and streamed

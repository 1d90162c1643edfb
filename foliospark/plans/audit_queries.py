"""Queries on annotation, evaluation and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.functions import spans as SP
from foliospark.functions.text import heading_class
from foliospark.operators import annotation as AN
from foliospark.operators import entities as E
from foliospark.operators import evaluation as EV
from foliospark.operators import features as FE
from foliospark.operators import lines as LI
from foliospark.operators import links as L
from foliospark.operators import reports as RE
from foliospark.operators import sampling as SA
from foliospark.operators import sections as S
from foliospark.operators import stats as ST
from foliospark.plans.alignment_queries import edition, patch_of
from foliospark.plans.line_queries import CLASSED_SQL, LINES_SQL, NUMBERED_SQL, classed_lines, keyed_lines, read
from foliospark.plans.stat_queries import SCORED_SQL, rounded, scored
from foliospark.plans.text_queries import SPANNED_SQL, spanned

CLASSES = ["B-ENTRY", "I-ENTRY", "B-TITLE", "OUT OF SCOPE"]


def _hex(c: str, at: int):
    return F.conv(F.substring(c, at, 1), 16, 10).cast("int")


# Pages


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """document, pages: pages of ten lines with blocks of five; keys, words, boxes and some predictions."""
    lines = keyed_lines(spark, sf_dir)
    score = F.round(F.conv(F.substring("key", 3, 2), 16, 10).cast("int") / 255, 2)
    words = F.when(_hex("key", 4) > 3, F.array(F.array(F.lit("w"), score.cast("string")), F.array(F.lit("x"), F.lit("0.95"))))
    line = F.struct(
        F.concat(F.lit("u"), F.col("pos").cast("string")).alias("uid"), F.col("pos").cast("int").alias("line_index"), F.col("text").alias("markdown"), F.col("key").alias("cle"), words.alias("word_confidence"),
        F.when(_hex("key", 5) > 7, "B-ENTRY").alias("prediction"), F.when(_hex("key", 5) > 7, "model").alias("provenance"), F.when(_hex("key", 5) > 7, F.lit(0.5)).alias("probability"), F.lit(None).cast("string").alias("timestamp"))
    place = lines.select("document", F.floor(F.col("pos") / 10).cast("int").alias("page"), F.floor(F.col("pos") % 10 / 5).cast("int").alias("block"), "pos", line.alias("line"))
    blocks = place.groupBy("document", "page", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("x"))
    block = F.struct("block", F.col("block").alias("index"), F.array(F.lit(0.0), F.lit(1.5)).alias("bbox"), F.lit("Text").alias("label"), F.lit(1).alias("chunk_index"), F.transform("x", lambda v: v["line"]).alias("lines"))
    pages = blocks.groupBy("document", "page").agg(F.array_sort(F.collect_list(block)).alias("b"))
    page = F.struct(F.col("page").alias("page_index"), F.transform("b", lambda v: v.dropFields("block")).alias("data_blocks"))
    return pages.groupBy("document").agg(F.array_sort(F.collect_list(page)).alias("pages"))


def page_walk(spark, sf_dir):
    """Nested pages back as lines, with the place of each level."""
    return LI.walk(nested_pages(spark, sf_dir)).select("document", "page_index", "block_index", "line_pos", "pos", F.col("line.cle").alias("key"), F.col("line.markdown").alias("text"))


def line_table(spark, sf_dir):
    """The line table of all pages; the fingerprint of class and text."""
    return RE.line_table(LI.walk(nested_pages(spark, sf_dir))).select("document", *RE.LINE_COLUMNS)


def annotated_pages(spark, sf_dir):
    """Pages whose lines got labels by hand, walked again."""
    pages = nested_pages(spark, sf_dir)
    walked = LI.walk(pages).where(_hex("line.cle", 6) > 11)
    marks = walked.select("document", "pos", F.lit("I-ENTRY").alias("prediction"), F.lit("user").alias("provenance"), F.lit(1.0).alias("probability"), F.lit("now").alias("timestamp"))
    out = LI.walk(AN.annotated_pages(pages, marks))
    return out.select("document", F.col("line.cle").alias("key"), *[F.col(f"line.{c}").alias(c) for c in ("prediction", "provenance", "probability", "timestamp")])


# Annotation


def _raw_lines(spark, sf_dir):
    """Lines of which some are blank."""
    lines = keyed_lines(spark, sf_dir)
    return lines.withColumn("text", F.when(_hex("key", 2) == 0, "  ").when(_hex("key", 2) == 1, F.concat(F.lit(" "), "text", F.lit("\t"))).otherwise(F.col("text")))


def annotatable_lines(spark, sf_dir):
    return AN.annotatable(_raw_lines(spark, sf_dir)).select("document", "pos", "key", "text", "source_row", "follows_blank")


def source_hashes(spark, sf_dir):
    return AN.source_hash(AN.annotatable(_raw_lines(spark, sf_dir)))


def stale_sessions(spark, sf_dir):
    """Sessions of lines as they were: some have changed since, some documents are gone."""
    lines = AN.annotatable(_raw_lines(spark, sf_dir))
    bound = AN.source_hash(lines)
    now = lines.where(F.col("document").cast("long") % 5 != 0).withColumn("text", F.when(F.col("document").cast("long") % 3 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    return AN.stale_sessions(bound, now)


def _session(spark, sf_dir):
    lines = keyed_lines(spark, sf_dir)
    given = _hex("key", 3) < 6
    labels = lines.select("document", "pos", "key", F.when(given, F.when(_hex("key", 4) == 0, "TYPO").otherwise("B-ENTRY")).alias("label"), F.when(given | (_hex("key", 5) == 0), "now").alias("time"))
    once = labels.where((F.col("label").isNotNull() & (_hex("key", 6) > 0)) | (_hex("key", 7) == 0)).select("document", "pos", "key")
    history = once.union(once.where(_hex("key", 8) == 0)).select("document", "pos", F.lit(0).alias("n"))
    return labels, history


def session_problems(spark, sf_dir):
    labels, history = _session(spark, sf_dir)
    return AN.session_problems(labels, history, CLASSES)


def annotated_lines(spark, sf_dir):
    lines = AN.annotatable(_raw_lines(spark, sf_dir))
    state = lines.where(_hex("key", 3) < 4).select("document", "pos", F.lit("B-TITLE").alias("label"), F.lit("t").alias("time"))
    guesses = lines.where(_hex("key", 4) < 9).select("document", "pos", F.lit("I-ENTRY").alias("prediction"), (_hex("key", 5) / 15).alias("probability"))
    return AN.annotated(lines, state, guesses).select("document", "pos", "prediction", "provenance", "probability", "timestamp")


# Evaluation


def _labelled(spark, sf_dir):
    lines = keyed_lines(spark, sf_dir)
    before = F.lag("text").over(Window.partitionBy("document").orderBy("pos"))
    return lines.withColumn("label", heading_class(F.col("text"), before)).withColumn("page", F.floor(F.col("pos") / 4).cast("int"))


def cross_validation(spark, sf_dir):
    """Two experiments over folds of pages: how many lines each fold scores, and that no line is scored twice."""
    tried = [EV.Experiment("small", "reference", ("bias", "heading", "starts_lower")), EV.Experiment("smaller", "ablation", ("bias", "heading"))]
    found = EV.cross_validate(EV.page_splits(_labelled(spark, sf_dir)), tried, CLASSES)
    return EV.scored_lines(found, CLASSES).groupBy("experiment", "split").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("document", "pos").alias("apart"), F.count("predicted").alias("predicted"))


def cross_validated_accuracy(spark, sf_dir):
    """The accuracy of the same, by experiment."""
    tried = [EV.Experiment("small", "reference", ("bias", "heading", "starts_lower")), EV.Experiment("smaller", "ablation", ("bias", "heading"))]
    found = EV.cross_validate(EV.page_splits(_labelled(spark, sf_dir)), tried, CLASSES)
    return EV.accuracy(EV.scored_lines(found, CLASSES))


def scored_lines(spark, sf_dir):
    """Predictions, confidence and margin of marginals made of a key's digits."""
    rows = keyed_lines(spark, sf_dir).withColumn("marginals", F.array(*[_hex("key", i) / 60 for i in range(1, 5)]))
    return EV.scored_lines(rows, CLASSES).select("document", "pos", "predicted", F.round("confidence", 9).alias("confidence"), F.round("margin", 9).alias("margin"))


def _values(spark, sf_dir):
    """An accuracy for each page as an experiment: of families by the page's number."""
    per = scored(spark, sf_dir).groupBy("page").agg(F.avg(F.col("correct").cast("double")).alias("accuracy"))
    name = F.when(F.col("page") == 0, "production").otherwise(F.concat(F.lit("+"), F.col("page").cast("string")))
    return per.select(name.alias("experiment"), F.when(F.col("page") == 0, "reference").when(F.col("page") % 3 == 0, "placebo").otherwise("candidate").alias("family"), "accuracy")


def noise_floor(spark, sf_dir):
    return rounded(EV.noise_floor(_values(spark, sf_dir)))


def experiment_verdicts(spark, sf_dir):
    return rounded(EV.verdicts(_values(spark, sf_dir)))


def entity_counts_by_page(spark, sf_dir):
    """Entities as classed against those of a labeller that takes some continuations for beginnings."""
    lines = classed_lines(spark, sf_dir).withColumn("page", F.floor(F.col("pos") / 10).cast("int"))
    guess = lines.withColumn("class", F.when((F.col("class") == "I-ENTRY") & (_hex("key", 6) < 3), "B-ENTRY").otherwise(F.col("class")))

    def built(df):
        numbered = E.number_entities(df)
        return numbered.groupBy("document", F.col("track").alias("kind"), "entity_no").agg(F.min_by("page", "pos").alias("page"), F.collect_list(F.col("pos").cast("string")).alias("lines"))

    return EV.page_entity_counts(built(lines), built(guess))


def gold_counts(spark, sf_dir):
    rows = scored(spark, sf_dir).select((F.col("page") % 7).alias("stratum"), F.when(F.col("gold") == "0", "Non").when(F.col("gold") == "1", " incertain ").otherwise("oui").alias("answer"), "weight")
    return rounded(EV.counts_table(rows, "stratum", "answer", "weight", ["OUI", "NON", "INCERTAIN"], "OUI"))


def threshold_sweep(spark, sf_dir):
    return rounded(EV.threshold_sweep(scored(spark, sf_dir), [0.1, 0.3, 0.5, 0.7], gold=F.col("positive")))


def paired_deltas(spark, sf_dir):
    """What a second system, right where the first is and on every fifth row, changes."""
    s = scored(spark, sf_dir)
    other = s.withColumn("correct", F.col("correct") | (F.col("id") % 5 == 0))
    sums = {"good": F.col("weight") * F.col("correct").cast("double"), "all": F.col("weight")}
    return rounded(ST.paired_deltas(s, other, "page", sums, {"exactness": ST.ratio(F.col("good"), F.col("all"), None)}, 200))


def constant_groups(spark, sf_dir):
    """Feature groups that tell nothing of these lines."""
    lines = FE.with_features(keyed_lines(spark, sf_dir), ["bias", "page_marker_v1", "sequence_bounds", "placebo_constant"])
    group_of = {k: g for g in ("bias", "page_marker_v1", "sequence_bounds", "placebo_constant") for k in FE.keys_of(g)}
    return EV.constant_groups(FE.unpivot(lines.select("document", "pos", "features"), list(group_of)), group_of)


# Reports


def tagged_html(spark, sf_dir):
    rows = spanned(spark, sf_dir)
    tagged = F.when(_hex("key", 9) == 0, F.concat(F.lit("<SUBJ>"), "text")).otherwise(SP.rendered(F.col("text"), F.col("spans")))
    return rows.select("id", RE.tagged_html(tagged, {"SUBJ": "#eef"}).alias("html"))


def anchor_keys(spark, sf_dir):
    rows = spanned(spark, sf_dir)
    key = RE.anchor_key(F.concat(F.lit("## "), F.substring("text", 1, 20)), F.concat(F.lit(" "), SP.rendered(F.col("text"), F.col("spans"))))
    return rows.select("id", key["text"].alias("text"))


def patch_updated(spark, sf_dir):
    """A patch whose lines name records of an earlier run, with the records of now in their place."""
    left, right = (edition(spark, sf_dir, odd).select("uuid", F.lit(f"f{odd}").alias("document"), F.col("section").alias("section_title"), F.col("name").alias("tagged_text")) for odd in (0, 1))
    patch = patch_of(spark, sf_dir).select("line", *[F.when(F.col(f"{s}_uuid") == "", "").otherwise(F.concat(F.lit("old"), F.col(f"{s}_uuid"))).alias(f"{s}_uuid") for s in ("left", "right")], *[F.lit("?").alias(f"{s}_{c}") for s in ("left", "right") for c in ("file", "section", "tagged_text")])
    states = patch.select("line", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_uuid").alias("uuid")) for s in ("left", "right")])).alias("u")).select("line", "u.*").where("uuid <> ''")
    number = F.expr("substring(uuid, 4)")
    states = states.select("line", "side", F.when(number.cast("long") % 4 == 2, "orphan").otherwise("reanchored").alias("state"), number.alias("now_uuid"))
    return RE.updated_patch(patch, states, left, right)


def declared_unmatched(spark, sf_dir):
    return RE.declared_unmatched(patch_of(spark, sf_dir))


def classified_join(spark, sf_dir):
    """Parts with what is told of some of them."""
    rows = edition(spark, sf_dir, 0).select("uuid", "name")
    told = edition(spark, sf_dir, 0).where(F.col("order") % 3 == 0).select("uuid", (F.col("order") % 10).alias("digit"), "section")
    return RE.joined_back(rows, told, ["uuid"])


def _runs(spark, sf_dir):
    c = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    left, right = (c.where(F.col("c_custkey") % 2 == odd).select(F.col("c_custkey").alias("run"), F.col("c_mktsegment").alias("section"), F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("section_uuid"), (F.col("c_custkey") % 9).alias("entries")) for odd in (0, 1))
    pairs = left.where(F.col("run") % 6 != 0).select(F.col("run").alias("left_run"), (F.col("run") + 1).alias("right_run"), F.when(F.col("run") % 10 == 0, "manual").otherwise("auto").alias("source"), F.floor(F.col("run") / 40).alias("group"))
    return left, right, pairs


def section_summary(spark, sf_dir):
    left, right, pairs = _runs(spark, sf_dir)
    return RE.section_summary(pairs, left, right)


def unmatched_sections(spark, sf_dir):
    left, right, pairs = _runs(spark, sf_dir)
    both = left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))
    patch = left.where(F.col("run") % 12 == 0).select(F.col("section_uuid").alias("left_uuid"), F.lit("").alias("right_uuid"))
    return RE.unmatched_sections(both, pairs, patch)


def canonical_pairs(spark, sf_dir):
    """Training pairs with the names of hand-made groups: brands of one digit are a group."""
    digit = F.substring("section_uuid", 7, 1)
    groups = edition(spark, sf_dir, 0).select(digit.cast("int").alias("group_rank"), F.explode(F.array(F.lit("left"), F.lit("right"))).alias("side"), F.col("section_uuid").alias("section"), F.expr("substring(section_uuid, 7)").cast("int").alias("left_rank")).distinct()
    p = read(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    pairs = p.select("p_partkey", F.col("p_brand").alias("left_section"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_type")).alias("right_section"))
    return RE.canonical_pairs(pairs, S.canonical_keys(groups))


def unknown_links(spark, sf_dir):
    left, right = (edition(spark, sf_dir, odd).where(F.col("order") % 5 != 0) for odd in (0, 1))
    links = edition(spark, sf_dir, 0).select(F.col("uuid").alias("left_uuid"), (F.col("order") + 1).cast("string").alias("right_uuid"))
    return RE.unknown_links(links, left, right)


def inversion_draw(spark, sf_dir):
    """Inversions by displacement and similarity: how many to draw of each stratum, and what each stands for."""
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_discount").select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("id"), (F.col("l_partkey") % 70 + 1).alias("crossed"), (0.6 + F.col("l_discount") * 4).alias("sim"))
    return SA.inversion_draw(rows, "id", 10).groupBy("stratum").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("weight"), 6).alias("weight"))


def address_quantiles(spark, sf_dir):
    """Numbers of line items by discount, in bins, with quartiles."""
    rows = read(spark, sf_dir, "lineitem", "l_discount", "l_quantity", "l_extendedprice")
    return rounded(ST.described(rows.withColumn("bin", ST.cut(F.col("l_quantity"), [0, 10, 20, 50])), "bin", "l_extendedprice"))


def rebuilt_overlay(spark, sf_dir):
    """A chain of lines put in one after the other, longer than any that people would make."""
    from foliospark.operators import overlay as O

    lines = classed_lines(spark, sf_dir).where("pos = 0").select("document", "pos", "key", "class", "text")
    n = 40
    chain = lines.select("document", "key", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("i")).select("document", F.concat_ws("+", "key", F.col("i").cast("string")).alias("key"), F.when(F.col("i") == 1, F.col("key")).otherwise(F.concat_ws("+", "key", (F.col("i") - 1).cast("string"))).alias("after"), F.lit("I-ENTRY").alias("class"), F.col("i").cast("string").alias("text"))
    return O.apply(lines, chain, ["class", "text"]).select("document", "rank", "key", "text", "problem")


QUERIES = {f.__name__: f for f in (page_walk, line_table, annotated_pages, annotatable_lines, source_hashes, stale_sessions, session_problems, annotated_lines, cross_validation, cross_validated_accuracy, scored_lines, noise_floor, experiment_verdicts, entity_counts_by_page, gold_counts, threshold_sweep, paired_deltas, constant_groups, tagged_html, anchor_keys, patch_updated, declared_unmatched, classified_join, section_summary, unmatched_sections, canonical_pairs, unknown_links, inversion_draw, address_quantiles, rebuilt_overlay)}

_H = "CAST('0x' || substr({c}, {i}, 1) AS INTEGER)"


def h(i: int, c: str = "key") -> str:
    return _H.format(c=c, i=i)


_TEXT = "trim({0}, ' ' || chr(9) || chr(13))"
RAW_SQL = LINES_SQL + f""",
raw_lines AS (SELECT document, pos, key, CASE {h(2)} WHEN 0 THEN '  ' WHEN 1 THEN ' ' || text || chr(9) ELSE text END AS text FROM keyed),
marked AS (SELECT *, {_TEXT.format("text")} AS t, coalesce(lag({_TEXT.format("text")} = '') OVER (PARTITION BY document ORDER BY pos), false) AS follows_blank FROM raw_lines),
annotatable AS (SELECT document, pos, key, t AS text, follows_blank, CAST(row_number() OVER (PARTITION BY document ORDER BY pos) AS INTEGER) AS source_row FROM marked WHERE t <> ''),
hashes AS (SELECT document, sha256(string_agg(key || chr(9) || text, chr(10) ORDER BY source_row)) AS sha256 FROM annotatable GROUP BY document)"""
SESSION_SQL = LINES_SQL + f""",
labels AS (SELECT document, pos, key, CASE WHEN {h(3)} < 6 THEN CASE WHEN {h(4)} = 0 THEN 'TYPO' ELSE 'B-ENTRY' END END AS label, {h(3)} < 6 OR {h(5)} = 0 AS timed FROM keyed),
once AS (SELECT * FROM labels WHERE (label IS NOT NULL AND {h(6)} > 0) OR {h(7)} = 0)"""
_PAGES = "POS // 10"
_ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
VALUES_SQL = SCORED_SQL + """,
vals AS (SELECT CASE WHEN page = 0 THEN 'production' ELSE '+' || page END AS experiment, CASE WHEN page = 0 THEN 'reference' WHEN page % 3 = 0 THEN 'placebo' ELSE 'candidate' END AS family, avg(CAST(correct AS INTEGER)) AS accuracy FROM scored GROUP BY page),
base AS (SELECT accuracy AS base FROM vals WHERE experiment = 'production'),
floors AS (SELECT max(abs(accuracy - base)) AS floor FROM vals, base WHERE family = 'placebo')"""
RUNS_SQL = """l AS (SELECT c_custkey AS run, c_mktsegment AS section, c_custkey % 9 AS entries FROM customer WHERE c_custkey % 2 = 0),
r AS (SELECT c_custkey AS run, c_mktsegment AS section, c_custkey % 9 AS entries FROM customer WHERE c_custkey % 2 = 1),
p AS (SELECT run AS left_run, run + 1 AS right_run, CASE WHEN run % 10 = 0 THEN 'manual' ELSE 'auto' END AS source, run // 40 AS grp FROM l WHERE run % 6 <> 0)"""


def _entities(source: str, name: str) -> str:
    """CTEs that number the entities of a table of classed lines."""
    return f"""t_{name} AS (SELECT *, CASE WHEN class IN ('B-ENTRY', 'I-ENTRY', 'SUB-ENTRY') THEN 'ENTRY' WHEN class IN ('B-TITLE', 'I-TITLE') THEN 'TITLE' ELSE 'OUT OF SCOPE' END AS kind FROM {source} WHERE class <> 'SUPPRIMÉE'),
o_{name} AS (SELECT *, class LIKE 'B-%' OR kind = 'OUT OF SCOPE' OR row_number() OVER (PARTITION BY document, kind ORDER BY pos) = 1 AS opener FROM t_{name}),
n_{name} AS (SELECT *, sum(CAST(opener AS INTEGER)) OVER (PARTITION BY document, kind ORDER BY pos) AS no FROM o_{name}),
{name} AS (SELECT document, kind, CAST(min(pos) // 10 AS INTEGER) AS page, string_agg(pos, ',' ORDER BY CAST(pos AS VARCHAR)) AS lines FROM n_{name} GROUP BY document, kind, no)"""


SQL = {
    "page_walk": f"WITH {LINES_SQL} SELECT document, CAST(pos // 10 AS INTEGER) AS page_index, CAST(pos % 10 // 5 AS INTEGER) AS block_index, CAST(pos % 5 AS INTEGER) AS line_pos, ((pos // 10) << 42) + ((pos % 10 // 5) << 21) + pos % 5 AS pos, key, text FROM keyed",
    "line_table": f"""WITH {LINES_SQL},
s AS (SELECT *, CASE WHEN {h(4)} > 3 THEN least(round(CAST('0x' || substr(key, 3, 2) AS INTEGER) / 255, 2), 0.95) END AS lowest, {h(5)} > 7 AS guessed FROM keyed)
SELECT document, key AS cle, 'u' || pos AS uid, CAST(pos // 10 AS VARCHAR) AS page_index, '1' AS chunk_index, CAST(pos % 10 // 5 AS VARCHAR) AS data_block_index, CAST(pos AS VARCHAR) AS line_index, '[0.0, 1.5]' AS data_block_bbox, 'Text' AS data_block_label, text AS markdown,
  CASE WHEN lowest IS NULL THEN '' ELSE replace(printf('%.2f', lowest), '.', ',') END AS confiance, CASE WHEN lowest < 0.9 THEN 'oui' ELSE '' END AS douteuse, CASE WHEN guessed THEN 'B-ENTRY' ELSE '' END AS classe, '' AS corrige, CASE WHEN guessed THEN 'model' ELSE '' END AS provenance, CASE WHEN guessed THEN '0.5' ELSE '' END AS probability, '' AS timestamp,
  substr(sha1(CASE WHEN guessed THEN 'B-ENTRY' ELSE '' END || chr(31) || trim(regexp_replace(text, '\\s+', ' ', 'g'))), 1, 12) AS empreinte FROM s""",
    "annotated_pages": f"""WITH {LINES_SQL}
SELECT document, key, CASE WHEN {h(6)} > 11 THEN 'I-ENTRY' WHEN {h(5)} > 7 THEN 'B-ENTRY' END AS prediction, CASE WHEN {h(6)} > 11 THEN 'user' WHEN {h(5)} > 7 THEN 'model' END AS provenance, CASE WHEN {h(6)} > 11 THEN 1.0::DOUBLE WHEN {h(5)} > 7 THEN 0.5::DOUBLE END AS probability, CASE WHEN {h(6)} > 11 THEN 'now' END AS timestamp FROM keyed""",
    "annotatable_lines": f"WITH {RAW_SQL} SELECT document, CAST(pos AS INTEGER) AS pos, key, text, source_row, follows_blank FROM annotatable",
    "source_hashes": f"WITH {RAW_SQL} SELECT * FROM hashes",
    "stale_sessions": f"WITH {RAW_SQL} SELECT document, CASE WHEN CAST(document AS BIGINT) % 5 = 0 THEN 'no such lines' ELSE 'the lines have changed' END AS problem FROM hashes WHERE CAST(document AS BIGINT) % 5 = 0 OR CAST(document AS BIGINT) % 3 = 0",
    "session_problems": f"""WITH {SESSION_SQL}
SELECT document, 'unknown label' AS problem, CAST(pos AS INTEGER) AS pos FROM labels WHERE label = 'TYPO' UNION ALL SELECT document, 'time without a label', CAST(pos AS INTEGER) FROM labels WHERE label IS NULL AND timed
UNION ALL SELECT document, 'twice in the history', CAST(pos AS INTEGER) FROM once WHERE {h(8)} = 0 UNION ALL SELECT document, 'in the history without a label', CAST(pos AS INTEGER) FROM once WHERE label IS NULL
UNION ALL SELECT document, 'not in the history', CAST(pos AS INTEGER) FROM labels WHERE label IS NOT NULL AND NOT ({h(6)} > 0 OR {h(7)} = 0)""",
    "annotated_lines": f"""WITH {RAW_SQL}
SELECT document, CAST(pos AS INTEGER) AS pos, CASE WHEN {h(3)} < 4 THEN 'B-TITLE' WHEN {h(4)} < 9 THEN 'I-ENTRY' ELSE '' END AS prediction, CASE WHEN {h(3)} < 4 THEN 'user' WHEN {h(4)} < 9 THEN 'model' ELSE 'unclassified' END AS provenance,
  round(CASE WHEN {h(3)} < 4 THEN 1.0 WHEN {h(4)} < 9 THEN {h(5)} / 15 ELSE 0.0 END, 4) AS probability, CASE WHEN {h(3)} < 4 THEN 't' END AS timestamp FROM annotatable""",
    "cross_validation": f"""WITH {LINES_SQL},
pages AS (SELECT document, pos // 4 AS page, row_number() OVER (PARTITION BY document ORDER BY pos // 4) AS nth, count(*) OVER (PARTITION BY document) AS n FROM (SELECT DISTINCT document, pos // 4 * 4 AS pos FROM keyed)),
folds AS (SELECT *, least(5, n) AS k FROM pages),
dealt AS (SELECT document, page, CAST(len(list_filter(range(0, k), lambda i: round_even(i * n / k, 0) < nth)) AS INTEGER) AS split FROM folds)
SELECT experiment, split, count(*) AS lines, count(*) AS apart, count(*) AS predicted FROM keyed JOIN dealt ON dealt.document = keyed.document AND dealt.page = keyed.pos // 4, (VALUES ('small'), ('smaller')) e(experiment) GROUP BY experiment, split""",
    "scored_lines": f"""WITH {LINES_SQL},
m AS (SELECT document, pos, [{h(1)}, {h(2)}, {h(3)}, {h(4)}] AS v FROM keyed)
SELECT document, CAST(pos AS INTEGER) AS pos, ['B-ENTRY', 'I-ENTRY', 'B-TITLE', 'OUT OF SCOPE'][list_position(v, list_max(v))] AS predicted, round(list_max(v) / 60, 9) AS confidence, round(list_max(v) / 60 - list_reverse_sort(v)[2] / 60, 9) AS margin FROM m""",
    "noise_floor": f"WITH {VALUES_SQL} SELECT round(floor, 9) AS floor FROM floors",
    "experiment_verdicts": f"""WITH {VALUES_SQL}
SELECT experiment, family, round(accuracy - base, 9) AS delta, CASE WHEN accuracy < base AND base - accuracy > floor THEN 'dégrade' WHEN accuracy > base AND accuracy - base > floor THEN 'améliore' ELSE 'neutre' END AS verdict FROM vals, base, floors""",
    "entity_counts_by_page": f"""WITH {CLASSED_SQL},
guess AS (SELECT * REPLACE (CASE WHEN class = 'I-ENTRY' AND {h(6)} < 3 THEN 'B-ENTRY' ELSE class END AS class) FROM classed),
{_entities("classed", "g")},
{_entities("guess", "p")}
SELECT document, page, kind, CAST(count_if(g.lines IS NOT NULL AND p.lines IS NOT NULL) AS BIGINT) AS tp, count(p.lines) AS predicted, count(g.lines) AS gold FROM g FULL JOIN p USING (document, page, kind, lines) GROUP BY document, page, kind""".replace("g.lines", "gl").replace("p.lines", "pl").replace("FROM g FULL JOIN p USING", "FROM (SELECT *, lines AS gl FROM g) FULL JOIN (SELECT *, lines AS pl FROM p) USING"),
    "gold_counts": f"""WITH {SCORED_SQL}, a AS (SELECT page % 7 AS stratum, CASE gold WHEN '0' THEN 'NON' WHEN '1' THEN 'INCERTAIN' ELSE 'OUI' END AS answer, weight FROM scored)
SELECT stratum, CAST(count_if(answer = 'OUI') AS BIGINT) AS n_oui, CAST(count_if(answer = 'NON') AS BIGINT) AS n_non, CAST(count_if(answer = 'INCERTAIN') AS BIGINT) AS n_incertain, sum(CASE WHEN answer = 'OUI' THEN weight ELSE 0 END) AS weight_oui, sum(CASE WHEN answer = 'NON' THEN weight ELSE 0 END) AS weight_non, sum(CASE WHEN answer = 'INCERTAIN' THEN weight ELSE 0 END) AS weight_incertain,
  round(sum(CASE WHEN answer = 'OUI' THEN weight ELSE 0 END) / sum(weight), 9) AS share FROM a GROUP BY stratum""",
    "threshold_sweep": f"""WITH {SCORED_SQL}, t AS (SELECT threshold, count_if(score >= threshold) AS kept, count_if(score >= threshold AND positive) AS good, count_if(positive) AS every FROM scored, (SELECT unnest([0.1::DOUBLE, 0.3::DOUBLE, 0.5::DOUBLE, 0.7::DOUBLE]) AS threshold) GROUP BY threshold)
SELECT threshold, CAST(kept AS BIGINT) AS kept, CAST(good AS BIGINT) AS "right", round(CASE WHEN kept > 0 THEN good / kept ELSE 0 END, 9) AS precision, round(CASE WHEN every > 0 THEN good / every ELSE 0 END, 9) AS recall FROM t""",
    "paired_deltas": f"""WITH {SCORED_SQL},
per AS (SELECT page, sum(weight * CAST(correct AS INTEGER)) AS good, sum(weight * CAST(correct OR id % 5 = 0 AS INTEGER)) AS better, sum(weight) AS every FROM scored GROUP BY page),
drawn AS (SELECT sample, good, better, every, (CAST('0x' || substr(md5('0:' || sample || ':' || page), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM per, (SELECT unnest(range(1, 201)) AS sample)),
sums AS (SELECT sample, sum(better * n) / sum(every * n) - sum(good * n) / sum(every * n) AS v FROM (SELECT *, len(list_filter([{", ".join(f"{x!r}::DOUBLE" for x in ST.POISSON)}], lambda s: u >= s)) AS n FROM drawn) GROUP BY sample)
SELECT 'exactness' AS metric, round((SELECT sum(better) / sum(every) - sum(good) / sum(every) FROM per), 9) AS delta, round(quantile_cont(v, 0.025), 9) AS low, round(quantile_cont(v, 0.975), 9) AS high FROM sums""",
    "constant_groups": f"""WITH {LINES_SQL},
n AS (SELECT *, count(*) OVER (PARTITION BY document) AS n FROM keyed)
SELECT g AS "group" FROM (SELECT unnest(gs) AS g FROM (SELECT ['bias', 'placebo_constant', CASE WHEN count(DISTINCT regexp_matches(text, '^\\{{\\d+\\}}[-—_]*$')) = 1 THEN 'page_marker_v1' END, CASE WHEN max(n) = 1 THEN 'sequence_bounds' END] AS gs FROM n)) WHERE g IS NOT NULL""",
    "tagged_html": f"""WITH {SPANNED_SQL},
cut AS (SELECT id, key, text, spans, list_concat([0], list_transform(spans, lambda s: s."end")) AS ends FROM spanned),
parts AS (SELECT id, key, text, list_transform(range(1, len(spans) + 1), lambda i: {{'before': text[ends[i] + 1 : spans[i].start], 'own': text[spans[i].start + 1 : spans[i]."end"], 'label': spans[i].label}}) AS p, text[ends[-1] + 1 :] AS rest FROM cut)
SELECT id, CASE WHEN {h(9)} = 0 THEN '<span class="badge">balisage invalide</span>' || {_ESC.format("'<SUBJ>' || text")} ELSE array_to_string(list_transform(p, lambda x: {_ESC.format("x.before")} || '<mark class="span"' || CASE WHEN x.label = 'SUBJ' THEN ' style="background:#eef"' ELSE '' END || ' title="' || x.label || '">' || {_ESC.format("x.own")} || '<sub>' || x.label || '</sub></mark>'), '') || {_ESC.format("rest")} END AS html FROM parts""",
    "anchor_keys": f"WITH {SPANNED_SQL} SELECT id, trim(regexp_replace(replace(text, '*', ''), '\\s+', ' ', 'g')) AS text FROM spanned",
    "patch_updated": """WITH patch AS (
  SELECT CAST(k / 7 + 2 AS BIGINT) AS line, CASE WHEN k % 5 <> 1 THEN k - k % 2 END AS l, CASE WHEN k % 3 <> 1 THEN k - k % 2 + CASE WHEN k % 4 < 2 THEN 1 ELSE 3 END END AS r FROM (SELECT p_partkey AS k FROM part WHERE p_partkey % 7 = 0)),
m AS (SELECT line, l, r, a.p_name AS an, a.p_type AS aty, b.p_name AS bn, b.p_type AS bt, a.p_partkey IS NOT NULL AND l % 4 <> 2 AS lm, b.p_partkey IS NOT NULL AND r % 4 <> 2 AS rm FROM patch LEFT JOIN part a ON a.p_partkey = l LEFT JOIN part b ON b.p_partkey = r)
SELECT line, CASE WHEN l IS NULL THEN '' WHEN lm THEN CAST(l AS VARCHAR) ELSE 'old' || l END AS left_uuid, CASE WHEN r IS NULL THEN '' WHEN rm THEN CAST(r AS VARCHAR) ELSE 'old' || r END AS right_uuid,
  CASE WHEN lm THEN 'f0' ELSE '?' END AS left_file, CASE WHEN lm THEN aty ELSE '?' END AS left_section, CASE WHEN lm THEN an ELSE '?' END AS left_tagged_text, CASE WHEN rm THEN 'f1' ELSE '?' END AS right_file, CASE WHEN rm THEN bt ELSE '?' END AS right_section, CASE WHEN rm THEN bn ELSE '?' END AS right_tagged_text FROM m""",
    "declared_unmatched": """WITH patch AS (
  SELECT CASE WHEN k % 5 <> 1 THEN CAST(k - k % 2 AS VARCHAR) ELSE '' END AS l, CASE WHEN k % 3 <> 1 THEN CAST(k - k % 2 + CASE WHEN k % 4 < 2 THEN 1 ELSE 3 END AS VARCHAR) ELSE '' END AS r FROM (SELECT p_partkey AS k FROM part WHERE p_partkey % 7 = 0))
SELECT DISTINCT 'left' AS side, l AS uuid FROM patch WHERE l <> '' AND r = '' UNION SELECT 'right', r FROM patch WHERE l = '' AND r <> ''""",
    "classified_join": "SELECT CAST(p_partkey AS VARCHAR) AS uuid, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 10 AS VARCHAR) ELSE '' END AS digit, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE '' END AS section FROM part WHERE p_partkey % 2 = 0",
    "section_summary": f"""WITH {RUNS_SQL}, m AS (SELECT p.*, l.section AS ls, r.section AS rs FROM p JOIN l ON l.run = left_run JOIN r ON r.run = right_run)
SELECT CAST(count_if(source = 'auto') AS BIGINT) AS automatic, CAST(count_if(source = 'auto' AND ls <> rs) AS BIGINT) AS renamed, count(DISTINCT CASE WHEN source <> 'auto' THEN grp END) AS manual_groups, (SELECT count(*) FROM l WHERE run NOT IN (SELECT left_run FROM p)) AS left_alone, (SELECT count(*) FROM r WHERE run NOT IN (SELECT right_run FROM p)) AS right_alone FROM m""",
    "unmatched_sections": f"""WITH {RUNS_SQL}
SELECT 'left' AS side, run, section, entries, CASE WHEN run % 12 = 0 THEN 'déclarée au patch' ELSE 'non alignée' END AS origin FROM l WHERE run NOT IN (SELECT left_run FROM p) UNION ALL SELECT 'right', run, section, entries, 'non alignée' FROM r WHERE run NOT IN (SELECT right_run FROM p)""",
    "canonical_pairs": """WITH b AS (SELECT DISTINCT p_brand, substr(p_brand, 7, 1) AS g FROM part WHERE p_partkey % 2 = 0), c AS (SELECT p_brand, first_value(p_brand) OVER (PARTITION BY g ORDER BY CAST(substr(p_brand, 7) AS INTEGER)) AS name FROM b)
SELECT p_partkey, coalesce(l.name, part.p_brand) AS left_section, CASE WHEN p_partkey % 2 = 0 THEN coalesce(l.name, part.p_brand) ELSE p_type END AS right_section FROM part LEFT JOIN c l ON l.p_brand = part.p_brand""",
    "unknown_links": """SELECT CAST(p_partkey AS VARCHAR) AS left_uuid, CAST(p_partkey + 1 AS VARCHAR) AS right_uuid FROM part WHERE p_partkey % 2 = 0 AND (p_partkey % 5 = 0 OR (p_partkey + 1) % 5 = 0 OR p_partkey + 1 NOT IN (SELECT p_partkey FROM part))""",
    "inversion_draw": """WITH i AS (SELECT l_partkey % 70 + 1 AS crossed, 0.6 + l_discount * 4 AS sim FROM lineitem),
s AS (SELECT CASE WHEN crossed = 1 THEN '1' WHEN crossed = 2 THEN '2' WHEN crossed = 3 THEN '3' WHEN crossed <= 5 THEN '4-5' WHEN crossed <= 10 THEN '6-10' WHEN crossed <= 50 THEN '11-50' ELSE '>50' END || ' / ' || CASE WHEN sim < 0.75 THEN '0.60-0.75' WHEN sim < 0.85 THEN '0.75-0.85' WHEN sim < 0.9 THEN '0.85-0.90' ELSE '0.90+' END AS stratum FROM i)
SELECT stratum, least(count(*), 10) AS rows, round(CAST(count(*) AS DOUBLE), 6) AS weight FROM s GROUP BY stratum""",
    "address_quantiles": """WITH b AS (SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN '(0, 10]' WHEN l_quantity > 10 AND l_quantity <= 20 THEN '(10, 20]' WHEN l_quantity > 20 AND l_quantity <= 50 THEN '(20, 50]' END AS bin, l_extendedprice AS v FROM lineitem)
SELECT bin, count(v) AS count, round(avg(v), 6) AS mean, round(min(v), 9) AS min, round(quantile_cont(v, 0.25), 9) AS q25, round(quantile_cont(v, 0.5), 9) AS q50, round(quantile_cont(v, 0.75), 9) AS q75, round(max(v), 9) AS max FROM b GROUP BY bin""",
    "rebuilt_overlay": f"""WITH {CLASSED_SQL}, m AS (SELECT document, key, text FROM classed WHERE pos = 0)
SELECT document, 1 AS rank, key, text, CAST(NULL AS VARCHAR) AS problem FROM m UNION ALL SELECT document, CAST(i + 1 AS INTEGER), key || '+' || i, CAST(i AS VARCHAR), NULL FROM m, (SELECT unnest(range(1, 41)) AS i)""",
}

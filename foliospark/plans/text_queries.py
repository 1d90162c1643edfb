"""Queries on spans, shapes, features, pages and layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import spans as SP
from foliospark.functions.text import heading_class, strip, title_key, title_level
from foliospark.operators import crf as CR
from foliospark.operators import entities as E
from foliospark.operators import extraction as EX
from foliospark.operators import features as FE
from foliospark.operators import layers as LA
from foliospark.operators import lines as LI
from foliospark.operators import linking as LK
from foliospark.operators import tagging as TA
from foliospark.plans.alignment_queries import two_years
from foliospark.plans.line_queries import CLASSED_SQL, ENTITIES_SQL, LINES_SQL, classed_lines, entities_of, keyed_lines, read
from foliospark.streaming import sessions


def spanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, text, spans: each line cut in thirds, some of them spans with scores by the line's key."""
    lines = keyed_lines(spark, sf_dir)
    third = F.floor(F.length("text") / 3).cast("int")
    digit = lambda i: F.conv(F.substring("key", i, 1), 16, 10).cast("int")
    span = lambda k, label, on: F.when(on, F.struct((third * k).cast("int").alias("start"), F.when(F.lit(k) == 2, F.length("text")).otherwise(third * (k + 1)).cast("int").alias("end"), F.lit(label).alias("label"), (digit(4 + k) / 15).alias("score")))
    spans = F.filter(F.array(span(0, "SUBJ", digit(1) > 2), span(1, "DESC", digit(2) > 7), span(2, "ADDR", digit(3) > 3)), lambda s: s["end"] > s["start"])
    return lines.select(F.concat_ws("/", "document", "pos").alias("id"), "key", "text", spans.alias("spans"))


_S = "CASE WHEN CAST('0x' || substr(key, {d}, 1) AS INTEGER) > {n} THEN {{'start': length(text) // 3 * {k}, 'end': {end}, 'label': '{label}', 'score': CAST('0x' || substr(key, {s}, 1) AS INTEGER) / 15}} END"
SPANNED_SQL = LINES_SQL + ",\nspanned AS (SELECT document || '/' || pos AS id, key, text, list_filter([" + ", ".join(_S.format(d=k + 1, n=n, k=k, end="length(text)" if k == 2 else f"length(text) // 3 * {k + 1}", label=label, s=4 + k) for k, (label, n) in enumerate((("SUBJ", 2), ("DESC", 7), ("ADDR", 3)))) + "], lambda s: s IS NOT NULL AND s.\"end\" > s.start) AS spans FROM keyed)"


def suspicion(spark, sf_dir):
    rows = spanned(spark, sf_dir)
    return rows.select("id", SP.signature_of(F.col("spans")).alias("signature"), F.round(SP.confidence_of(F.col("spans")), 9).alias("confidence"), F.array_join(SP.reasons_of(F.col("text"), F.col("spans")), " | ").alias("reasons"), *[SP.count_label(F.col("spans"), x).alias(f"n_{x.lower()}") for x in SP.LABELS])


def tagged_round_trip(spark, sf_dir):
    """Lines whose spans are rendered as tags, and what is read back from these."""
    rows = spanned(spark, sf_dir).withColumn("tagged", SP.rendered(F.col("text"), F.col("spans")))
    back = rows.withColumn("p", SP.parsed(F.col("tagged"))).withColumn("texts", SP.label_texts(F.col("tagged")))
    told = F.array_join(F.transform("p.spans", lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return back.select("id", "tagged", F.col("p.text").alias("text"), told.alias("spans"), F.array_join(F.col("texts")["ADDR"], "|").alias("addresses"))


def span_pieces(spark, sf_dir):
    """Where the middle half of each line falls in its halves."""
    rows = keyed_lines(spark, sf_dir)
    n = F.length("text")
    pieces = F.array(F.struct(F.lit("a").alias("line"), F.lit(0).alias("start"), F.floor(n / 2).cast("int").alias("end"), F.lit(2).alias("lead")), F.struct(F.lit("b").alias("line"), (F.floor(n / 2) + 1).cast("int").alias("start"), (n + 1).alias("end"), F.lit(0).alias("lead")))
    cut = SP.span_pieces(F.floor(n / 4).cast("int"), (n - F.floor(n / 8)).cast("int"), pieces)
    return rows.select("document", "pos", F.explode(cut).alias("p")).select("document", "pos", F.col("p.line").alias("line"), F.col("p.start").alias("start"), F.col("p.end").alias("end"))


def title_keys(spark, sf_dir):
    lines = keyed_lines(spark, sf_dir)
    return lines.select("document", "pos", title_key(F.col("text")).alias("title_key"), title_level(F.concat(F.lit(" ## "), "text")).alias("level"))


def heading_guess(spark, sf_dir):
    from pyspark.sql import Window

    lines = keyed_lines(spark, sf_dir)
    before = F.lag("text").over(Window.partitionBy("document").orderBy("pos"))
    return lines.groupBy("document").agg(F.count(F.lit(1)).alias("lines")).join(lines.withColumn("guess", heading_class(F.col("text"), before)).groupBy("document").pivot("guess", ["B-TITLE", "I-ENTRY", "B-ENTRY", "OUT OF SCOPE"]).count().na.fill(0), "document")


def line_features(spark, sf_dir):
    lines = keyed_lines(spark, sf_dir)
    f = FE.with_features(lines, ["heading", "sequence_bounds", "token_count_v1", "prev_line_v1", "page_marker_v1", "placebo_constant"])
    keys = ["is_heading", "heading_level", "BOS", "EOS", "token_count", "prev_is_heading", "prev_ends_dash", "is_page_marker", "placebo_constant"]
    return f.select("document", "pos", *[F.try_element_at("features", F.lit(k)).alias(k.lower()) for k in keys])


def all_features(spark, sf_dir):
    names = FE.group_names("production") + FE.group_names("candidate") + FE.group_names("placebo")
    f = FE.with_features(keyed_lines(spark, sf_dir).withColumn("block", F.floor(F.col("pos") / 4).cast("string")), names)
    return FE.unpivot(f.select("document", "pos", "features"), ["italic", "uppercase", "alpha_order", "first_in_block", "char_length_log2", "shape_start_0"]).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


VALUES = ["is_heading", "starts_lower", "ends_punct", "token_count", "BOS", "EOS", "prev_end", "alpha_order", "first_in_block", "last_in_block", "last_char", "has_street_word", "has_number", "ends_with_number", "char_length_log2", "length_vs_prev", "first_word", "last_word", "next_is_heading", "uppercase"]


def feature_values(spark, sf_dir):
    """Features of each line, some of each kind."""
    lines = keyed_lines(spark, sf_dir).withColumn("block", F.floor(F.col("pos") / 4).cast("string"))
    groups = ["heading", "starts_lower", "ends_punct", "token_count", "sequence_bounds", "prev_line", "alpha_sequence", "block_position", "line_ending", "address_lexicon", "char_length", "lexical_words", "next_line", "uppercase"]
    f = FE.with_features(lines, groups)
    return f.select("document", "pos", *[F.try_element_at("features", F.lit(k)).alias(k.lower()) for k in VALUES])


def containing_chunk(spark, sf_dir):
    """The first of four overlapping columns of a page that holds a box."""
    k = F.col("page_id")
    box = F.array(*[x.cast("double") for x in (k % 700, k % 300, k % 700 + 120 + k % 90, k % 300 + 200)])
    chunks = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in ((0, 0, 300, 1000), (250, 0, 600, 1000), (100, 100, 900, 450), (550, 0, 1000, 1000))])
    pages = read(spark, sf_dir, "pages", "page_id")
    frame = LI.to_frame(box, F.array(*[F.lit(float(v)) for v in (0, 0, 500, 2000)]))
    return pages.select("page_id", LI.containing(box, chunks).cast("int").alias("chunk"), F.round(frame[0], 6).alias("left"), F.round(frame[3], 6).alias("bottom"))


def html_blocks(spark, sf_dir):
    """Block markup made of the paragraphs of raw pages, read back as lines."""
    pages = read(spark, sf_dir, "pages", "page_id", "html")
    parts = F.transform(F.regexp_extract_all("html", F.lit(r"(?s)<p[^>]*>(.*?)</p>"), 1), lambda p: F.concat(F.lit('<div data-bbox="0 0 10 10" data-label="Text"><span>'), F.regexp_replace(p, "(?i)</?(?:div|span)[^>]*>", ""), F.lit("</span></div>")))
    return EX.page_lines(pages.select(F.col("page_id").cast("string").alias("document"), F.lit(1).alias("page_index"), F.array_join(parts, "").alias("raw"))).select("document", "uid", "markdown", "error")


def entity_pieces(spark, sf_dir):
    """Entities built anew from their lines."""
    ents = entities_of(spark, sf_dir)
    keys = ents.select("document", "uuid", F.posexplode(F.split("key", ",")).alias("nth", "key"))
    met = keys.join(classed_lines(spark, sf_dir).select("document", "key", "class", "text"), ["document", "key"])
    built = LA.line_pieces(met.select("uuid", F.col("nth").alias("pos"), F.col("key").alias("line"), "class", "text"))
    last = F.element_at("pieces", -1)
    return ents.join(built, "uuid").select("uuid", F.size("pieces").alias("lines"), last["start"].alias("last_start"), last["end"].alias("last_end"), (F.regexp_replace(F.col("markdown"), r"(?U)^\s+|\s+$", "") == F.col("text")).alias("same"))


def braced_lines(spark, sf_dir):
    """Classed lines of pages of ten, with braces: an entry's first line shares `tous`, its sub-entries stand in the brace."""
    plain_ = F.translate("text", "{}", "")
    text = F.when(F.col("class") == "B-ENTRY", F.concat(plain_, F.lit(" } tous"))).when(F.col("class") == "SUB-ENTRY", F.concat(plain_, F.lit(" }"))).otherwise(plain_)
    return classed_lines(spark, sf_dir).withColumn("text", text).withColumn("page", F.floor(F.col("pos") / 10).cast("int")).withColumn("corrected", F.substring("key", 9, 1) == "0")


def _structure(spark, sf_dir):
    lines = braced_lines(spark, sf_dir)
    ents = E.with_parent(E.with_uuid(E.merge(lines)))
    keys = ents.select("document", "uuid", F.posexplode(F.split("key", ",")).alias("nth", "key"))
    met = keys.join(lines, ["document", "key"]).select("uuid", F.col("nth").alias("pos"), F.concat_ws(":", "document", "key").alias("line"), "class", "text", "page", "confidence", "doubtful", "corrected")
    built = ents.where(F.col("entity") == "ENTRY").select("uuid", strip(F.col("markdown")).alias("text")).withColumn("n", F.floor(F.length("text") / 3).cast("int"))
    span = lambda a, z, label: F.struct(a.cast("int").alias("start"), z.cast("int").alias("end"), F.lit(label).alias("label"), F.lit(0.5).alias("score"))
    first = F.substring("uuid", 1, 1)
    spans = F.filter(F.array(F.when(first > "3", span(F.lit(0), F.col("n"), "SUBJ")), F.when(first > "9", span(F.col("n") * 2, F.length("text"), "ADDR"))), lambda s: s["end"] > s["start"])
    tags = built.select("uuid", spans.alias("spans"), (F.conv(F.substring("uuid", 2, 1), 16, 10).cast("int") / 16).alias("ner_confidence"), F.when(first == "0", F.array(F.lit("score bas"))).alias("ner_suspect"), (first == "1").alias("corrected"))
    return LA.structure(ents, met, tags)


def structure_layer(spark, sf_dir):
    """The whole row of each entity; lists as text."""
    told = lambda x, *c: F.array_join(F.transform(x, lambda v: F.concat_ws(":", *[v[n].cast("string") for n in c])), ",")
    return _structure(spark, sf_dir).select(
        "range", "uuid", "parent", "entity", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"), "text", told("lines", "line", "start", "end").alias("lines"), "level", "heading", "kind",
        told("spans", "id", "label", "start", "end").alias("spans"), "quality.*", F.array_join("quality.ner_suspect", ",").alias("suspect"), "error").drop("ner_suspect")


def brace_members(spark, sf_dir):
    """The members of all groups, and what is to be checked about a member's signs."""
    rows = _structure(spark, sf_dir).where(F.col("kind") == "group").select("uuid", F.posexplode_outer("members").alias("segment", "m"), "problems")
    signs = F.filter("problems", lambda p: (p["segment"] == F.col("segment")) & ~p["message"].startswith("span ") & ~p["message"].startswith("member without SUBJ"))
    zones = F.array_join(F.transform("m.inherited", lambda z: F.concat_ws("-", z["start"].cast("string"), z["end"].cast("string"))), ",")
    return rows.select("uuid", "segment", F.col("m.id").alias("id"), F.array_join("m.lines", ",").alias("lines"), F.col("m.own.start").alias("own_start"), F.col("m.own.end").alias("own_end"), zones.alias("inherited"), F.size("m.spans").alias("spans"), F.array_join(F.transform(signs, lambda p: p["message"]), "; ").alias("problems"))


def _document(spark, sf_dir):
    """The lines of all documents as pages of ten with blocks of five, some added by hand, some labelled, a page without lines."""
    lines = classed_lines(spark, sf_dir)
    spot = lambda c: [F.floor(c / 10).cast("int").alias("page"), F.floor(c % 10 / 5).cast("int").alias("block")]
    digit = F.substring("key", 10, 1)
    ocr = lines.select("document", "key", F.concat(F.lit("u"), F.col("pos").cast("string")).alias("uid"), *spot(F.col("pos")), F.col("text").alias("markdown"), F.when(digit > "3", F.array(F.struct(F.lit("w").alias("word"), F.col("confidence").alias("score")), F.struct(F.lit("x").alias("word"), F.lit(0.95).alias("score")))).alias("words"), F.when(digit > "1", F.array(F.lit(1), F.lit(2), F.col("pos"), F.lit(4))).alias("bbox"))
    table = lines.select("document", F.col("pos").cast("double").alias("pos"), "key", *spot(F.col("pos")), "class", F.when(digit == "0", F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"), (digit == "0").alias("corrected"), F.when(digit > "7", F.lit(0.5)).alias("probability"), F.when(digit > "b", F.lit("model")).alias("provenance"))
    added = lines.where(digit == "2").select("document", (F.col("pos") + 0.5).alias("pos"), F.concat("key", F.lit("+1")).alias("key"), *spot(F.col("pos")), F.lit("I-ENTRY").alias("class"), F.lit("added").alias("text"), F.lit(True).alias("corrected"), F.lit(None).cast("double").alias("probability"), F.lit("").alias("provenance"))
    box = F.array(*[F.lit(float(x)) for x in (10, 20, 510, 820)])
    pages = lines.groupBy("document").agg(F.max("pos").alias("last")).select("document", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / 10).cast("int") + 1)).alias("page_index"))
    pages = pages.select("document", "page_index", box.alias("page_box"), F.transform(F.sequence(F.lit(0), F.lit(1)), lambda i: F.struct(i.alias("index"), F.lit("Text").alias("label"), F.array(F.lit(0.0), i.cast("double")).alias("bbox"))).alias("data_blocks"))
    return table.unionByName(added), ocr, pages


def document_layer(spark, sf_dir):
    """A row for each line of each page, and one for a page without lines."""
    out = LA.document_layer(*_document(spark, sf_dir))
    x = lambda c: F.col(f"x.{c}")
    return out.select(F.col("id").alias("page_id"), "page", F.array_join(F.col("size").cast("array<string>"), "x").alias("size"), F.array_join(F.transform("blocks", lambda b: b["id"]), ",").alias("blocks"), F.posexplode_outer("lines").alias("nth", "x")).select("page_id", "page", "size", "blocks", "nth", x("id").alias("id"), x("uid").alias("uid"), x("block").alias("block"), x("origin").alias("origin"), x("class").alias("class"), x("text").alias("text"), x("ocr_text").alias("ocr_text"), F.array_join(x("bbox_estimate").cast("array<string>"), ",").alias("bbox"), x("ocr.confidence").alias("confidence"), x("ocr.doubtful").alias("doubtful"), F.size(x("ocr.words")).alias("words"), x("labeling.probability").alias("probability"), x("labeling.provenance").alias("provenance"), x("corrected").alias("corrected"))


def layer_problems(spark, sf_dir):
    """Against an OCR that lacks some lines and pages."""
    table, ocr, pages = _document(spark, sf_dir)
    return LA.layer_problems(table, ocr.where(F.substring("key", 11, 1) != "0"), pages.where(F.col("page_index") % 7 != 3))


def export_counts(spark, sf_dir):
    return LA.export_counts(LA.document_layer(*_document(spark, sf_dir)), _structure(spark, sf_dir))


def tagging_metrics(spark, sf_dir):
    """The rule scorer held against the thirds of each line."""
    rows = TA.predict(spanned(spark, sf_dir).withColumnRenamed("spans", "gold"), TA.rule_scorer).withColumn("weight", F.lit(1.0))
    return TA.weighted_metrics(rows.withColumn("c", TA.compare(F.col("text"), F.col("gold"), F.col("spans"))))


def nested_spans(spark, sf_dir):
    """Spans of customers' orders as ranges, without those inside a longer one of the same priority."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    start = (F.col("o_orderkey") % 40).cast("int")
    return TA.prune_nested(o.select(F.col("o_custkey").alias("id"), start.alias("start"), (start + 1 + F.col("o_orderkey") % 13).cast("int").alias("end"), F.col("o_orderpriority").alias("label")))


def labeller(spark, sf_dir):
    """A sequence labeller per document for guessing the typographic class from every second line."""
    from pyspark.sql import Window

    lines = keyed_lines(spark, sf_dir)
    before = F.lag("text").over(Window.partitionBy("document").orderBy("pos"))
    guess = heading_class(F.col("text"), before)
    lines = lines.withColumn("label", F.when(F.col("pos") % 2 == 0, guess)).withColumn("pos", F.col("pos").cast("long"))
    f = FE.with_features(lines, ["bias", "heading", "starts_lower", "ends_punct", "prev_line"])
    return CR.label_documents(f.select("document", "pos", "label", "features"), ["B-ENTRY", "I-ENTRY", "B-TITLE", "OUT OF SCOPE"], rounds=15).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("probability"), 3).alias("probability"))


def learned_links(spark, sf_dir):
    """Links of two editions learned from those whose number is even: a true one has the same number."""
    left, right = two_years(spark, sf_dir)
    number = F.expr("substring(uuid, 2)")
    judged = left.where(number.cast("long") % 2 == 0)
    same = judged.select("segment", F.col("uuid").alias("left_uuid"), number.alias("number")).join(right.select("segment", F.col("uuid").alias("right_uuid"), number.alias("number")), ["segment", "number"])
    model = LK.learn(LK.counted(left, right, judged, same), count="n")
    return LK.link(left, right, model).select("segment", "left_uuid", "right_uuid", F.round("score", 4).alias("score"))


def event_sessions(spark, sf_dir):
    return sessions.activity(read(spark, sf_dir, "events", "ts", "user_id"))


def event_latest(spark, sf_dir):
    return sessions.latest(read(spark, sf_dir, "events", "ts", "user_id", "event_type"))


QUERIES = {f.__name__: f for f in (suspicion, tagged_round_trip, span_pieces, title_keys, heading_guess, line_features, feature_values, all_features, containing_chunk, html_blocks, entity_pieces, structure_layer, brace_members, document_layer, layer_problems, export_counts, tagging_metrics, nested_spans, labeller, learned_links, event_sessions, event_latest)}

DOCUMENT_SQL = CLASSED_SQL + """,
pages AS (SELECT document, CAST(unnest(range(0, max(pos) // 10 + 2)) AS INTEGER) AS page FROM classed GROUP BY document),
base AS (SELECT *, substr(key, 10, 1) AS digit, CAST(pos // 10 AS INTEGER) AS page, CAST(pos % 10 // 5 AS INTEGER) AS block FROM classed),
t AS (
  SELECT document, CAST(pos AS DOUBLE) AS pos, key, page, block, 'u' || pos AS uid, 'ocr' AS origin, class, CASE WHEN digit = '0' THEN text || '!' ELSE text END AS text, text AS ocr_text, CASE WHEN digit > '1' THEN '1,2,' || pos || ',4' END AS bbox,
    CASE WHEN digit > '3' THEN least(confidence, 0.95::DOUBLE) END AS confidence, CASE WHEN digit > '3' THEN least(confidence, 0.95::DOUBLE) < 0.9::DOUBLE END AS doubtful, CASE WHEN digit > '7' THEN 0.5::DOUBLE END AS probability, CASE WHEN digit > 'b' THEN 'model' END AS provenance, digit = '0' AS corrected FROM base
  UNION ALL SELECT document, pos + 0.5, key || '+1', page, block, NULL, 'added', 'I-ENTRY', 'added', NULL, NULL, NULL, NULL, NULL, NULL, true FROM base WHERE digit = '2')"""


def uuid5_sql(digest: str) -> str:
    return f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || substr('89ab', CAST('0x' || substr({digest}, 17, 1) AS INTEGER) % 4 + 1, 1) || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"


#: The lines of `braced_lines`, in the place of the classed ones that entities are made of.
_BRACED = """,
classed AS (SELECT document, pos, key, class, confidence, doubtful, replace(replace(text, '{', ''), '}', '') || CASE class WHEN 'B-ENTRY' THEN ' } tous' WHEN 'SUB-ENTRY' THEN ' }' ELSE '' END AS text, CAST(pos // 10 AS INTEGER) AS page FROM unbraced)"""
STRUCTURE_TAIL = f"""pieces AS (
  SELECT uuid, nth, c.*, trim(c.text, ' ' || chr(9) || chr(13)) AS s, coalesce(sum(length(trim(c.text, ' ' || chr(9) || chr(13))) + 1) OVER (PARTITION BY uuid ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT document, uuid, unnest(string_split(key, ',')) AS key, unnest(range(len(string_split(key, ',')))) AS nth FROM entities) k JOIN classed c USING (document, key)),
built AS (SELECT uuid, string_agg(CASE WHEN nth = 0 THEN '' WHEN class = 'SUB-ENTRY' THEN chr(10) ELSE ' ' END || s, '' ORDER BY nth) AS text FROM pieces GROUP BY uuid),
cut AS (SELECT uuid, text, length(text) // 3 AS n FROM built JOIN entities USING (uuid) WHERE entity = 'ENTRY'),
spans0 AS (SELECT uuid, text, 0 AS start, n AS "end", 'SUBJ' AS label FROM cut WHERE substr(uuid, 1, 1) > '3' UNION ALL SELECT uuid, text, 2 * n, length(text), 'ADDR' FROM cut WHERE substr(uuid, 1, 1) > '9'),
spans1 AS (SELECT *, sha1(unhex('{LA.SPAN_SPACE.hex}') || encode(uuid || '#' || label || '#' || trim(regexp_replace(replace(text[start + 1 : "end"], '*', ''), '\\s+', ' ', 'g')) || '#1')) AS d FROM spans0 WHERE "end" > start),
spanned AS (SELECT uuid, label, start, "end", {uuid5_sql("d")} AS id FROM spans1),
seg0 AS (SELECT p.*, sum(CAST(class = 'SUB-ENTRY' AND nth > 0 AS INTEGER)) OVER (PARTITION BY uuid ORDER BY nth) AS segment FROM pieces p JOIN entities USING (uuid) WHERE entity = 'ENTRY'),
seg1 AS (SELECT uuid, segment, min(start) AS a, max(start + length(s)) AS z, string_agg(s, ' ' ORDER BY nth) AS part, string_agg(document || ':' || key, ',' ORDER BY nth) AS lines, count(*) OVER (PARTITION BY uuid) AS n, bool_or(contains(string_agg(s, ' '), '}}')) OVER (PARTITION BY uuid) AS signed FROM seg0 GROUP BY uuid, segment),
seg2 AS (SELECT *, contains(part, '}}') AS has, CASE WHEN contains(part, '}}') THEN rtrim(split_part(part, '}}', 1), ' ' || chr(9) || chr(13)) ELSE part END AS own, CASE WHEN contains(part, '}}') THEN nullif(trim(split_part(part, '}}', 2), ' ' || chr(9) || chr(13)), '') END AS shared FROM seg1 WHERE n > 1 AND signed),
seg3 AS (SELECT *, sum(CAST(NOT has AS INTEGER)) OVER (PARTITION BY uuid ORDER BY segment) AS run FROM seg2),
members AS (
  SELECT uuid, segment, lines, has, shared, own, a AS own_start, a + length(own) AS own_end, row_number() OVER (PARTITION BY uuid, run ORDER BY segment) = CASE WHEN run = 0 THEN 1 ELSE 2 END AS bare,
    CASE WHEN has THEN last_value(CASE WHEN shared IS NOT NULL THEN z - length(shared) END IGNORE NULLS) OVER w END AS shared_start, CASE WHEN has THEN last_value(CASE WHEN shared IS NOT NULL THEN z END IGNORE NULLS) OVER w END AS shared_end,
    sha1(unhex('{LA.MEMBER_SPACE.hex}') || encode(uuid || '#' || split_part(lines, ',', 1))) AS d
  FROM seg3 WINDOW w AS (PARTITION BY uuid, run ORDER BY segment ROWS UNBOUNDED PRECEDING))"""
STRUCTURE_SQL = ENTITIES_SQL.replace("\nclassed AS (SELECT", "\nunbraced AS (SELECT", 1).replace(",\ntracked AS", _BRACED + ",\ntracked AS", 1) + ",\n" + STRUCTURE_TAIL
#: Both layers: the document's lines are those without braces.
_BOTH_SQL = STRUCTURE_SQL + "," + DOCUMENT_SQL.split("AS text FROM classed0)", 1)[1].removeprefix(",").replace("FROM classed", "FROM unbraced")

_ESCAPED = "replace(replace({}, '<', '&lt;'), '>', '&gt;')"

_W = r"\p{L}\p{M}\p{N}_"
#: Lines with their plain text: no heading signs, emphasis or blanks at the end.
PLAIN_SQL = LINES_SQL + rf""",
plain0 AS (SELECT *, regexp_replace(replace(regexp_replace(text, '^\s*#+\s*', ''), '*', ''), '(^|[^{_W}])_{{1,3}}', '\1', 'g') AS p0 FROM keyed),
plain1 AS (SELECT *, regexp_replace(regexp_replace(p0, '_{{1,3}}($|[^{_W}])', '\1', 'g'), '\s+$', '') AS plain FROM plain0)"""


def _kind(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN 'none' WHEN {c} LIKE '%.' THEN 'period' WHEN {c} LIKE '%-' THEN 'hyphen' WHEN regexp_matches({c}, '[—–]$') THEN 'dash' WHEN {c} LIKE '%,' THEN 'comma' WHEN regexp_matches({c}, '\\d$') THEN 'digit' WHEN regexp_matches({c}, '\\p{{Ll}}$') THEN 'lower' WHEN regexp_matches({c}, '\\p{{L}}$') THEN 'upper' ELSE 'other' END"


def _flag(c: str) -> str:
    return f"CASE WHEN {c} THEN 'True' ELSE 'False' END"


_FOLD = "replace(replace(lower({0}), 'ß', 'ss'), 'ſ', 's')"

SQL = {
    "heading_guess": rf"""WITH {PLAIN_SQL},
b AS (SELECT *, coalesce(lag(plain) OVER (PARTITION BY document ORDER BY pos), '') AS before FROM plain1),
g AS (SELECT document, CASE WHEN starts_with(trim(text), '#') THEN 'B-TITLE' WHEN trim(plain) = '' OR regexp_matches(trim(plain), '^[-—_]{{3,}}$') THEN 'OUT OF SCOPE' WHEN regexp_matches(trim(plain), '^[\p{{Ll}}\-—]') THEN 'I-ENTRY' WHEN regexp_matches(before, '[-—]$') THEN 'I-ENTRY' ELSE 'B-ENTRY' END AS guess FROM b)
SELECT document, count(*) AS lines, CAST(count_if(guess = 'B-TITLE') AS BIGINT) AS "B-TITLE", CAST(count_if(guess = 'I-ENTRY') AS BIGINT) AS "I-ENTRY", CAST(count_if(guess = 'B-ENTRY') AS BIGINT) AS "B-ENTRY", CAST(count_if(guess = 'OUT OF SCOPE') AS BIGINT) AS "OUT OF SCOPE" FROM g GROUP BY document""",
    "feature_values": rf"""WITH {PLAIN_SQL},
k AS (SELECT *, regexp_extract_all(plain, '[{_W}]+|[^{_W}\s]') AS t, regexp_extract_all(plain, '[\p{{L}}\p{{M}}]{{1,15}}') AS words, lower(strip_accents(regexp_extract(plain, '[\p{{L}}\p{{M}}]+'))) AS sort, length(plain) AS n, length(regexp_replace(plain, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(plain, '[^\p{{Lu}}]', '', 'g')) AS capitals FROM plain1),
w AS (SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY document) AS total, lag(plain) OVER o AS prev, lag(sort) OVER o AS psort, lead(sort) OVER o AS nsort, lead(text) OVER o AS next, lag(n) OVER o AS pn, lag(pos // 4) OVER o AS pb, lead(pos // 4) OVER o AS nb FROM k WINDOW o AS (PARTITION BY document ORDER BY pos)),
a AS (SELECT *, i > 1 AND psort <> '' AND sort < psort AS below, i < total AND nsort <> '' AND sort > nsort AS above FROM w)
SELECT document, CAST(pos AS INTEGER) AS pos, {_flag("starts_with(text, '#')")} AS is_heading, {_flag(r"coalesce(regexp_matches(t[1], '\p{Ll}') AND NOT regexp_matches(t[1], '\p{Lu}'), false)")} AS starts_lower, {_flag("coalesce(t[-1] IN (',', '.', '—', '-', '_'), false)")} AS ends_punct, CAST(least(len(t), 12) AS VARCHAR) AS token_count,
  {_flag("i = 1")} AS bos, {_flag("i = total")} AS eos, CASE WHEN i > 1 THEN {_kind("prev")} END AS prev_end, CASE WHEN sort = '' THEN 'no_word' WHEN below AND above THEN 'out' WHEN below THEN 'before_prev' WHEN above THEN 'after_next' ELSE 'in_order' END AS alpha_order,
  {_flag("i = 1 OR pos // 4 <> pb")} AS first_in_block, {_flag("i = total OR pos // 4 <> nb")} AS last_in_block, {_kind("plain")} AS last_char,
  {_flag(r"regexp_matches(plain, '(?i)(^|[^" + _W + "])(rue|quai|place|faub|fg|boulevard|boul|bd|cour|passage|cloître|clo[iî]tre|marché|port|pont|carré|enclos|impasse|cul-de-sac|barrière|chaussée|montagne|vieille|neuve)($|[^" + _W + "])') OR regexp_matches(plain, '(?i)(^|[^" + _W + r"])(r|q|pl|f|pass)\.[" + _W + "]')")} AS has_street_word,
  {_flag(r"regexp_matches(plain, '\d')")} AS has_number, {_flag(r"regexp_matches(plain, '\d+\s*[.,;]?$')")} AS ends_with_number, CAST(CAST(least(floor(log2(n + 1)), 8) AS INTEGER) AS VARCHAR) AS char_length_log2,
  CASE WHEN i > 1 THEN CASE WHEN n / greatest(pn, 1) < 0.6 THEN 'shorter' WHEN n / greatest(pn, 1) > 1.6 THEN 'longer' ELSE 'similar' END END AS length_vs_prev, {_FOLD.format("words[1]")} AS first_word, {_FOLD.format("words[-1]")} AS last_word, CASE WHEN i < total THEN {_flag("starts_with(next, '#')")} END AS next_is_heading,
  CASE WHEN letters = 0 THEN 'no_letters' WHEN capitals = 0 THEN 'low' WHEN capitals / letters >= 0.9 THEN 'all' WHEN capitals / letters >= 0.5 THEN 'mostly' WHEN capitals / letters >= 0.2 THEN 'mixed' ELSE 'low' END AS uppercase FROM a""",
    "suspicion": f"""WITH {SPANNED_SQL},
s AS (SELECT id, text, spans, array_to_string(list_transform(spans, lambda s: s.label), ',') AS signature, CASE WHEN len(spans) = 0 THEN 0 ELSE list_min(list_transform(spans, lambda s: s.score)) END AS confidence,
  array_to_string(list_transform(list_filter(range(1, length(text) + 1), lambda i: len(list_filter(spans, lambda s: s.start < i AND i <= s."end")) = 0), lambda i: text[i]), '') AS rest FROM spanned)
SELECT id, signature, round(confidence, 9) AS confidence, CASE WHEN len(spans) = 0 THEN 'aucun empan' ELSE concat_ws(' | ', CASE WHEN confidence < 0.9::DOUBLE THEN 'score bas' END, CASE WHEN regexp_matches(rest, '[\\p{{L}}\\p{{N}}_]') THEN 'texte non couvert' END, CASE WHEN NOT starts_with(signature, 'SUBJ') THEN 'SUBJ absent en tête' END, CASE WHEN starts_with(signature, 'SUBJ') AND signature NOT IN ('SUBJ,ADDR', 'SUBJ,DESC,ADDR', 'SUBJ,DESC', 'SUBJ') THEN 'signature inhabituelle' END) END AS reasons,
  CAST(len(list_filter(spans, lambda s: s.label = 'SUBJ')) AS INTEGER) AS n_subj, CAST(len(list_filter(spans, lambda s: s.label = 'DESC')) AS INTEGER) AS n_desc, CAST(len(list_filter(spans, lambda s: s.label = 'ADDR')) AS INTEGER) AS n_addr FROM s""",
    "tagged_round_trip": f"""WITH {SPANNED_SQL},
cut AS (SELECT id, text, spans, list_concat([0], list_transform(spans, lambda s: s."end")) AS ends FROM spanned),
parts AS (SELECT id, text, spans, list_transform(range(1, len(spans) + 1), lambda i: {{'before': text[ends[i] + 1 : spans[i].start], 'own': text[spans[i].start + 1 : spans[i]."end"], 'label': spans[i].label}}) AS p, text[ends[-1] + 1 :] AS rest FROM cut)
SELECT id, array_to_string(list_transform(p, lambda x: {_ESCAPED.format("x.before")} || '<' || x.label || '>' || {_ESCAPED.format("x.own")} || '</' || x.label || '>'), '') || {_ESCAPED.format("rest")} AS tagged, text,
  array_to_string(list_transform(spans, lambda s: s.label || ':' || s.start || ':' || s."end"), ',') AS spans,
  array_to_string(list_transform(list_filter(p, lambda x: x.label = 'ADDR' AND regexp_matches(replace(x.own, '*', ''), '[^ \\t\\n]')), lambda x: trim(regexp_replace(replace(x.own, '*', ''), '\\s+', ' ', 'g'))), '|') AS addresses FROM parts""",
    "span_pieces": f"""WITH {LINES_SQL},
r AS (SELECT document, pos, length(text) AS n FROM keyed),
p AS (SELECT document, pos, n // 4 AS s, n - n // 8 AS e, 'a' AS line, 0 AS a, n // 2 AS z, 2 AS lead FROM r UNION ALL SELECT document, pos, n // 4, n - n // 8, 'b', n // 2 + 1, n + 1, 0 FROM r)
SELECT document, CAST(pos AS INTEGER) AS pos, line, CAST(greatest(s, a) - a + lead AS INTEGER) AS start, CAST(least(e, z) - a + lead AS INTEGER) AS "end" FROM p WHERE least(e, z) > greatest(s, a)""",
    "title_keys": f"WITH {LINES_SQL} SELECT document, CAST(pos AS INTEGER) AS pos, lower(trim(regexp_replace(strip_accents(regexp_replace(text, '\\*', '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS title_key, 2 AS level FROM keyed",
    "line_features": f"""WITH {LINES_SQL},
w AS (SELECT *, lag(text) OVER (PARTITION BY document ORDER BY pos) AS prev, row_number() OVER (PARTITION BY document ORDER BY pos) AS k, count(*) OVER (PARTITION BY document) AS n FROM keyed)
SELECT document, CAST(pos AS INTEGER) AS pos, CASE WHEN starts_with(text, '#') THEN 'True' ELSE 'False' END AS is_heading, CAST(length(regexp_extract(text, '^(#*)', 1)) AS VARCHAR) AS heading_level, CASE WHEN k = 1 THEN 'True' ELSE 'False' END AS bos, CASE WHEN k = n THEN 'True' ELSE 'False' END AS eos,
  CAST(least(len(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+|[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]')), 12) AS VARCHAR) AS token_count, CASE WHEN k > 1 THEN CASE WHEN starts_with(prev, '#') THEN 'True' ELSE 'False' END END AS prev_is_heading,
  CASE WHEN k > 1 THEN CASE WHEN regexp_matches(prev, '[-—]\\s*$') THEN 'True' ELSE 'False' END END AS prev_ends_dash, 'False' AS is_page_marker, '1' AS placebo_constant FROM w""",
    "containing_chunk": """WITH b AS (SELECT page_id, page_id % 700 AS l, page_id % 300 AS t, page_id % 700 + 120 + page_id % 90 AS r, page_id % 300 + 200 AS b FROM pages)
SELECT page_id, CASE WHEN r <= 300 THEN 1 WHEN l >= 250 AND r <= 600 THEN 2 WHEN l >= 100 AND t >= 100 AND r <= 900 AND b <= 450 THEN 3 WHEN l >= 550 AND r <= 1000 THEN 4 END AS chunk, round(l / 500 * 1000, 6) AS "left", round(b / 2000 * 1000, 6) AS bottom FROM b""",
    "entity_pieces": f"""WITH {ENTITIES_SQL},
k AS (SELECT document, uuid, markdown, unnest(string_split(key, ',')) AS key, unnest(range(len(string_split(key, ',')))) AS nth FROM entities),
t AS (SELECT k.uuid, nth, trim(text, ' ' || chr(9) || chr(13)) AS s, sum(length(trim(text, ' ' || chr(9) || chr(13))) + 1) OVER (PARTITION BY k.uuid ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS start FROM k JOIN classed c ON c.document = k.document AND c.key = k.key)
SELECT uuid, CAST(count(*) AS INTEGER) AS lines, CAST(max(coalesce(start, 0)) AS INTEGER) AS last_start, CAST(max(coalesce(start, 0) + length(s)) AS INTEGER) AS last_end, true AS same FROM t GROUP BY uuid""",
    "document_layer": f"""WITH {DOCUMENT_SQL}
SELECT p.document || ':' || p.page AS page_id, p.page, '500.0x800.0' AS size, p.document || ':' || p.page || '.0,' || p.document || ':' || p.page || '.1' AS blocks, CASE WHEN t.key IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY p.document, p.page ORDER BY t.pos) - 1 AS INTEGER) END AS nth,
  t.document || ':' || t.key AS id, uid, t.document || ':' || t.page || '.' || t.block AS block, origin, class, text, ocr_text, bbox, confidence, doubtful, CASE WHEN confidence IS NOT NULL THEN 2 ELSE NULL END AS words, probability, provenance, corrected
FROM pages p LEFT JOIN t ON t.document = p.document AND t.page = p.page""",
    "layer_problems": f"""WITH {DOCUMENT_SQL}
SELECT document, key, CASE WHEN origin = 'ocr' AND substr(key, 11, 1) = '0' THEN 'no such line in the OCR' ELSE 'no such page' END AS problem FROM t WHERE (origin = 'ocr' AND substr(key, 11, 1) = '0') OR page % 7 = 3""",
    "export_counts": f"""WITH {_BOTH_SQL}
SELECT (SELECT count(*) FROM pages) AS pages, (SELECT count(*) FROM t) AS lines, (SELECT count_if(origin = 'added') FROM t) AS added_lines, (SELECT count_if(class = 'SUPPRIMÉE') FROM t) AS deleted_lines, (SELECT count_if(origin = 'ocr' AND bbox IS NULL) FROM t) AS lines_without_box,
  (SELECT count_if(entity = 'TITLE') FROM entities) AS titles, (SELECT count_if(entity = 'ENTRY') FROM entities) AS entries, (SELECT count_if(entity = 'OUT OF SCOPE') FROM entities) AS out_of_scope, (SELECT count(DISTINCT uuid) FROM members) AS "groups", (SELECT count(*) FROM members) AS members,
  (SELECT count(*) FROM spanned WHERE label = 'SUBJ') AS spans_subj, 0 AS spans_desc, (SELECT count(*) FROM spanned WHERE label = 'ADDR') AS spans_addr""",
    "structure_layer": f"""WITH {STRUCTURE_SQL},
quality AS (SELECT uuid, min(confidence) AS ocr_confidence, bool_or(doubtful) AS ocr_doubtful, bool_or(substr(key, 9, 1) = '0') AS corrected_lines, string_agg(DISTINCT page, ',' ORDER BY page) AS pages, string_agg(document || ':' || key || ':' || start || ':' || (start + length(s)), ',' ORDER BY nth) AS lines FROM pieces GROUP BY uuid),
tags AS (SELECT uuid, string_agg(id || ':' || label || ':' || start || ':' || "end", ',' ORDER BY start) AS spans FROM spanned GROUP BY uuid),
grouped AS (SELECT DISTINCT uuid FROM members)
SELECT e.document AS range, e.uuid, parent_uuid AS parent, entity, q.pages, b.text, q.lines, CASE WHEN entity = 'TITLE' THEN nullif(length(regexp_extract(b.text, '^\\s*(#+)', 1)), 0) END AS level,
  CASE WHEN entity = 'TITLE' THEN trim(regexp_replace(replace(regexp_replace(b.text, '^\\s*#+', ''), '*', ''), '\\s+', ' ', 'g')) END AS heading, CASE WHEN entity = 'ENTRY' THEN CASE WHEN g.uuid IS NULL THEN 'single' ELSE 'group' END END AS kind, CASE WHEN entity = 'ENTRY' THEN coalesce(t.spans, '') END AS spans,
  CASE WHEN entity = 'ENTRY' THEN ocr_confidence END AS ocr_confidence, CASE WHEN entity = 'ENTRY' THEN ocr_doubtful END AS ocr_doubtful, CASE WHEN entity = 'ENTRY' THEN CAST('0x' || substr(e.uuid, 2, 1) AS INTEGER) / 16 END AS ner_confidence, CASE WHEN entity = 'ENTRY' THEN corrected_lines END AS corrected_lines,
  CASE WHEN entity = 'ENTRY' THEN substr(e.uuid, 1, 1) = '1' END AS corrected_ner, CASE WHEN entity = 'ENTRY' THEN CASE WHEN substr(e.uuid, 1, 1) = '0' THEN 'score bas' ELSE '' END END AS suspect, CAST(NULL AS VARCHAR) AS error
FROM entities e JOIN quality q USING (uuid) JOIN built b USING (uuid) LEFT JOIN tags t USING (uuid) LEFT JOIN grouped g USING (uuid)""",
    "brace_members": f"""WITH {STRUCTURE_SQL}
SELECT m.uuid, CAST(segment AS INTEGER) AS segment, {uuid5_sql("m.d")} AS id, lines, CAST(own_start AS INTEGER) AS own_start, CAST(own_end AS INTEGER) AS own_end, coalesce(shared_start || '-' || shared_end, '') AS inherited,
  CAST((SELECT count(*) FROM spanned s WHERE s.uuid = m.uuid AND s.start >= own_start AND s."end" <= own_end) AS INTEGER) AS spans,
  concat_ws('; ', CASE WHEN has AND shared IS NULL AND bare THEN '}} without shared text' END, CASE WHEN NOT has THEN 'no brace in a group' END, CASE WHEN own = '' THEN 'member without text of its own' END) AS problems FROM members m""",
    "nested_spans": """WITH s AS (SELECT DISTINCT o_custkey AS id, CAST(o_orderkey % 40 AS INTEGER) AS start, CAST(o_orderkey % 40 + 1 + o_orderkey % 13 AS INTEGER) AS "end", o_orderpriority AS label FROM orders)
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.id = s.id AND o.label = s.label AND o.start <= s.start AND o."end" >= s."end" AND o."end" - o.start > s."end" - s.start)""",
    "event_sessions": """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS brk FROM events),
b AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM a)
SELECT user_id AS "user", min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS events FROM b GROUP BY user_id, k""",
    "event_latest": "SELECT user_id, max(ts) AS ts, max_by(event_type, (ts, event_type)) AS event_type FROM events GROUP BY user_id",
}
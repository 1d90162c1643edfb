"""Queries on lines and entities. Lines are those of `documents`; classes, scores and corrections come from their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.keys import fingerprint, with_line_keys
from foliospark.functions.text import title_level
from foliospark.operators import entities as E
from foliospark.operators import overlay as O
from foliospark.operators.lines import doubtful, is_corrected, split_lines

#: Class of a line by the first digit of its key.
BY_DIGIT = {"0": "B-ENTRY", "1": "B-ENTRY", "2": "B-ENTRY", "3": "I-ENTRY", "4": "I-ENTRY", "5": "I-ENTRY", "6": "SUB-ENTRY", "7": "SUB-ENTRY", "8": "B-TITLE", "9": "I-TITLE", "a": "B-ENTRY", "b": "B-ENTRY", "c": "OUT OF SCOPE", "d": "", "e": "SUPPRIMÉE", "f": "?"}


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_line_keys(split_lines(read(spark, sf_dir, "documents", "doc_id", "text")))


def classed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with class, OCR score and doubt; titles get as many # as the second digit says (0 to 3)."""
    lines = keyed_lines(spark, sf_dir)
    digits = F.create_map(*[F.lit(x) for pair in BY_DIGIT.items() for x in pair])
    score = F.conv(F.substring("key", 3, 2), 16, 10).cast("int") / 255
    signs = F.conv(F.substring("key", 2, 1), 16, 10).cast("int") % 4
    lines = lines.withColumn("class", digits[F.substring("key", 1, 1)])
    lines = lines.withColumn("text", F.when(F.col("class").endswith("-TITLE") & (signs > 0), F.concat(F.repeat(F.lit("#"), signs), F.lit(" "), F.col("text"))).otherwise(F.col("text")))
    return lines.withColumn("confidence", score).withColumn("doubtful", doubtful(score))


LINES_SQL = r"""
raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
split AS (SELECT CAST(doc_id AS VARCHAR) AS document, i - 1 AS pos, parts[i] AS text FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM raw)),
hashed AS (SELECT *, substr(sha1(trim(regexp_replace(text, '\s+', ' ', 'g'))), 1, 12) AS digest FROM split),
ranked AS (SELECT *, row_number() OVER (PARTITION BY document, digest ORDER BY pos) AS rank FROM hashed),
keyed AS (SELECT document, pos, text, CASE WHEN rank = 1 THEN digest ELSE digest || '~' || rank END AS key FROM ranked)"""

_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BY_DIGIT.items())
CLASSED_SQL = LINES_SQL + f""",
classed0 AS (SELECT *, CASE substr(key, 1, 1) {_CASES} END AS class, CAST('0x' || substr(key, 2, 1) AS INTEGER) % 4 AS signs, CAST('0x' || substr(key, 3, 2) AS INTEGER) / 255 AS confidence FROM keyed),
classed AS (SELECT document, pos, key, class, confidence, confidence < 0.9 AS doubtful, CASE WHEN class LIKE '%-TITLE' AND signs > 0 THEN repeat('#', signs) || ' ' || text ELSE text END AS text FROM classed0)"""

NUMBERED_SQL = CLASSED_SQL + """,
tracked AS (SELECT *, CASE WHEN class IN ('B-ENTRY', 'I-ENTRY', 'SUB-ENTRY') THEN 'ENTRY' WHEN class IN ('B-TITLE', 'I-TITLE') THEN 'TITLE' ELSE 'OUT OF SCOPE' END AS track FROM classed WHERE class <> 'SUPPRIMÉE'),
opened AS (SELECT *, class LIKE 'B-%' OR track = 'OUT OF SCOPE' OR row_number() OVER (PARTITION BY document, track ORDER BY pos) = 1 AS opener FROM tracked),
numbered AS (SELECT *, sum(CAST(opener AS INTEGER)) OVER (PARTITION BY document, track ORDER BY pos) AS entity_no FROM opened)"""

ENTITIES_SQL = NUMBERED_SQL + """,
merged AS (
  SELECT document, track AS entity, entity_no, min(pos) AS pos, count(*) AS n_lines, min(confidence) AS confidence, bool_or(doubtful) AS doubtful,
    CASE WHEN count(*) = 1 THEN min(text) ELSE substr(string_agg(CASE WHEN opener THEN ' ' WHEN class = 'SUB-ENTRY' THEN chr(10) ELSE ' ' END || trim(text, ' ' || chr(9) || chr(13)), '' ORDER BY pos), 2) END AS markdown,
    string_agg(key, ',' ORDER BY pos) AS key
  FROM numbered GROUP BY document, track, entity_no),
named AS (SELECT *, document || '#' || split_part(key, ',', 1) AS root, row_number() OVER (PARTITION BY document, split_part(key, ',', 1) ORDER BY pos) AS rank FROM merged),
digested AS (SELECT *, sha1(unhex('{space}') || encode(CASE WHEN rank = 1 THEN root ELSE root || '#' || rank END)) AS d FROM named),
ided AS (
  SELECT document, entity, pos, n_lines, confidence, doubtful, markdown, key,
    substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || substr('89ab', CAST('0x' || substr(d, 17, 1) AS INTEGER) % 4 + 1, 1) || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS uuid,
    CASE WHEN entity = 'TITLE' THEN coalesce(nullif(length(regexp_extract(markdown, '^\\s*(#+)', 1)), 0), 99) END AS level
  FROM digested),
titles AS (SELECT document, pos, level, uuid FROM ided WHERE entity = 'TITLE'),
title_parents AS (
  SELECT t.document, t.uuid, arg_max(p.uuid, p.pos) AS parent FROM titles t JOIN titles p ON p.document = t.document AND p.pos < t.pos AND p.level < t.level GROUP BY t.document, t.uuid),
entities AS (
  SELECT i.*, CASE WHEN entity = 'TITLE' THEN coalesce(parent, '00000000-0000-0000-0000-000000000000')
    ELSE coalesce(last_value(CASE WHEN entity = 'TITLE' THEN i.uuid END IGNORE NULLS) OVER (PARTITION BY i.document ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '00000000-0000-0000-0000-000000000000') END AS parent_uuid
  FROM ided i LEFT JOIN title_parents USING (document, uuid))"""
ENTITIES_SQL = ENTITIES_SQL.replace("{space}", E.ENTITY_SPACE.hex)


def line_keys(spark, sf_dir):
    lines = keyed_lines(spark, sf_dir)
    return lines.select("document", "pos", "key", fingerprint(F.col("text"), F.col("key")).alias("fingerprint"))


def entities_of(spark, sf_dir):
    return E.with_parent(E.with_uuid(E.merge(classed_lines(spark, sf_dir))))


def entities(spark, sf_dir):
    return entities_of(spark, sf_dir).select("document", "entity", "pos", "n_lines", "confidence", "doubtful", "markdown", "key", "uuid", "parent_uuid")


def title_tree_counts(spark, sf_dir):
    return E.tree_counts(entities_of(spark, sf_dir))


def merge_report(spark, sf_dir):
    lines = classed_lines(spark, sf_dir)
    return E.report(lines, E.with_parent(E.with_uuid(E.merge(lines))))


def alphabet_breaks(spark, sf_dir):
    return E.alphabet_breaks(classed_lines(spark, sf_dir))


def doubtful_lines(spark, sf_dir):
    lines = classed_lines(spark, sf_dir)
    return lines.groupBy("class").agg(F.count(F.lit(1)).alias("lines"), F.count_if("doubtful").alias("doubtful"), F.min("confidence").alias("lowest"), F.count_if(F.col("doubtful") & ~is_corrected(F.when(F.substring("key", 4, 1) == "0", "oui"))).alias("doubtful_not_corrected"))


def edited_lines(spark, sf_dir):
    """A hand-edited copy of the line table: some corrected, some changed without a mark, some gone, some inserted, some moved."""
    lines = classed_lines(spark, sf_dir).withColumn("fingerprint", fingerprint(F.col("class"), F.col("text")))
    digit = F.substring("key", 5, 1)
    edited = lines.where(digit != "0").withColumn("corrected", F.when(digit.isin("1", "2"), "oui").otherwise("")).withColumn("class", F.when(digit == "1", "B-ENTRY").otherwise(F.col("class"))).withColumn("text", F.when(digit == "3", F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    inserted = lines.where(digit == "4").select("document", (F.col("pos") + 0.5).alias("pos"), F.concat("text", F.lit(" (bis)")).alias("text"), F.lit("").alias("key"), F.lit("I-ENTRY").alias("class"), F.lit("").alias("fingerprint"), F.lit("").alias("corrected"))
    return edited.select("document", F.col("pos").cast("double").alias("pos"), "text", "key", "class", "fingerprint", "corrected").unionByName(inserted)


EDITED_SQL = CLASSED_SQL + r""",
printed AS (SELECT *, substr(sha1(trim(regexp_replace(class, '\s+', ' ', 'g')) || chr(31) || trim(regexp_replace(text, '\s+', ' ', 'g'))), 1, 12) AS fingerprint, substr(key, 5, 1) AS digit FROM classed),
edited AS (
  SELECT document, CAST(pos AS DOUBLE) AS pos, CASE WHEN digit = '3' THEN text || '!' ELSE text END AS text, key, CASE WHEN digit = '1' THEN 'B-ENTRY' ELSE class END AS class, fingerprint, CASE WHEN digit IN ('1', '2') THEN 'oui' ELSE '' END AS corrected
  FROM printed WHERE digit <> '0'
  UNION ALL SELECT document, pos + 0.5, text || ' (bis)', '', 'I-ENTRY', '', '' FROM printed WHERE digit = '4'),
behind AS (SELECT *, coalesce(lag(key) OVER (PARTITION BY document ORDER BY pos), '') AS previous FROM edited),
capture AS (
  SELECT document, pos, text, class, previous, CASE WHEN key = '' THEN CASE WHEN previous = '' THEN 'debut' ELSE previous END || '+1' ELSE key END AS key,
    CASE WHEN key = '' THEN 'inserted' WHEN corrected = 'oui' THEN 'corrected' WHEN substr(sha1(trim(regexp_replace(class, '\s+', ' ', 'g')) || chr(31) || trim(regexp_replace(text, '\s+', ' ', 'g'))), 1, 12) <> fingerprint THEN 'unmarked' ELSE 'same' END AS state
  FROM behind)"""


def overlay_capture(spark, sf_dir):
    return O.capture(edited_lines(spark, sf_dir), ["class", "text"]).where(F.col("state") != "same").select("document", "key", "state", "after", "class", "text")


def _patch(spark, sf_dir):
    found = O.capture(edited_lines(spark, sf_dir), ["class", "text"])
    return found.where(F.col("state").isin("corrected", "inserted")).select("document", "key", "after", "class", "text")


def overlay_apply(spark, sf_dir):
    machine = classed_lines(spark, sf_dir).select("document", "pos", "key", "class", "text", "confidence")
    # a machine that reads some lines otherwise by now: these lines are new, and patches to them are orphans
    machine = machine.withColumn("key", F.when(F.substring("key", 6, 1) == "0", F.concat(F.lit("x"), "key")).otherwise(F.col("key")))
    return O.apply(machine, _patch(spark, sf_dir), ["class", "text"], machine_only=["confidence"]).select("document", "rank", "key", "class", "text", "confidence", "corrected", "problem")


def overlay_moved(spark, sf_dir):
    """Lines of documents whose hand-edited order has every seventh line moved up by three places."""
    lines = keyed_lines(spark, sf_dir)
    edited = lines.select("document", "key", F.when(F.col("pos") % 7 == 6, F.col("pos") - 3.5).otherwise(F.col("pos").cast("double")).alias("pos"))
    return O.moved(lines, edited)


def overlay_erased(spark, sf_dir):
    lines = keyed_lines(spark, sf_dir)
    return O.erased(lines, lines.where(F.substring("key", 5, 1) != "0")).select("document", "key")


QUERIES = {f.__name__: f for f in (line_keys, entities, title_tree_counts, merge_report, alphabet_breaks, doubtful_lines, overlay_capture, overlay_apply, overlay_moved, overlay_erased)}

SQL = {
    "line_keys": f"WITH {LINES_SQL} SELECT document, CAST(pos AS INTEGER) AS pos, key, substr(sha1(trim(regexp_replace(text, '\\s+', ' ', 'g')) || chr(31) || key), 1, 12) AS fingerprint FROM keyed",
    "entities": f"WITH {ENTITIES_SQL} SELECT document, entity, CAST(pos AS INTEGER) AS pos, n_lines, confidence, doubtful, markdown, key, uuid, parent_uuid FROM entities",
    "title_tree_counts": f"""WITH RECURSIVE {ENTITIES_SQL},
direct AS (SELECT document, parent_uuid, count(*) AS n FROM entities WHERE entity = 'ENTRY' GROUP BY ALL),
up(document, own, uuid, n) AS (
  SELECT document, parent_uuid, parent_uuid, n FROM direct
  UNION ALL SELECT up.document, own, e.parent_uuid, n FROM up JOIN entities e ON e.document = up.document AND e.uuid = up.uuid AND e.entity = 'TITLE'),
counted AS (SELECT document, uuid, CAST(sum(n) AS BIGINT) AS subtree, CAST(sum(CASE WHEN own = uuid THEN n ELSE 0 END) AS BIGINT) AS direct FROM up GROUP BY ALL)
SELECT e.document, e.uuid, coalesce(direct, 0) AS direct, coalesce(subtree, 0) AS subtree FROM entities e LEFT JOIN counted USING (document, uuid) WHERE entity = 'TITLE'""",
    "merge_report": f"""WITH {ENTITIES_SQL},
a AS (SELECT document, count(*) AS lines_read, count_if(class = 'SUPPRIMÉE') AS lines_deleted, count_if(class = '?') AS unknown_classes FROM classed GROUP BY document),
b AS (SELECT document, count_if(opener AND class IN ('I-ENTRY', 'SUB-ENTRY', 'I-TITLE')) AS orphans, count_if(NOT opener) AS merged FROM numbered GROUP BY document),
c AS (SELECT document, count_if(entity = 'ENTRY') AS entries, count_if(entity = 'TITLE') AS titles, count_if(entity = 'OUT OF SCOPE') AS out_of_scope, count_if(level = 99) AS unmarked_titles,
        count_if(entity = 'ENTRY' AND parent_uuid = '00000000-0000-0000-0000-000000000000') AS untitled_entries FROM entities GROUP BY document)
SELECT document, CAST(lines_read AS BIGINT) AS lines_read, CAST(lines_deleted AS BIGINT) AS lines_deleted, CAST(unknown_classes AS BIGINT) AS unknown_classes, CAST(coalesce(orphans, 0) AS BIGINT) AS orphans, CAST(coalesce(merged, 0) AS BIGINT) AS merged,
  CAST(coalesce(entries, 0) AS BIGINT) AS entries, CAST(coalesce(titles, 0) AS BIGINT) AS titles, CAST(coalesce(out_of_scope, 0) AS BIGINT) AS out_of_scope, CAST(coalesce(unmarked_titles, 0) AS BIGINT) AS unmarked_titles, CAST(coalesce(untitled_entries, 0) AS BIGINT) AS untitled_entries
FROM a LEFT JOIN b USING (document) LEFT JOIN c USING (document)""",
    "alphabet_breaks": f"""WITH {NUMBERED_SQL},
runs AS (SELECT *, sum(CAST(class = 'B-TITLE' AS INTEGER)) OVER (PARTITION BY document ORDER BY pos) AS run FROM numbered),
keys AS (SELECT document, pos, run, substr(array_to_string(regexp_extract_all(upper(regexp_replace(strip_accents(split_part(text, ',', 1)), '[^\\x00-\\x7F]', '', 'g')), '[A-Z0-9]+')[1:2], ''), 1, 5) AS sort_key FROM runs WHERE track = 'ENTRY' AND opener),
lagged AS (SELECT *, lag(sort_key) OVER (PARTITION BY document, run ORDER BY pos) AS previous_key FROM keys WHERE sort_key <> '')
SELECT document, CAST(pos AS INTEGER) AS pos, sort_key, previous_key FROM lagged WHERE sort_key < previous_key""",
    "doubtful_lines": f"WITH {CLASSED_SQL} SELECT class, count(*) AS lines, CAST(count_if(doubtful) AS BIGINT) AS doubtful, min(confidence) AS lowest, CAST(count_if(doubtful AND substr(key, 4, 1) <> '0') AS BIGINT) AS doubtful_not_corrected FROM classed GROUP BY class",
    "overlay_capture": f"WITH {EDITED_SQL} SELECT document, key, state, CASE WHEN state = 'inserted' THEN previous ELSE '' END AS \"after\", class, text FROM capture WHERE state <> 'same'",
    "overlay_apply": f"""WITH {EDITED_SQL},
patch AS (SELECT document, key, CASE WHEN state = 'inserted' THEN previous ELSE '' END AS anchor, state, class, text FROM capture WHERE state IN ('corrected', 'inserted')),
machine AS (SELECT document, pos, CASE WHEN substr(key, 6, 1) = '0' THEN 'x' || key ELSE key END AS key, class, text, confidence FROM classed),
one AS (
  SELECT coalesce(m.document, p.document) AS document, pos, 0 AS n, coalesce(m.key, p.key) AS key, coalesce(p.class, m.class) AS class, coalesce(p.text, m.text) AS text, confidence, CASE WHEN p.key IS NULL OR m.key IS NULL THEN '' ELSE 'oui' END AS corrected,
    CASE WHEN m.key IS NULL THEN 'orphan' END AS problem
  FROM machine m FULL JOIN (FROM patch WHERE state = 'corrected') p ON m.document = p.document AND m.key = p.key),
two AS (
  SELECT p.document, CASE WHEN p.anchor = '' THEN -1 ELSE m.pos END AS pos, 1 AS n, p.key, p.class, p.text, CAST(NULL AS DOUBLE) AS confidence, CASE WHEN m.key IS NULL AND p.anchor <> '' THEN '' ELSE 'oui' END AS corrected, CASE WHEN m.key IS NULL AND p.anchor <> '' THEN 'orphan' END AS problem
  FROM (FROM patch WHERE state = 'inserted') p LEFT JOIN machine m ON m.document = p.document AND m.key = p.anchor),
every AS (FROM one UNION ALL FROM two)
SELECT document, CASE WHEN problem IS NULL THEN CAST(row_number() OVER (PARTITION BY document ORDER BY problem IS NOT NULL, pos, n) AS INTEGER) END AS rank, key, class, text, confidence, corrected, problem FROM every""",
    "overlay_moved": f"""WITH {LINES_SQL},
e AS (SELECT document, key, pos, CASE WHEN pos % 7 = 6 THEN pos - 3.5 ELSE CAST(pos AS DOUBLE) END AS edited FROM keyed),
h AS (SELECT *, max(pos) OVER (PARTITION BY document ORDER BY edited ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest FROM e)
SELECT document, key, CAST(pos AS INTEGER) AS pos, CAST(highest AS INTEGER) AS highest FROM h WHERE pos < highest""",
    "overlay_erased": f"WITH {LINES_SQL} SELECT document, key FROM keyed WHERE substr(key, 5, 1) = '0'",
}

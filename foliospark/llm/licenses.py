"""License scans by diagonal voting, in DataFrame functions only.

Every rolling 3-word gram of every text is joined by hash (and then by its words, so collisions can't count) to the
positions of the same gram in the license templates. A match votes for the diagonal, text position minus template
position. Votes are counted by diagonal, neighbouring diagonals (words put in or left out) are merged, and a merged span
is verified: it must cover enough of the template's grams, densely enough.

Base phrases are templates that must be covered in full on one diagonal: an exact occurrence.

Defined results. Null and wordless texts: no words, no spans, score 0. Repeated rows: one result row each. Several
templates of one license give its label once. Ties between templates don't matter: all verified labels are kept. Very
long texts are scanned in whole. Other columns are not read. Words keep the case of letters beyond A-Z, but for the
letters that Unicode lower-cases; no phrase or template has any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm.common import by_name, table

GRAM = 3
#: Diagonals at most this far apart are merged.
DRIFT = 4
#: The least share of a template's grams in a verified span, and of the span's grams that vote.
COVERAGE = 0.6
DENSITY = 0.5

#: (label, phrase): exact occurrences count.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

#: (label, notice): the wording of public license notices.
TEMPLATES = [
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a whole text. Of one lower-cased by the JVM: beyond A-Z that changes no word's bounds."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT), "")


def _grams(df: DataFrame, array: str, at: str, *keep: str) -> DataFrame:
    """A row for each word and the next GRAM - 1 (null beyond the end), with their hash."""
    rows = df.select(*keep, array, F.posexplode_outer(array).alias(at, "__w0"))
    rows = rows.select(*keep, at, "__w0", *[F.get(array, F.col(at) + i).alias(f"__w{i}") for i in range(1, GRAM)])
    return rows.withColumn("__hash", F.xxhash64(*[f"__w{i}" for i in range(GRAM)]))


def template_grams(spark: SparkSession, base: list[tuple[str, str]], templates: list[tuple[str, str]]) -> DataFrame:
    """tid, label, exact, n_grams, tpos and the words of each template gram: as many rows as the templates have words."""
    listed = [(label, text, True) for label, text in base] + [(label, text, False) for label, text in templates]
    if short := [text for _, text, _ in listed if len(text.split()) < GRAM]:
        raise ValueError(f"templates of fewer than {GRAM} words: {short}")
    entries = F.array(*[F.struct(F.lit(i).alias("tid"), F.lit(label).alias("label"), F.lit(exact).alias("exact"), F.lit(text).alias("text")) for i, (label, text, exact) in enumerate(listed)])
    rows = spark.range(1).select(F.explode(entries).alias("t")).select("t.*").withColumn("words", words(F.col("text")))
    rows = rows.withColumn("n_grams", F.size("words") - (GRAM - 1))
    return _grams(rows, "words", "tpos", "tid", "label", "exact", "n_grams").where(F.col("tpos") < F.col("n_grams"))


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", base: list[tuple[str, str]] = BASE, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """A row for each merged span (row, key, n_words, label, exact, first, last, votes, coverage, density, verified), and one without a label for each document.

    first and last are the word numbers of the span's first and last word.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"), by_name(docs, key).alias("key"), words(by_name(docs, text)).alias("words"))
    rows = _grams(source.withColumn("n_words", F.size("words").cast("long")), "words", "pos", "row", "key", "n_words")
    grams = F.broadcast(template_grams(docs.sparkSession, base, templates).alias("t"))
    same = [F.col(f"d.__w{i}") == F.col(f"t.__w{i}") for i in range(1, GRAM)]
    met = F.col("d.__hash") == F.col("t.__hash")
    for s in [F.col("d.__w0") == F.col("t.__w0"), *same]:
        met = met & s
    votes = rows.alias("d").join(grams, met, "left").where(F.col("tid").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0))
    votes = votes.select("row", "key", "n_words", "tid", "label", "exact", "n_grams", "pos", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal"))
    # counted before the shuffle, and then by document and template: a long document is no single task
    lines = votes.groupBy("row", "key", "n_words", "tid", "label", "exact", "n_grams", "diagonal").agg(
        F.count("tid").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("tpos").alias("met"))
    before = Window.partitionBy("row", "tid").orderBy("diagonal")
    apart = F.coalesce(F.col("exact"), F.lit(True)) | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(before) > DRIFT, F.lit(True))
    islands = lines.withColumn("apart", apart.cast("int")).withColumn("island", F.sum("apart").over(before))
    spans = islands.groupBy("row", "key", "n_words", "tid", "label", "exact", "n_grams", "island").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), (F.max("last") + GRAM - 1).alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("met")))).alias("met"))
    spans = spans.withColumn("coverage", F.col("met") / F.col("n_grams")).withColumn("density", F.least(F.lit(1.0), F.col("votes") / (F.col("last") - F.col("first") - (GRAM - 2))))
    verified = F.when(F.col("exact"), F.col("met") == F.col("n_grams")).otherwise((F.col("coverage") >= COVERAGE) & (F.col("density") >= DENSITY))
    return spans.withColumn("verified", F.coalesce(verified, F.lit(False)))


def op3_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("verified") & F.col("exact")
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return spans.groupBy("row", "key", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("verified"), F.col("label"))).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
    ).select(F.col("key").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


_LISTED = ", ".join(f"({i}, '{label}', {exact}, '{text}')" for i, (label, text, exact) in enumerate([(*x, True) for x in BASE] + [(*x, False) for x in TEMPLATES]))

OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
t AS (SELECT tid, label, exact, string_split(text, ' ') AS w FROM (VALUES {_LISTED}) v(tid, label, exact, text)),
tg AS (SELECT tid, label, exact, len(w) - 2 AS n_grams, i AS tpos, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM (SELECT *, unnest(range(0, len(w) - 2)) AS i FROM t)),
dg AS (SELECT r, i AS pos, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM (SELECT r, w, unnest(range(0, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
votes AS (SELECT r, tid, label, exact, n_grams, pos, tpos, pos - tpos AS diagonal FROM dg JOIN tg USING (a, b, c)),
lines AS (SELECT *, CASE WHEN exact THEN diagonal ELSE sum(apart) OVER (PARTITION BY r, tid ORDER BY diagonal) END AS island
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, tid ORDER BY diagonal) <= {DRIFT} THEN 0 ELSE 1 END AS apart
        FROM (SELECT DISTINCT r, tid, exact, diagonal FROM votes))),
spans AS (
  SELECT r, tid, label, exact, island, count(DISTINCT tpos) / n_grams AS coverage, min(pos) AS first,
         least(1.0, count(*) / (max(pos) - min(pos) + 1)) AS density
  FROM votes JOIN lines USING (r, tid, exact, diagonal) GROUP BY r, tid, label, exact, island, n_grams),
v AS (SELECT *, CASE WHEN exact THEN coverage = 1 ELSE coverage >= {COVERAGE} AND density >= {DENSITY} END AS verified FROM spans),
g AS (
  SELECT r, count(*) FILTER (verified AND exact) AS n_base, min(first) FILTER (verified AND exact) AS first_word, max(first) FILTER (verified AND exact) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (verified AND exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (verified) AS labels, max(coverage) AS score
  FROM v GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN g USING (r)
"""

"""Queries on two editions. Their stand-ins: parts of even and of odd key, in sections by brand; links by similarity of names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.similarity import jaro_winkler_of
from foliospark.operators import alignment as A
from foliospark.operators import links as L
from foliospark.operators import sections as S
from foliospark.plans.line_queries import ENTITIES_SQL, entities_of, read


def edition(spark: SparkSession, sf_dir: str, odd: int) -> DataFrame:
    """volume, segment, order, uuid, name, text, section, section_uuid."""
    p = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type").where(F.col("p_partkey") % 2 == odd)
    return p.select(F.lit("v").alias("volume"), F.col("p_brand").alias("segment"), F.col("p_partkey").alias("order"), F.col("p_partkey").cast("string").alias("uuid"), F.col("p_name").alias("name"), F.concat_ws(" ", "p_name", "p_type", F.lpad((F.col("p_partkey") / 2).cast("long").cast("string"), 5, "0")).alias("text"), F.col("p_type").alias("section"), F.col("p_brand").alias("section_uuid"))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(segment, i, a) of the left and (segment, j, b) of the right edition; records without a name make no pairs."""
    side = lambda odd, at, name: edition(spark, sf_dir, odd).select("segment", F.col("order").alias(at), F.col("name").alias(name)).where(F.col(name).isNotNull())
    return side(0, "i", "a"), side(1, "j", "b")


def _known(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b, sim: each two names that meet in a segment, compared once."""
    names = left.select("segment", "a").distinct().join(right.select("segment", "b").distinct(), "segment").select("a", "b").distinct()
    return names.withColumn("sim", F.round(jaro_winkler_of(F.lower("a"), F.lower("b")), 6))


def pairs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segment, i, j, sim: every pair inside a segment; each two names are compared once."""
    left, right = _sides(spark, sf_dir)
    return L.pairs_by_name(left, right, _known(left, right))


def first_pairs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of pairs_of those of the first record of each name. As ties go to the smallest index, all mutual best pairs are among them."""
    left, right = _sides(spark, sf_dir)
    known = _known(left, right)
    left, right = left.groupBy("segment", "a").agg(F.min("i").alias("i")), right.groupBy("segment", "b").agg(F.min("j").alias("j"))
    return left.join(right, "segment").join(known, ["a", "b"]).select("segment", "i", "j", "sim")


_SIDES = """l AS (SELECT p_brand AS segment, p_partkey AS i, p_name AS a, p_type AS section FROM part WHERE p_partkey % 2 = 0),
r AS (SELECT p_brand AS segment, p_partkey AS j, p_name AS b, p_type AS section FROM part WHERE p_partkey % 2 = 1)"""
PAIRS_SQL = _SIDES + """,
pairs AS (SELECT segment, i, j, round(jaro_winkler_similarity(lower(a), lower(b)), 6) AS sim FROM l JOIN r USING (segment))"""
BEST_SQL = PAIRS_SQL + """,
best AS (SELECT *, row_number() OVER (PARTITION BY segment, i ORDER BY sim DESC, j) AS of_i, row_number() OVER (PARTITION BY segment, j ORDER BY sim DESC, i) AS of_j FROM pairs),
mutual AS (SELECT segment, i, j, sim FROM best WHERE of_i = 1 AND of_j = 1)"""


def links_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between neighbouring keys of the same segment number: left k, right k + 1, where k is divisible by 6 or 10."""
    left, right = edition(spark, sf_dir, 0), edition(spark, sf_dir, 1)
    l = left.where((F.col("order") % 6 == 0) | (F.col("order") % 10 == 0)).select("volume", "order", F.col("uuid").alias("left_uuid"))  # noqa: E741
    met = l.join(right.select("volume", (F.col("order") - 1).alias("order"), F.col("uuid").alias("right_uuid")), ["volume", "order"])
    source = F.when(F.col("order") % 4 == 0, A.ORDERED).when(F.col("order") % 3 == 0, A.CONTEXT).otherwise(A.RESIDUAL)
    return met.select("volume", "left_uuid", "right_uuid", ((F.col("order") % 100) / 200 + 0.5).alias("score"), source.alias("source"))


LINKS_SQL = """links AS (
  SELECT CAST(a.p_partkey AS VARCHAR) AS left_uuid, CAST(b.p_partkey AS VARCHAR) AS right_uuid, (a.p_partkey % 100) / 200 + 0.5 AS score,
    CASE WHEN a.p_partkey % 4 = 0 THEN 'nw' WHEN a.p_partkey % 3 = 0 THEN 'nw-contexte' ELSE 'nw-residuel' END AS source
  FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1 WHERE a.p_partkey % 2 = 0 AND (a.p_partkey % 6 = 0 OR a.p_partkey % 10 = 0))"""


def patch_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hand-made patch with contradictions: line, left_uuid, right_uuid, certitude."""
    p = read(spark, sf_dir, "part", "p_partkey").where(F.col("p_partkey") % 7 == 0)
    k = F.col("p_partkey")
    even = k - k % 2
    return p.select((k / 7 + 2).cast("long").alias("line"), F.when(k % 5 != 1, even.cast("string")).otherwise("").alias("left_uuid"), F.when(k % 3 != 1, (even + F.when(k % 4 < 2, 1).otherwise(3)).cast("string")).otherwise("").alias("right_uuid"), F.when(k % 11 == 0, "Incertaine").when(k % 13 == 0, "vue").otherwise("").alias("certitude"))


PATCH_SQL = """patch AS (
  SELECT CAST(k / 7 + 2 AS BIGINT) AS line, CASE WHEN k % 5 <> 1 THEN CAST(k - k % 2 AS VARCHAR) ELSE '' END AS left_uuid,
    CASE WHEN k % 3 <> 1 THEN CAST(k - k % 2 + CASE WHEN k % 4 < 2 THEN 1 ELSE 3 END AS VARCHAR) ELSE '' END AS right_uuid,
    CASE WHEN k % 11 = 0 THEN 'Incertaine' WHEN k % 13 = 0 THEN 'vue' ELSE '' END AS certitude
  FROM (SELECT p_partkey AS k FROM part WHERE p_partkey % 7 = 0))"""


def similarity_pairs(spark, sf_dir):
    return pairs_of(spark, sf_dir)


def candidates_mutual_best(spark, sf_dir):
    taken = edition(spark, sf_dir, 0).where(F.col("order") % 5 == 0).select("segment", F.col("order").alias("i"))
    other = edition(spark, sf_dir, 1).where(F.col("order") % 9 == 0).select("segment", F.col("order").alias("j"))
    return L.candidates(first_pairs_of(spark, sf_dir), taken, other, 0.5, 0.95)


def rival_margin(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return L.rivals_by_name(left, right, _known(left, right))


def review_levels(spark, sf_dir):
    linked = links_of(spark, sf_dir).withColumn("sim", F.col("score")).withColumn("rival", F.round(F.col("score") - (F.col("left_uuid").cast("long") % 8) / 64, 6))
    return L.review(linked).select("left_uuid", "right_uuid", F.concat_ws(" | ", "reasons").alias("reasons"), "level")


def patch_validate(spark, sf_dir):
    return L.validate(patch_of(spark, sf_dir)).select("problem", "side", "uuid", F.array_join(F.col("lines").cast("array<string>"), ",").alias("lines"))


def section_patch_validate(spark, sf_dir):
    return L.validate_sections(patch_of(spark, sf_dir)).select("problem", "side", "uuid", F.array_join(F.col("lines").cast("array<string>"), ",").alias("lines"))


def patch_apply(spark, sf_dir):
    return L.apply_patch(links_of(spark, sf_dir), patch_of(spark, sf_dir).dropDuplicates(["left_uuid", "right_uuid"]).drop("line"))


def patch_stats(spark, sf_dir):
    return L.patch_stats(links_of(spark, sf_dir), patch_of(spark, sf_dir))


def patch_reanchor(spark, sf_dir):
    """Lines that name records of an earlier run, whose uuids had an x; section and text tell them again."""
    every = edition(spark, sf_dir, 0).withColumn("side", F.lit("left")).unionByName(edition(spark, sf_dir, 1).withColumn("side", F.lit("right")))
    records = every.select("side", "uuid", F.col("segment").alias("section"), F.col("name").alias("text"))
    gone = every.where(F.col("order") % 3 == 0).select((F.col("order") + 2).alias("line"), "side", F.when(F.col("order") % 2 == 0, F.concat(F.lit("x"), "uuid")).otherwise(F.col("uuid")).alias("uuid"), F.col("segment").alias("section"), F.col("name").alias("text"))
    return L.reanchor(gone, records)


def links_restrict(spark, sf_dir):
    left, right = edition(spark, sf_dir, 0), edition(spark, sf_dir, 1)
    pairs = left.select(F.col("section_uuid").alias("left_section")).distinct().withColumn("right_section", F.col("left_section")).union(left.where(F.length("section_uuid") == 7).select("section_uuid", F.concat("section_uuid", F.lit("1"))).distinct())
    extra = links_of(spark, sf_dir).select(F.concat(F.lit("gone"), "left_uuid").alias("left_uuid"), "right_uuid", "score", "source")
    links = links_of(spark, sf_dir).select("left_uuid", "right_uuid", "score", "source").unionByName(extra)
    return L.restrict(links, left, right, pairs)


def join_natural(spark, sf_dir):
    left, right = edition(spark, sf_dir, 0), edition(spark, sf_dir, 1)
    links = links_of(spark, sf_dir)
    by_segment = lambda df: df.withColumn("volume", F.col("segment"))
    own = links.join(left.select(F.col("uuid").alias("left_uuid"), "segment"), "left_uuid").withColumn("volume", F.col("segment")).drop("segment")
    out = L.natural_join(own, by_segment(left), by_segment(right))
    return out.withColumn("kind", L.joined_kind(F.col("left_uuid"), F.col("right_uuid"), F.col("source")))


def link_summary(spark, sf_dir):
    return A.summary(links_of(spark, sf_dir)).withColumn("mean", F.round("mean", 9))


def link_agreement(spark, sf_dir):
    other = links_of(spark, sf_dir).withColumn("right_uuid", F.when(F.col("left_uuid").cast("long") % 4 == 0, F.concat("right_uuid", F.lit("0"))).otherwise(F.col("right_uuid"))).where(F.col("left_uuid").cast("long") % 18 != 0)
    return A.agreement(links_of(spark, sf_dir), other)


def inversions(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    ordered = edition(spark, sf_dir, 0).where(F.col("order") % 6 == 0).select("segment", F.col("order").alias("i"), (F.col("order") + 1).alias("j"))
    return L.inversions_by_name(left.where(F.col("i") % 6 != 0), right.where(F.col("j") % 6 != 1), _known(left, right), ordered)


def section_runs(spark, sf_dir):
    return S.sections(edition(spark, sf_dir, 0).withColumn("section_uuid", F.lit("s")))


def section_continuation(spark, sf_dir):
    records = edition(spark, sf_dir, 0).withColumn("section_uuid", F.when(F.col("order") % 12 == 0, "").otherwise(F.concat(F.lit("u"), "uuid"))).withColumn("section_inserted", F.col("order") % 10 != 0)
    return S.continue_sections(records).select("order", "section", "section_uuid")


def section_groups(spark, sf_dir):
    pairs = read(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey").select(F.concat(F.lit("p"), "l_partkey").alias("left_uuid"), F.concat(F.lit("s"), (F.col("l_partkey") / 40).cast("long") * 100 + F.col("l_suppkey") % 3).alias("right_uuid"))
    return S.manual_groups(pairs)


def ancestor_section(spark, sf_dir):
    return S.ancestors(entities_of(spark, sf_dir))


def section_alignment(spark, sf_dir):
    """Sections of two editions by their keys, one pair of volumes for each nation: customers of even and of odd key."""
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    side = lambda odd: c.where(F.col("c_custkey") % 2 == odd).select(F.col("c_nationkey").alias("pair"), F.col("c_custkey").alias("run"), F.col("c_mktsegment").alias("section"), F.lit("u").alias("section_uuid"))
    return S.align_sections(side(0), side(1))


def _records(spark, sf_dir, odd):
    return edition(spark, sf_dir, odd).select("segment", "order", "uuid", F.col("name").alias("subj"), "text")


def ordered_links(spark, sf_dir):
    return A.align(_records(spark, sf_dir, 0), _records(spark, sf_dir, 1), A.Params(context=False))[0]


def contextual_links(spark, sf_dir):
    return A.align(_records(spark, sf_dir, 0), _records(spark, sf_dir, 1))[0]


def two_years(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two editions of all parts: segment, order, uuid, section, subj, text.

    The later one lacks every eleventh part, has others with a letter or a number changed, and parts of a third at another
    place. Brands 11 to 14 are one large section.
    """
    k, brand = F.col("p_partkey"), F.col("p_brand")
    own = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select(
        F.when(brand < "Brand#15", "large").otherwise(brand).alias("segment"), k.alias("k"), F.col("p_type").alias("section"), F.initcap("p_name").alias("subj"),
        F.concat_ws(", ", F.initcap("p_name"), F.lower("p_type"), F.concat(F.lit("rue "), F.element_at(F.split("p_name", " "), -1)), F.concat((k % 400 + 1).cast("string"), F.lit("."))).alias("text"))
    first = own.select("segment", F.col("k").alias("order"), F.concat(F.lit("a"), F.col("k").cast("string")).alias("uuid"), "section", "subj", "text")
    changed = F.when(F.col("k") % 3 == 0, F.regexp_replace("text", "e", "é")).when(F.col("k") % 5 == 0, F.regexp_replace("text", r"\d+\.$", "9.")).otherwise(F.col("text"))
    moved = F.col("k") + F.when(F.col("k") % 37 == 0, 500).otherwise(0)
    later = own.where(F.col("k") % 11 != 0).select("segment", moved.alias("order"), F.concat(F.lit("b"), F.col("k").cast("string")).alias("uuid"), "section", "subj", changed.alias("text"))
    return first, later


def editions_aligned(spark, sf_dir):
    """All links of two editions, the largest section of some thousands by some thousands records at scale 0.1."""
    links = A.align(*two_years(spark, sf_dir))[0]
    return links.select("segment", "left_uuid", "right_uuid", F.round(F.col("score").cast("double"), 4).alias("score"), "source")


QUERIES = {f.__name__: f for f in (similarity_pairs, candidates_mutual_best, rival_margin, review_levels, patch_validate, section_patch_validate, patch_apply, patch_stats, patch_reanchor, links_restrict, join_natural, link_summary, link_agreement, inversions, section_runs, section_continuation, section_groups, ancestor_section, section_alignment, ordered_links, contextual_links, editions_aligned)}

_U = "SELECT line, 'left' AS side, left_uuid AS uuid, left_uuid <> '' AND right_uuid <> '' AS paired FROM patch WHERE left_uuid <> '' UNION ALL SELECT line, 'right', right_uuid, left_uuid <> '' AND right_uuid <> '' FROM patch WHERE right_uuid <> ''"

SQL = {
    "similarity_pairs": f"WITH {PAIRS_SQL} SELECT * FROM pairs",
    "candidates_mutual_best": f"WITH {BEST_SQL} SELECT * FROM mutual WHERE sim >= 0.5 AND sim < 0.95 AND i % 5 <> 0 AND j % 9 <> 0",
    "rival_margin": f"""WITH {BEST_SQL}
SELECT segment, i, j, sim, greatest(CASE WHEN ri = 1 THEN coalesce(si, 0) ELSE mi END, CASE WHEN rj = 1 THEN coalesce(sj, 0) ELSE mj END) AS rival FROM (
  SELECT *, max(sim) OVER (PARTITION BY segment, i) AS mi, max(sim) OVER (PARTITION BY segment, j) AS mj,
    row_number() OVER (PARTITION BY segment, i ORDER BY sim DESC, j DESC) AS ri, nth_value(sim, 2) OVER (PARTITION BY segment, i ORDER BY sim DESC, j DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS si,
    row_number() OVER (PARTITION BY segment, j ORDER BY sim DESC, i DESC) AS rj, nth_value(sim, 2) OVER (PARTITION BY segment, j ORDER BY sim DESC, i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS sj
  FROM pairs)""",
    "review_levels": f"""WITH {LINKS_SQL},
t AS (SELECT *, CASE WHEN source = 'nw-contexte' AND score < 0.9 THEN 'déduite des voisines (p < 0,9)' END AS a, CASE WHEN source IN ('nw', 'nw-residuel') AND score - round(score - (CAST(left_uuid AS BIGINT) % 8) / 64, 6) < 0.05 THEN 'homonyme proche' END AS b FROM links)
SELECT left_uuid, right_uuid, concat_ws(' | ', a, b) AS reasons, CASE WHEN a IS NULL AND b IS NULL THEN 0 WHEN a IS NOT NULL AND score < 0.7 THEN 2 ELSE 1 END AS level FROM t""",
    "patch_validate": f"""WITH {PATCH_SQL}, u AS ({_U})
SELECT 'no uuid' AS problem, '' AS side, '' AS uuid, CAST(line AS VARCHAR) AS lines FROM patch WHERE left_uuid = '' AND right_uuid = ''
UNION ALL SELECT 'certainty', '', certitude, CAST(line AS VARCHAR) FROM patch WHERE certitude <> '' AND lower(certitude) <> 'incertaine'
UNION ALL SELECT 'uuid on several lines', side, uuid, string_agg(line, ',' ORDER BY line) FROM u GROUP BY side, uuid HAVING count(*) > 1""",
    "section_patch_validate": f"""WITH {PATCH_SQL}, u AS ({_U})
SELECT 'no uuid' AS problem, '' AS side, '' AS uuid, CAST(line AS VARCHAR) AS lines FROM patch WHERE left_uuid = '' AND right_uuid = ''
UNION ALL SELECT 'pair twice', '', left_uuid || ' ' || right_uuid, string_agg(line, ',' ORDER BY line) FROM patch WHERE left_uuid <> '' AND right_uuid <> '' GROUP BY left_uuid, right_uuid HAVING count(*) > 1
UNION ALL SELECT 'alone twice', side, uuid, string_agg(line, ',' ORDER BY line) FROM u WHERE NOT paired GROUP BY side, uuid HAVING count(*) > 1
UNION ALL SELECT 'paired and alone', side, uuid, string_agg(line, ',' ORDER BY paired DESC, line) FROM u GROUP BY side, uuid HAVING bool_or(paired) AND bool_or(NOT paired)""",
    "patch_apply": f"""WITH {LINKS_SQL}, {PATCH_SQL},
p AS (SELECT left_uuid, right_uuid, min(certitude) AS certitude FROM patch GROUP BY ALL)
SELECT left_uuid, right_uuid, score, source FROM links WHERE left_uuid NOT IN (SELECT left_uuid FROM patch WHERE left_uuid <> '') AND right_uuid NOT IN (SELECT right_uuid FROM patch WHERE right_uuid <> '')
UNION ALL SELECT p.left_uuid, p.right_uuid, score, CASE WHEN lower(certitude) = 'incertaine' THEN 'manuel-incertain' ELSE 'manuel' END FROM p LEFT JOIN links USING (left_uuid, right_uuid) WHERE p.left_uuid <> '' AND p.right_uuid <> ''""",
    "patch_stats": f"""WITH {LINKS_SQL}, {PATCH_SQL},
k AS (SELECT count(*) AS n FROM links WHERE left_uuid NOT IN (SELECT left_uuid FROM patch WHERE left_uuid <> '') AND right_uuid NOT IN (SELECT right_uuid FROM patch WHERE right_uuid <> '')),
v AS (SELECT count(*) AS n FROM patch JOIN links USING (left_uuid, right_uuid))
SELECT CAST((SELECT count(*) FROM links) - k.n - v.n AS BIGINT) AS overridden, (SELECT count(*) FROM patch WHERE left_uuid <> '' AND right_uuid <> '') AS manual_pairs,
  (SELECT count(*) FROM patch WHERE left_uuid <> '' AND right_uuid = '') AS unmatched_left, (SELECT count(*) FROM patch WHERE left_uuid = '' AND right_uuid <> '') AS unmatched_right FROM k, v""",
    "patch_reanchor": """WITH records AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'left' ELSE 'right' END AS side, CAST(p_partkey AS VARCHAR) AS uuid, p_brand AS section, p_name AS text, p_partkey AS k FROM part),
gone AS (SELECT k + 2 AS line, side, CASE WHEN k % 2 = 0 THEN 'x' || uuid ELSE uuid END AS uuid, section, text FROM records WHERE k % 3 = 0),
free AS (SELECT side, section, text, min(uuid) AS new_uuid FROM records WHERE (side, uuid) NOT IN (SELECT (side, uuid) FROM gone) GROUP BY ALL HAVING count(*) = 1),
met AS (SELECT g.*, new_uuid, (g.side, g.uuid) NOT IN (SELECT (side, uuid) FROM records) AS lost FROM gone g LEFT JOIN free USING (side, section, text)),
n AS (SELECT *, row_number() OVER (PARTITION BY side, new_uuid, lost ORDER BY line) AS nth FROM met)
SELECT line, side, uuid, CASE WHEN NOT lost THEN 'found' WHEN new_uuid IS NOT NULL AND nth = 1 THEN 'reanchored' ELSE 'orphan' END AS state, CASE WHEN NOT lost THEN uuid WHEN new_uuid IS NOT NULL AND nth = 1 THEN new_uuid END AS now_uuid FROM n""",
    "links_restrict": f"""WITH {LINKS_SQL},
every AS (FROM links UNION ALL SELECT 'gone' || left_uuid, right_uuid, score, source FROM links),
b AS (SELECT DISTINCT p_brand AS s FROM part WHERE p_partkey % 2 = 0),
c AS (SELECT s AS l, s AS r FROM b UNION SELECT s, s || '1' FROM b WHERE length(s) = 7)
SELECT e.*, coalesce((a.p_brand, z.p_brand) IN (SELECT (l, r) FROM c), true) OR a.p_brand IS NULL OR z.p_brand IS NULL AS kept
FROM every e LEFT JOIN part a ON CAST(a.p_partkey AS VARCHAR) = e.left_uuid LEFT JOIN part z ON CAST(z.p_partkey AS VARCHAR) = e.right_uuid""",
    "join_natural": f"""WITH {LINKS_SQL},
lft AS (SELECT p_brand AS volume, CAST(p_partkey AS VARCHAR) AS left_uuid, p_partkey AS lo FROM part WHERE p_partkey % 2 = 0),
rgt AS (SELECT p_brand AS volume, CAST(p_partkey AS VARCHAR) AS right_uuid, p_partkey AS ro FROM part WHERE p_partkey % 2 = 1),
keep AS (SELECT volume, left_uuid, right_uuid, lo, score, source FROM links JOIN lft USING (left_uuid) JOIN rgt USING (volume, right_uuid)),
one AS (SELECT l.volume, l.lo AS place, 1 AS side, 0 AS n, l.left_uuid, right_uuid, score, source FROM lft l LEFT JOIN keep k USING (volume, left_uuid)),
placed AS (SELECT r.volume, r.right_uuid, r.ro, k.lo, last_value(k.lo IGNORE NULLS) OVER (PARTITION BY r.volume ORDER BY ro) AS anchor, first_value(k.lo IGNORE NULLS) OVER (PARTITION BY r.volume ORDER BY ro ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f FROM rgt r LEFT JOIN keep k USING (volume, right_uuid)),
two AS (SELECT volume, coalesce(anchor, f, 4611686018427387904) AS place, CASE WHEN anchor IS NULL AND f IS NOT NULL THEN 0 ELSE 2 END AS side, ro AS n, NULL AS left_uuid, right_uuid, NULL AS score, NULL AS source FROM placed WHERE lo IS NULL),
every AS (FROM one UNION ALL FROM two)
SELECT volume, CAST(row_number() OVER (PARTITION BY volume ORDER BY place, side, n) AS INTEGER) AS rank, left_uuid, right_uuid, score, source, CASE WHEN left_uuid IS NULL THEN 'right' WHEN right_uuid IS NULL THEN 'left' ELSE 'pair' END AS kind FROM every""",
    "link_summary": f"WITH {LINKS_SQL} SELECT source, count(*) AS links, min(score) AS lowest, round(avg(score), 9) AS mean, CAST(count_if(score >= 0.5 AND score < 0.7) AS BIGINT) AS from_50, CAST(count_if(score >= 0.7 AND score < 0.8) AS BIGINT) AS from_70, CAST(count_if(score >= 0.8 AND score < 0.9) AS BIGINT) AS from_80, CAST(count_if(score >= 0.9 AND score < 1.01) AS BIGINT) AS from_90 FROM links GROUP BY source",
    "link_agreement": f"""WITH {LINKS_SQL},
a AS (SELECT left_uuid, right_uuid FROM links),
b AS (SELECT left_uuid, CASE WHEN CAST(left_uuid AS BIGINT) % 4 = 0 THEN right_uuid || '0' ELSE right_uuid END AS right_uuid FROM links WHERE CAST(left_uuid AS BIGINT) % 18 <> 0),
x AS (FROM a EXCEPT FROM b), y AS (FROM b EXCEPT FROM a)
SELECT (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS both, (SELECT count(*) FROM x) AS only_first, (SELECT count(*) FROM y) AS only_second, (SELECT count(DISTINCT left_uuid) FROM x WHERE left_uuid IN (SELECT left_uuid FROM y)) AS conflicts""",
    "inversions": f"""WITH {PAIRS_SQL},
o AS (SELECT segment, i, i + 1 AS j FROM l WHERE i % 6 = 0),
c AS (SELECT p.*, abs((SELECT count(*) FROM o WHERE o.segment = p.segment AND o.i < p.i) - (SELECT count(*) FROM o WHERE o.segment = p.segment AND o.j < p.j)) AS crossed FROM pairs p WHERE i % 6 <> 0 AND j % 6 <> 1),
b AS (SELECT *, row_number() OVER (PARTITION BY segment, i ORDER BY sim DESC, j) AS nth FROM c WHERE crossed > 0)
SELECT segment, i, j, sim, CAST(crossed AS INTEGER) AS crossed FROM b WHERE nth = 1 AND sim >= 0.6""",
    "section_runs": """WITH a AS (SELECT p_partkey AS o, p_type AS section, CASE WHEN p_type = lag(p_type) OVER (ORDER BY p_partkey) THEN 0 ELSE 1 END AS brk FROM part WHERE p_partkey % 2 = 0),
b AS (SELECT *, sum(brk) OVER (ORDER BY o) - 1 AS run FROM a)
SELECT 'v' AS volume, CAST(run AS BIGINT) AS run, 's' AS section_uuid, section, min(o) AS first, max(o) AS last, count(*) AS entries FROM b GROUP BY run, section""",
    "section_continuation": """WITH a AS (SELECT p_partkey AS o, p_type AS section, CASE WHEN p_partkey % 12 = 0 THEN '' ELSE 'u' || p_partkey END AS u, p_partkey % 10 <> 0 AS ins FROM part WHERE p_partkey % 2 = 0),
b AS (SELECT *, CASE WHEN ins AND coalesce(lag(u) OVER w, '') <> '' AND section = lag(section) OVER w THEN 0 ELSE 1 END AS brk FROM a WINDOW w AS (ORDER BY o)),
c AS (SELECT *, sum(brk) OVER (ORDER BY o) AS run FROM b)
SELECT o AS "order", section, first_value(u) OVER (PARTITION BY run ORDER BY o) AS section_uuid FROM c""",
    "section_groups": """WITH RECURSIVE e AS (SELECT DISTINCT 'p' || l_partkey AS l, 's' || (CAST(l_partkey // 40 AS BIGINT) * 100 + l_suppkey % 3) AS r FROM lineitem),
h AS (SELECT DISTINCT a.l AS a, b.l AS b FROM e a JOIN e b USING (r)),
reach(a, b) AS (SELECT a, b FROM h UNION SELECT reach.a, h.b FROM reach JOIN h ON reach.b = h.a),
g AS (SELECT a AS l, min(b) AS g FROM reach GROUP BY a)
SELECT 'left' AS side, l AS uuid, g AS "group" FROM g UNION SELECT DISTINCT 'right', r, g FROM e JOIN g USING (l)""",
    "ancestor_section": f"""WITH RECURSIVE {ENTITIES_SQL},
up(document, uuid, node, depth) AS (
  SELECT document, uuid, parent_uuid, 0 FROM entities
  UNION ALL SELECT up.document, up.uuid, t.parent_uuid, depth + 1 FROM up JOIN entities t ON t.document = up.document AND t.uuid = up.node AND t.entity = 'TITLE'),
met AS (SELECT up.document, up.uuid, t.uuid AS s, t.markdown AS m, depth, length(regexp_extract(t.markdown, '^\\s*(#+)', 1)) AS level FROM up JOIN entities t ON t.document = up.document AND t.uuid = up.node AND t.entity = 'TITLE'),
best AS (SELECT *, row_number() OVER (PARTITION BY document, uuid ORDER BY level DESC, depth) AS nth FROM met WHERE level IN (1, 2))
SELECT e.document, e.uuid, s AS section_uuid, m AS section_markdown FROM entities e LEFT JOIN (FROM best WHERE nth = 1) b USING (document, uuid)""",
}

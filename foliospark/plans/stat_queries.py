"""Queries on evaluation, sampling and addresses. Gold labels are those of `labels`; predictions and scores are hashed from keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.shapes import coarse_shape, profile
from foliospark.operators import addresses as AD
from foliospark.operators import sampling as SA
from foliospark.operators import stats as ST
from foliospark.plans.line_queries import CLASSED_SQL, classed_lines, read


def _digit(c, at: int, n: int = 1):
    return F.conv(F.substring(F.md5(c.cast("string").cast("binary")), at, n), 16, 10).cast("int")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, gold, predicted, confidence, score, weight, page of each labelled document."""
    k = F.col("doc_id")
    rows = read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    gold = F.col("quality") * 2 + F.col("toxic")
    shifted = F.when(_digit(k, 1) < 4, (gold + 1) % 4).otherwise(gold)
    return rows.select(k.alias("id"), gold.cast("string").alias("gold"), shifted.cast("string").alias("predicted"), (_digit(k, 2, 2) / 256).alias("confidence"), ((_digit(k, 4, 2) + 64 * (gold % 2)) / 512).alias("score"), (1.0 + _digit(k, 6) % 3).alias("weight"), (F.floor(k / 20)).alias("page"), (F.col("toxic") == 1).alias("positive")).withColumn("correct", F.col("gold") == F.col("predicted")).withColumn("error", F.col("gold") != F.col("predicted"))


SCORED_SQL = """scored0 AS (SELECT doc_id AS id, quality * 2 + toxic AS g, md5(CAST(doc_id AS VARCHAR)) AS d, toxic FROM labels),
scored AS (
  SELECT id, CAST(g AS VARCHAR) AS gold, CAST(CASE WHEN CAST('0x' || substr(d, 1, 1) AS INTEGER) < 4 THEN (g + 1) % 4 ELSE g END AS VARCHAR) AS predicted, CAST('0x' || substr(d, 2, 2) AS INTEGER) / 256 AS confidence,
    (CAST('0x' || substr(d, 4, 2) AS INTEGER) + 64 * (g % 2)) / 512 AS score, 1.0::DOUBLE + CAST('0x' || substr(d, 6, 1) AS INTEGER) % 3 AS weight, CAST(floor(id / 20) AS BIGINT) AS page, toxic = 1 AS positive,
    CAST('0x' || substr(d, 1, 1) AS INTEGER) >= 4 AS correct, CAST('0x' || substr(d, 1, 1) AS INTEGER) < 4 AS error FROM scored0)"""


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, class, feature, value: four simple features of each line."""
    lines = classed_lines(spark, sf_dir)
    t = F.col("text")
    values = {"starts_lower": t.rlike("^[a-z]").cast("string"), "ends_point": t.endswith(".").cast("string"), "heading": t.startswith("#").cast("string"), "length": F.least(F.floor(F.length(t) / 50), F.lit(8)).cast("string")}
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("value")) for k, v in values.items()]))
    return lines.select(F.concat_ws("/", "document", "pos").alias("id"), "class", cells.alias("f")).select("id", "class", "f.*")


FEATURES_SQL = CLASSED_SQL + """,
features AS (
  SELECT document || '/' || pos AS id, class, unnest([{'feature': 'starts_lower', 'value': CAST(regexp_matches(text, '^[a-z]') AS VARCHAR)}, {'feature': 'ends_point', 'value': CAST(ends_with(text, '.') AS VARCHAR)}, {'feature': 'heading', 'value': CAST(starts_with(text, '#') AS VARCHAR)},
    {'feature': 'length', 'value': CAST(least(length(text) // 50, 8) AS VARCHAR)}], recursive := true) FROM classed)"""


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def confusion(spark, sf_dir):
    return ST.confusion(scored(spark, sf_dir), "page")


def class_f1(spark, sf_dir):
    return rounded(ST.per_class(scored(spark, sf_dir)))


def overall_scores(spark, sf_dir):
    return rounded(ST.overall(scored(spark, sf_dir)))


def calibration(spark, sf_dir):
    return rounded(ST.calibration(scored(spark, sf_dir)))


def calibration_error(spark, sf_dir):
    return rounded(ST.calibration_error(scored(spark, sf_dir)))


def auroc(spark, sf_dir):
    return rounded(ST.auroc(scored(spark, sf_dir)))


def review_capture(spark, sf_dir):
    return rounded(ST.review_capture(scored(spark, sf_dir), [0.01, 0.05, 0.1, 0.5], "confidence"))


def mutual_information(spark, sf_dir):
    return rounded(ST.information(line_features(spark, sf_dir)), 6)


def discriminative_values(spark, sf_dir):
    return rounded(ST.rules(line_features(spark, sf_dir), 3, 10), 6)


def redundancy(spark, sf_dir):
    return rounded(ST.redundancy(line_features(spark, sf_dir)), 6)


def flag_capture(spark, sf_dir):
    return rounded(ST.flags(scored(spark, sf_dir), [0.1, 0.25, 0.5, 0.9]))


def breakdown(spark, sf_dir):
    return rounded(ST.breakdown(scored(spark, sf_dir), "page", F.col("correct")))


def bootstrap_interval(spark, sf_dir):
    s = scored(spark, sf_dir)
    return rounded(ST.bootstrap(s, "page", {"good": F.col("weight") * F.col("correct").cast("double"), "all": F.col("weight")}, {"exactness": ST.ratio(F.col("good"), F.col("all"), None)}, 200))


def stratified_sample(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "source").withColumn("source", F.coalesce("source", F.lit("")))
    counts = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    quotas = SA.root_quotas(counts, max(1, sum(counts.values()) // 4))
    frame = docs.sparkSession.createDataFrame(sorted(quotas.items()), "source string, quota int")
    return SA.draw(docs, "source", frame, "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("weight"), 6).alias("weight"))


def page_split(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "source")
    return docs.select("doc_id", SA.split_by(F.concat_ws("#", "source", "doc_id"), 0.3).alias("split"))


def page_folds(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "source")
    return SA.page_folds(docs.select(F.col("source").alias("document"), F.col("doc_id").alias("page")))


def text_exclusion(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "n_chars").select(F.col("doc_id").alias("id"), "text", (F.col("n_chars") % 5 != 0).alias("usable"))
    gold = docs.where(F.col("id") % 11 == 0).select("text")
    return SA.training_texts(docs, gold).select("id", "state")


def inversion_strata(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem", "l_partkey", "l_discount", "l_orderkey", "l_linenumber").select((F.col("l_partkey") % 70 + 1).alias("crossed"), (0.6 + F.col("l_discount") * 4).alias("sim"))
    return rows.groupBy(SA.band(F.col("crossed")).alias("displacement"), SA.similarity_band(F.col("sim")).alias("similarity")).agg(F.count(F.lit(1)).alias("n"))


def addresses_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of customers in two years: most alike, some with another number, another street, or of another kind."""
    k = F.col("c_custkey")
    streets = F.array(*[F.lit(s) for s in STREETS])
    number = (k % 97 + 1).cast("string")
    first = F.when(k % 23 == 0, "").when(k % 19 == 0, F.concat(F.get(streets, (k % len(STREETS)).cast("int")), F.lit(", 1 et "), number)).when(k % 17 == 0, F.concat(F.get(streets, (k % len(STREETS)).cast("int")), F.lit("."))).otherwise(F.concat(F.get(streets, (k % len(STREETS)).cast("int")), F.lit(", "), number, F.lit(".")))
    second = F.concat(F.get(streets, ((k + F.when(k % 7 == 0, 1).otherwise(0)) % len(STREETS)).cast("int")), F.lit(", "), (k % 97 + F.when(k % 5 == 0, 3).otherwise(1)).cast("string"), F.lit("."))
    return read(spark, sf_dir, "customer", "c_custkey", "c_nationkey").select(k.alias("id"), F.col("c_nationkey").alias("nation"), first.alias("a"), second.alias("b"))


STREETS = ["rue du Faub.-S.-Laurent", "r. Basse-du-Rempart", "rue des Bourdonnais", "quai des Orfevres", "rue de Clery", "pl. Vendome", "boul. du Temple", "rue du Mail"]
_LIST = "[" + ", ".join(f"'{s}'" for s in STREETS) + "]"


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = addresses_of(spark, sf_dir)
    for s in ("a", "b"):
        rows = rows.withColumn(f"kind_{s}", AD.kind(F.col(s))).withColumn(f"street_{s}", AD.street(F.col(s))).withColumn(f"numbers_{s}", AD.numbers(F.col(s)))
    return rows


def address_kinds(spark, sf_dir):
    rows = typed(spark, sf_dir)
    return rows.select("id", "kind_a", "street_a", F.array_join(F.col("numbers_a").cast("array<string>"), "-").alias("numbers_a"), AD.substituted(F.col("numbers_a"), F.col("numbers_b")).alias("substituted"), AD.name_within(F.col("street_a"), F.col("street_b")).alias("within"))


def changed(spark, sf_dir):
    rows = typed(spark, sf_dir)
    c = [F.col(f"{n}_{s}") for s in ("a", "b") for n in ("kind", "street", "numbers")]
    return rows.withColumn("change", AD.change(*c)).withColumn("consolidated", AD.consolidated(F.col("change"), F.col("a"), F.col("b")))


def address_changes(spark, sf_dir):
    return changed(spark, sf_dir).select("id", "change", "consolidated")


def change_margins(spark, sf_dir):
    """Cross table of nations and changes with margins."""
    return changed(spark, sf_dir).cube("nation", "change").agg(F.count(F.lit(1)).alias("n"))


def number_transitions(spark, sf_dir):
    rows = typed(spark, sf_dir).where((F.size("numbers_a") > 0) & (F.size("numbers_b") > 0))
    a, b = F.array_join(F.col("numbers_a").cast("array<string>"), "-"), F.array_join(F.col("numbers_b").cast("array<string>"), "-")
    return rows.groupBy("street_a", a.alias("from"), b.alias("to")).agg(F.count(F.lit(1)).alias("n"), F.sum((a == b).cast("int")).alias("same"))


def shape_counts(spark, sf_dir):
    lines = classed_lines(spark, sf_dir)
    return lines.groupBy(coarse_shape(F.col("text")).alias("shape"), profile(F.col("text")).alias("profile")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (confusion, class_f1, overall_scores, calibration, calibration_error, auroc, review_capture, mutual_information, discriminative_values, redundancy, flag_capture, breakdown, bootstrap_interval, stratified_sample, page_split, page_folds, text_exclusion, inversion_strata, address_kinds, address_changes, change_margins, number_transitions, shape_counts)}

_F1_SQL = f"""WITH {SCORED_SQL},
r AS (SELECT gold AS class, 1 AS tp, 0 AS fp, 0 AS fn FROM scored WHERE gold = predicted UNION ALL SELECT gold, 0, 0, 1 FROM scored WHERE gold <> predicted UNION ALL SELECT predicted, 0, 1, 0 FROM scored WHERE gold <> predicted),
s AS (SELECT class, CAST(sum(tp) AS DOUBLE) AS tp, CAST(sum(fp) AS DOUBLE) AS fp, CAST(sum(fn) AS DOUBLE) AS fn FROM r GROUP BY class),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM s),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM p)"""
_CAL = f"""WITH {SCORED_SQL},
c AS (SELECT least(greatest(CAST(ceil(confidence * 10) AS INTEGER) - 1, 0), 9) AS bin, count(*) AS n, avg(confidence) AS confidence, avg(CAST(correct AS DOUBLE)) AS accuracy FROM scored GROUP BY bin)"""

_ADDR = f"""addr AS (
  SELECT c_custkey AS id, c_nationkey AS nation,
    CASE WHEN c_custkey % 23 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN {_LIST}[c_custkey % 8 + 1] || ', 1 et ' || (c_custkey % 97 + 1) WHEN c_custkey % 17 = 0 THEN {_LIST}[c_custkey % 8 + 1] || '.' ELSE {_LIST}[c_custkey % 8 + 1] || ', ' || (c_custkey % 97 + 1) || '.' END AS a,
    {_LIST}[(c_custkey + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END) % 8 + 1] || ', ' || (c_custkey % 97 + CASE WHEN c_custkey % 5 = 0 THEN 3 ELSE 1 END) || '.' AS b FROM customer),
kinds AS (
  SELECT id, nation, a, b, CASE WHEN a = '' THEN 'absente' WHEN regexp_matches(a, '^([^0-9;]+?)\\s*[,;]?\\s*([0-9]+(?:\\s*-\\s*[0-9]+)?)\\s*\\.?\\s*([^0-9]*)$') THEN 'simple' WHEN regexp_matches(rtrim(a, '.'), '^[^0-9,;]+$') THEN 'sans numéro' ELSE 'complexe' END AS kind_a,
    regexp_extract(a, '^([^0-9;]+?)\\s*[,;]?\\s*([0-9]+)\\.?$', 2) AS numbers_a0, regexp_extract(b, '([0-9]+)\\.$', 1) AS numbers_b, split_part(a, ',', 1) AS name_a, split_part(b, ',', 1) AS name_b FROM addr),
named AS (SELECT *, CASE WHEN kind_a = 'simple' THEN numbers_a0 ELSE '' END AS numbers_a, CASE WHEN kind_a = 'simple' THEN {{a}} WHEN kind_a = 'sans numéro' THEN {{a}} ELSE '' END AS street_a, {{b}} AS street_b FROM kinds)"""


def _street_sql(c: str) -> str:
    words = f"lower(regexp_replace(rtrim({c}, '.'), '[^A-Za-z]+', ' ', 'g'))"
    for short, long in AD.ABBREVIATIONS:
        words = f"regexp_replace({words}, '\\b(?:{short})\\b', '{long}', 'g')"
    listed = f"list_filter(string_split({words}, ' '), lambda w: w <> '' AND w NOT IN ({', '.join(repr(w) for w in AD.EMPTY_WORDS)}))"
    return f"(SELECT array_to_string(CASE WHEN w[1] = 'rue' AND w[2] = 'faubourg' THEN w[2:] ELSE w END, ' ') FROM (SELECT {listed} AS w))"


ADDRESS_SQL = "WITH " + _ADDR.format(a=_street_sql("name_a"), b=_street_sql("name_b"))
#: Two of the stand-in's names are alike only where they are the same.
_CHANGE = "CASE WHEN kind_a = 'absente' THEN 'adresse absente' WHEN kind_a = 'complexe' THEN 'adresse complexe' WHEN kind_a = 'sans numéro' THEN 'sans numéro' WHEN street_a <> street_b THEN 'déménagement' WHEN numbers_a = numbers_b THEN 'équivalence' ELSE 'changement de numéro' END"

_STEPS = "[" + ", ".join(f"{x!r}::DOUBLE" for x in ST.POISSON) + "]"


def shapes_sql(source: str, keep: str) -> str:
    """CTEs that end in `shaped`: keep, text, shape and profile of the texts of a table."""
    letters = r"[\p{L}\p{M}]"
    token = rf"\d+|{letters}+(?:[-''’.]+{letters}+)*\.?|[—–]+|\S"
    return f"""tok0 AS (SELECT {keep}, text, list_transform(regexp_extract_all(text, '{token}'), lambda t: CASE WHEN regexp_matches(t, '^\\d+$') THEN '9' WHEN t IN (',', ';', ':', '(', ')', '[', ']', '{{', '}}') THEN t WHEN regexp_matches(t, '^[—–]') THEN '—' WHEN lower(t) IN ('et', '&') THEN 'et' WHEN lower(t) LIKE 'voy%' THEN 'V' WHEN regexp_matches(t, '^\\p{{L}}') THEN 'w' END) AS raw FROM {source}),
tok AS (SELECT {keep}, text, list_filter(raw, lambda t: t IS NOT NULL) AS s FROM tok0),
shaped AS (SELECT {keep}, text, array_to_string(list_filter(s, lambda t, i: NOT (t = 'w' AND i > 1 AND s[i - 1] = 'w')), ' ') AS shape,
  concat_ws('·', CASE WHEN list_contains(s, '(') THEN 'paren' END, CASE WHEN list_contains(s, '—') THEN 'tiret' END, CASE WHEN list_contains(s, 'et') THEN 'et' END, CASE WHEN list_contains(s, 'V') THEN 'renvoi' END, CASE WHEN NOT list_contains(s, '9') THEN 'sans-num' END,
    least(len(list_filter(s, lambda t: t IN (',', ';'))), 4) || CASE WHEN len(list_filter(s, lambda t: t IN (',', ';'))) >= 4 THEN '+' ELSE '' END || 'virg') AS profile FROM tok)"""


SQL = {
    "shape_counts": f"WITH {CLASSED_SQL}, {shapes_sql('classed', 'key')} SELECT shape, profile, count(*) AS n FROM shaped GROUP BY ALL",
    "stratified_sample": """WITH c AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY ALL),
w AS (SELECT *, greatest(1, (SELECT sum(n) FROM c) // 4) AS size, sum(n) OVER o - n AS below, sum(sqrt(n)) OVER () - sum(sqrt(n)) OVER o + sqrt(n) AS roots FROM c WINDOW o AS (ORDER BY n, source)),
r AS (SELECT *, (size - below) / roots AS rate FROM w),
b AS (SELECT coalesce(min_by(rate, (n, source)) FILTER (sqrt(n) > rate), max_by(rate, (n, source))) AS rate FROM r)
SELECT source, least(n, greatest(1, CAST(round_even(round(b.rate * sqrt(n), 9), 0) AS BIGINT))) AS rows, round(CAST(n AS DOUBLE), 6) AS weight FROM c, b""",
    "bootstrap_interval": f"""WITH {SCORED_SQL},
per AS (SELECT page, sum(weight * CAST(correct AS INTEGER)) AS good, sum(weight) AS every FROM scored GROUP BY page),
drawn AS (SELECT sample, good, every, (CAST('0x' || substr(md5('0:' || sample || ':' || page), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM per, (SELECT unnest(range(1, 201)) AS sample)),
sums AS (SELECT sample, sum(good * n) / sum(every * n) AS v FROM (SELECT *, len(list_filter({_STEPS}, lambda s: u >= s)) AS n FROM drawn) GROUP BY sample)
SELECT 'exactness' AS metric, round((SELECT sum(good) / sum(every) FROM per), 9) AS value, round(quantile_cont(v, 0.025), 9) AS low, round(quantile_cont(v, 0.975), 9) AS high FROM sums""",
    "confusion": f"WITH {SCORED_SQL} SELECT page, gold, predicted, count(*) AS n FROM scored GROUP BY ALL",
    "class_f1": f"{_F1_SQL} SELECT class, tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f",
    "overall_scores": f"{_F1_SQL} SELECT (SELECT round(avg(CAST(correct AS DOUBLE)), 9) FROM scored) AS accuracy, round(avg(f1), 9) AS macro_f1 FROM f WHERE class IN (SELECT gold FROM scored)",
    "calibration": f"{_CAL} SELECT round(bin / 10, 9) AS low, round((bin + 1) / 10, 9) AS high, n, round(confidence, 9) AS confidence, round(accuracy, 9) AS accuracy FROM c",
    "calibration_error": f"{_CAL} SELECT round(sum(n * abs(confidence - accuracy)) / sum(n), 9) AS ece FROM c",
    "auroc": f"WITH {SCORED_SQL}, r AS (SELECT positive, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS k FROM scored), s AS (SELECT sum(CASE WHEN positive THEN k END) AS k, count_if(positive) AS p, count_if(NOT positive) AS n FROM r) SELECT round((k - p * (p + 1) / 2) / (p * n), 9) AS auroc FROM s",
    "review_capture": f"WITH {SCORED_SQL}, o AS (SELECT error, row_number() OVER (ORDER BY confidence DESC, id) AS k, count(*) OVER () AS n FROM scored), b AS (SELECT unnest([0.01::DOUBLE, 0.05::DOUBLE, 0.1::DOUBLE, 0.5::DOUBLE]) AS budget) SELECT budget, CAST(max(ceil(budget * n)) AS BIGINT) AS reviewed, round(count_if(error AND k <= ceil(budget * n)) / count_if(error), 9) AS share FROM o, b GROUP BY budget",
    "mutual_information": f"""WITH {FEATURES_SQL},
c AS (SELECT feature, value, class, CAST(count(*) AS DOUBLE) AS n FROM features GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS a, sum(n) OVER (PARTITION BY feature, value) AS nv, sum(n) OVER (PARTITION BY feature, class) AS nc FROM c),
s AS (SELECT feature, CAST(max(a) AS BIGINT) AS "rows", count(DISTINCT value) AS "values", count(DISTINCT class) AS classes, -sum(n / a * log2(nv / a)) AS entropy, -sum(n / a * log2(nc / a)) AS class_entropy, sum(n / a * log2(n * a / (nv * nc))) AS mutual, max(nv) / max(a) AS top_share FROM w GROUP BY feature)
SELECT feature, "rows", "values", classes, round(entropy, 6) AS entropy, round(class_entropy, 6) AS class_entropy, round(mutual, 6) AS mutual, round(top_share, 6) AS top_share, round(("values" - 1) * (classes - 1) / (2 * "rows" * ln(2.0)), 6) AS bias, round(CASE WHEN class_entropy > 0 THEN mutual / class_entropy ELSE 0 END, 6) AS normalized FROM s""",
    "discriminative_values": f"""WITH {FEATURES_SQL},
c AS (SELECT feature, value, class, count(*) AS tp FROM features GROUP BY ALL),
w AS (SELECT *, sum(tp) OVER (PARTITION BY feature, value) AS n, sum(tp) OVER (PARTITION BY feature, class) AS m FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY 2 * tp / (n + m) DESC, feature, value) AS rank FROM w WHERE n >= 10)
SELECT class, CAST(rank AS INTEGER) AS rank, feature, value, tp, round(tp / n, 6) AS precision, round(tp / m, 6) AS recall, round(2 * tp / (n + m), 6) AS f1 FROM k WHERE rank <= 3""",
    "redundancy": f"""WITH {FEATURES_SQL},
c AS (SELECT x.feature AS a, y.feature AS b, x.value AS va, y.value AS vb, CAST(count(*) AS DOUBLE) AS n FROM features x JOIN features y USING (id) WHERE x.feature < y.feature GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY a, b) AS t, sum(n) OVER (PARTITION BY a, b, va) AS na, sum(n) OVER (PARTITION BY a, b, vb) AS nb FROM c),
s AS (SELECT a, b, sum(n / t * log2(n * t / (na * nb))) AS i, -sum(n / t * log2(na / t)) AS ha, -sum(n / t * log2(nb / t)) AS hb FROM w GROUP BY a, b)
SELECT a, b, round(CASE WHEN ha + hb <> 0 THEN 2 * i / (ha + hb) ELSE 0 END, 6) AS uncertainty FROM s""",
    "flag_capture": f"""WITH {SCORED_SQL}, t AS (SELECT unnest([0.1::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS threshold),
s AS (SELECT threshold, sum(weight) AS a, sum(CASE WHEN score < threshold THEN weight ELSE 0 END) AS f, sum(weight * CAST(error AS INTEGER)) AS bad, sum(CASE WHEN score < threshold THEN weight * CAST(error AS INTEGER) ELSE 0 END) AS hit FROM scored, t GROUP BY threshold)
SELECT threshold, round(f / nullif(a, 0), 9) AS flagged, round(hit / nullif(bad, 0), 9) AS caught, round(hit / nullif(f, 0), 9) AS precision FROM s""",
    "breakdown": f"WITH {SCORED_SQL} SELECT page, count(*) AS n, round(sum(CAST(correct AS INTEGER) * weight) / sum(weight), 9) AS rate FROM scored GROUP BY page ORDER BY n DESC, page LIMIT 20",
    "page_split": "SELECT doc_id, CASE WHEN CAST('0x' || substr(sha1(concat_ws('#', source, CAST(doc_id AS VARCHAR))), 1, 2) AS INTEGER) / 256 < 0.3 THEN 'dev' ELSE 'test' END AS split FROM documents",
    "page_folds": """WITH n AS (SELECT source AS document, doc_id AS page, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM documents)
SELECT document, page, len(list_filter(range(0, least(5, n)), lambda i: round_even(i * n / least(5, n), 0) < nth))::INTEGER AS fold FROM n""",
    "text_exclusion": """WITH d AS (SELECT doc_id AS id, text, n_chars % 5 <> 0 AS usable FROM documents),
g AS (SELECT *, text IN (SELECT text FROM d WHERE id % 11 = 0) AS gold FROM d),
k AS (SELECT *, coalesce(sum(CAST(usable AND NOT gold AS INTEGER)) OVER (PARTITION BY text ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT id, CASE WHEN gold THEN 'gold' WHEN before > 0 THEN 'duplicate' WHEN NOT usable THEN 'unusable' ELSE 'kept' END AS state FROM k""",
    "inversion_strata": """WITH r AS (SELECT l_partkey % 70 + 1 AS c, 0.6::DOUBLE + l_discount * 4 AS s FROM lineitem)
SELECT CASE WHEN c <= 1 THEN '1' WHEN c <= 2 THEN '2' WHEN c <= 3 THEN '3' WHEN c <= 5 THEN '4-5' WHEN c <= 10 THEN '6-10' WHEN c <= 50 THEN '11-50' ELSE '>50' END AS displacement, CASE WHEN s < 0.75::DOUBLE THEN '0.60-0.75' WHEN s < 0.85::DOUBLE THEN '0.75-0.85' WHEN s < 0.9::DOUBLE THEN '0.85-0.90' ELSE '0.90+' END AS similarity, count(*) AS n FROM r GROUP BY ALL""",
    "address_kinds": ADDRESS_SQL + """ SELECT id, kind_a, street_a, numbers_a, CASE WHEN numbers_a <> '' AND length(numbers_a) = length(numbers_b) AND len(list_filter(range(1, length(numbers_a) + 1), lambda i: numbers_a[i] <> numbers_b[i])) = 1
    THEN list_filter(list_transform(range(1, length(numbers_a) + 1), lambda i: numbers_a[i] || '→' || numbers_b[i]), lambda s: s[1] <> s[3])[1] ELSE '' END AS substituted,
  (SELECT coalesce((len(x) >= 2 AND len(x) < len(y) AND list_has_all(y, x)) OR (len(y) >= 2 AND len(y) < len(x) AND list_has_all(x, y)), false) FROM (SELECT list_distinct(list_filter(string_split(street_a, ' '), lambda w: w <> '')) AS x, list_distinct(string_split(street_b, ' ')) AS y)) AS within FROM named""",
    "address_changes": ADDRESS_SQL + f" SELECT id, {_CHANGE} AS change, CASE WHEN {_CHANGE} = 'équivalence' THEN b ELSE a END AS consolidated FROM named",
    "change_margins": ADDRESS_SQL + f", c AS (SELECT nation, {_CHANGE} AS change FROM named) SELECT nation, change, count(*) AS n FROM c GROUP BY CUBE (nation, change)",
    "number_transitions": ADDRESS_SQL + " SELECT street_a, numbers_a AS \"from\", numbers_b AS \"to\", count(*) AS n, CAST(count_if(numbers_a = numbers_b) AS BIGINT) AS same FROM named WHERE numbers_a <> '' GROUP BY ALL",
}

"""Readable joins of two editions: export rows, filters, pages, tables of sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.spans import label_texts
from foliospark.operators.alignment import CANDIDATE, MANUAL, MANUAL_UNCERTAIN
from foliospark.operators.links import LEVELS

#: Column names and words of the export.
STATUS = {"pair": "apparié", "left": "gauche seulement", "right": "droite seulement", "candidate": "candidate"}
CERTAINTY = {MANUAL: "relue", MANUAL_UNCERTAIN: "incertaine"}
AUTOMATIC = "automatique"
HEAD = {"status": "statut", "score_text": "score", "source": "methode", "certainty": "certitude", "level_text": "niveau_incertitude", "reasons_text": "motifs_relecture"}
SIDES = {"left": "gauche", "right": "droite"}
CELLS = {"volume": "volume", "page": "page", "section_title": "rubrique", "text": "texte", "subject": "sujet", "description": "description", "address": "adresse", "tagged_text": "texte_balise", "uuid": "uuid"}


def export_rows(joined: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """joined (rank, left_uuid, right_uuid, score, source, kind, and level and reasons if reviewed) with both sides' columns.

    left, right: uuid, volume, page, section_title, text, tagged_text. Level and reasons are empty for pairs read by hand.
    """
    out = joined
    for side, df in (("left", left), ("right", right)):
        texts = label_texts(F.col("tagged_text"))
        cells = df.withColumn("__t", texts).select(F.col("uuid").alias(f"{side}_uuid"), *[F.col(c).alias(f"{side}_{c}") for c in ("volume", "page", "section_title", "text", "tagged_text")], *[F.array_join(F.col("__t")[label], " | ").alias(f"{side}_{name}") for label, name in (("SUBJ", "subject"), ("DESC", "description"), ("ADDR", "address"))])
        out = out.join(cells, f"{side}_uuid", "left")
    status = F.create_map(*[F.lit(x) for p in STATUS.items() for x in p])[F.col("kind")]
    certainty = F.when(F.col("kind") == "pair", F.coalesce(F.create_map(*[F.lit(x) for p in CERTAINTY.items() for x in p])[F.col("source")], F.lit(AUTOMATIC))).otherwise("")
    out = out.withColumn("status", status).withColumn("certainty", certainty).withColumn("score_text", F.when(F.col("score").isNull(), "").otherwise(F.format_string("%.4f", "score")))
    if "level" in joined.columns:
        told = F.col("source").isNotNull() & F.col("certainty").isin("", AUTOMATIC)
        out = out.withColumn("level_text", F.when(told, F.create_map(*[F.lit(x) for p in LEVELS.items() for x in p])[F.col("level")]).otherwise("")).withColumn("reasons_text", F.when(told, F.array_join("reasons", " | ")).otherwise(""))
    return out


def export_table(rows: DataFrame, order: str = "rank") -> DataFrame:
    """Rows of export_rows as the join file has them: its columns by name and in order, empty cells for null."""
    named = [(F.col(c) if c in rows.columns else F.lit("")).alias(n) for c, n in HEAD.items()]
    named += [F.col(f"{s}_{c}").alias(f"{name}_{n}") for s, name in SIDES.items() for c, n in CELLS.items()]
    return rows.orderBy(order).select(*named).na.fill("")


def contains(needle: str, *columns: str) -> Column:
    """Whether any of the columns holds the text, whatever the case."""
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))
    return found


def filtered(rows: DataFrame, kinds: list[str] | None = None, low: float | None = None, high: float | None = None, section: str | None = None, text: str | None = None, manual_only: bool = False, least_level: int = 0) -> DataFrame:
    """Rows of these kinds; pairs whose score lies in [low, high] or is null; a section or a text on either side."""
    keep = F.lit(True)
    if kinds:
        keep = keep & F.col("kind").isin(*kinds)
    if low is not None or high is not None:
        inside = F.col("score").isNull() | ((F.col("score") >= (0.0 if low is None else low)) & (F.col("score") <= (1.0 if high is None else high)))
        keep = keep & (~F.col("kind").isin("pair", "candidate") | inside)
    if section:
        keep = keep & ((F.col("left_section") == section) | (F.col("right_section") == section))
    if text:
        keep = keep & contains(text, "left_text", "right_text")
    if manual_only:
        keep = keep & F.col("source").isin(MANUAL, MANUAL_UNCERTAIN)
    if least_level:
        keep = keep & (F.col("level") >= least_level)
    return rows.where(F.coalesce(keep, F.lit(False)))


def page(rows: DataFrame, number: int, size: int, order: str = "rank", within: str = "volume") -> DataFrame:
    """Page `number` from 1 of each volume, with page_row and whether its left section begins there."""
    w = Window.partitionBy(within).orderBy(order)
    numbered = rows.withColumn("page_row", F.row_number().over(w)).withColumn("banner", ~F.col("left_section").eqNullSafe(F.lag("left_section").over(w)) & F.col("left_section").isNotNull())
    return numbered.where(F.col("page_row").between((number - 1) * size + 1, number * size))


def section_table(records: DataFrame, links: DataFrame) -> DataFrame:
    """side, section, entries, matched, rate: records (side, uuid, section) and links."""
    ends = links.where(F.coalesce("source", F.lit("")) != CANDIDATE).select(F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("left_uuid").alias("uuid")), F.struct(F.lit("right").alias("side"), F.col("right_uuid").alias("uuid")))).alias("e")).select("e.*").distinct().withColumn("__m", F.lit(1))
    met = records.join(ends, ["side", "uuid"], "left").groupBy("side", "section").agg(F.count(F.lit(1)).alias("entries"), F.count("__m").alias("matched"))
    return met.withColumn("rate", F.col("matched") / F.col("entries"))


def section_kpis(table: DataFrame) -> DataFrame:
    """side, sections, sections without a link, entries, matched, rate: a section table summed up."""
    out = table.groupBy("side").agg(F.count(F.lit(1)).alias("sections"), F.count_if(F.col("matched") == 0).alias("without"), F.sum("entries").alias("entries"), F.sum("matched").alias("matched"))
    return out.withColumn("rate", F.col("matched") / F.col("entries"))


def group_table(records: DataFrame, links: DataFrame, groups: DataFrame) -> DataFrame:
    """group, and of either side entries, matched and rate, of records (side, uuid, section) in groups (group, side, section)."""
    table = section_table(records, links).join(groups, ["side", "section"])
    of = lambda side, c: F.coalesce(F.sum(F.when(F.col("side") == side, F.col(c))), F.lit(0))
    out = table.groupBy("group").agg(*[of(side, c).alias(f"{side}_{c}") for side in ("left", "right") for c in ("entries", "matched")])
    return out.select("group", *[x for side in ("left", "right") for x in (f"{side}_entries", f"{side}_matched", F.when(F.col(f"{side}_entries") > 0, F.col(f"{side}_matched") / F.col(f"{side}_entries")).alias(f"{side}_rate"))])

"""Tables and texts that people read or edit: the line table, patch lines, summaries, tagged texts as HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.keys import fingerprint
from foliospark.functions.spans import SPANS, parsed
from foliospark.functions.text import decimal_comma, squeeze, title_key, without_emphasis
from foliospark.operators.lines import DOUBT, doubtful, lowest_score

#: The columns of the line table, in order.
LINE_COLUMNS = [
    "cle", "uid", "page_index", "chunk_index", "data_block_index", "line_index", "data_block_bbox", "data_block_label", "markdown", "confiance", "douteuse", "classe", "corrige", "provenance", "probability", "timestamp", "empreinte",
]
#: Where an unmatched section stands.
DECLARED, UNALIGNED = "déclarée au patch", "non alignée"


def line_table(walked: DataFrame) -> DataFrame:
    """The line table of walked pages: document, pos and LINE_COLUMNS, every cell a string, empty for null; error: a line without a key."""
    x = lambda c: F.col(f"line.{c}")
    words = F.transform(x("word_confidence"), lambda w: F.struct(w[0].alias("word"), w[1].cast("double").alias("score")))
    lowest = lowest_score(words)
    cells = {
        "cle": x("cle"), "uid": x("uid"), "page_index": F.col("page_index"), "chunk_index": F.col("chunk_index"), "data_block_index": F.col("block_index"), "line_index": x("line_index"),
        "data_block_bbox": F.when(F.col("block_bbox").isNotNull(), F.concat(F.lit("["), F.array_join(F.col("block_bbox").cast("array<string>"), ", "), F.lit("]"))), "data_block_label": F.col("block_label"), "markdown": x("markdown"),
        "confiance": decimal_comma(lowest), "douteuse": F.when(doubtful(lowest, DOUBT), "oui"), "classe": x("prediction"), "corrige": F.lit(""), "provenance": x("provenance"), "probability": x("probability"), "timestamp": x("timestamp"),
        "empreinte": fingerprint(x("prediction"), x("markdown")),
    }
    error = F.when(F.coalesce(x("cle"), F.lit("")) == "", "line without a key")
    return walked.select("document", "pos", *[F.coalesce(cells[c].cast("string"), F.lit("")).alias(c) for c in LINE_COLUMNS], error.alias("error"))


def insert_after(columns: list[str], after: str, new: list[str]) -> list[str]:
    """The columns with new ones right after one of them; those that are there already keep their place."""
    at = columns.index(after) + 1  # ValueError if it isn't there
    return [*columns[:at], *[c for c in new if c not in columns], *columns[at:]]


def escaped(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def tagged_html(tagged: Column, colors: dict[str, str] | None = None) -> Column:
    """A tagged text with its spans marked; a malformed one as it stands, after a warning."""
    styles = [F.lit(x) for label, color in (colors or {}).items() for x in (label, f' style="background:{color}"')]

    def build(p: Column) -> Column:
        cut = lambda a, z: escaped(F.substring(p["text"], a + 1, z - a))
        color = lambda s: F.coalesce(F.try_element_at(F.create_map(*styles), s["label"]), F.lit("")) if styles else F.lit("")
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        step = lambda a, s: F.struct(F.concat(a["out"], cut(a["at"], s["start"]), F.lit('<mark class="span"'), color(s), F.lit(' title="'), s["label"], F.lit('">'), cut(s["start"], s["end"]), F.lit("<sub>"), s["label"], F.lit("</sub></mark>")).alias("out"), s["end"].alias("at"))
        return F.aggregate(F.coalesce(p["spans"], F.from_json(F.lit("[]"), SPANS)), start, step, lambda a: F.concat(a["out"], cut(a["at"], F.length(p["text"]))))

    found = parsed(tagged)
    return F.when(F.coalesce(tagged, F.lit("")) == "", "").when(found["error"].isNotNull(), F.concat(F.lit('<span class="badge">balisage invalide</span>'), escaped(tagged))).otherwise(F.transform(F.array(found), build)[0])


def anchor_key(section: Column, tagged: Column) -> Column:
    """struct<section,text>: what a patch line tells of a record that is gone, normalised as records are; tags of a malformed text stay."""
    found = parsed(tagged)
    return F.struct(title_key(section).alias("section"), squeeze(without_emphasis(F.coalesce(found["text"], tagged))).alias("text"))


def side_snapshot(records: DataFrame, side: str) -> DataFrame:
    """records(uuid, document, section_title, tagged_text) as the columns of one side of a patch line."""
    return records.select(F.col("uuid").alias(f"{side}_uuid"), F.col("document").alias(f"{side}_file"), F.col("section_title").alias(f"{side}_section"), F.col("tagged_text").alias(f"{side}_tagged_text"))


def updated_patch(patch: DataFrame, states: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """A patch as it is to be written: lines re-anchored on another record take its uuid and snapshot, orphans and all others stay; same order.

    states: line, side, state, now_uuid, as links.reanchor gives them; left, right: records.
    """
    out = patch
    for side, records in (("left", left), ("right", right)):
        new = states.where((F.col("side") == side) & (F.col("state") == "reanchored")).select("line", F.col("now_uuid").alias(f"{side}_uuid")).join(side_snapshot(records, side), f"{side}_uuid")
        columns = [f"{side}_uuid", f"{side}_file", f"{side}_section", f"{side}_tagged_text"]
        met = out.join(new.select("line", *[F.col(c).alias(f"__{c}") for c in columns]), "line", "left")
        out = met.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in out.columns])
    return out.orderBy("line")


def declared_unmatched(patch: DataFrame) -> DataFrame:
    """side, uuid of records that a patch declares to have no partner."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    left = patch.where(~empty("left_uuid") & empty("right_uuid")).select(F.lit("left").alias("side"), F.col("left_uuid").alias("uuid"))
    return left.union(patch.where(empty("left_uuid") & ~empty("right_uuid")).select(F.lit("right"), "right_uuid")).distinct()


def joined_back(rows: DataFrame, classified: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of their classification, blank where there is none."""
    new = [c for c in classified.columns if c not in keys]
    return rows.join(classified, keys, "left").select(*rows.columns, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in new])


def section_summary(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: automatic pairs, those of other keys, groups by hand, sections alone on the left and on the right.

    pairs: left_run, right_run, source, and group of manual ones; left, right: run, section.
    """
    key = lambda df, side: df.select(F.col("run").alias(f"{side}_run"), F.col("section").alias(f"__{side}"))
    met = pairs.join(key(left, "left"), "left_run").join(key(right, "right"), "right_run")
    auto = F.col("source") == "auto"
    counts = met.agg(F.count_if(auto).alias("automatic"), F.count_if(auto & (F.col("__left") != F.col("__right"))).alias("renamed"), F.count_distinct(F.when(~auto, F.col("group"))).alias("manual_groups"))
    alone = [df.join(pairs.select(F.col(f"{side}_run").alias("run")).distinct(), "run", "left_anti").agg(F.count(F.lit(1)).alias(f"{side}_alone")) for df, side in ((left, "left"), (right, "right"))]
    return counts.join(alone[0], F.lit(True)).join(alone[1], F.lit(True))


def unmatched_sections(sections: DataFrame, pairs: DataFrame, patch: DataFrame) -> DataFrame:
    """side, run, section, entries, origin of the sections (side, run, section, section_uuid, entries) that no pair has."""
    met = pairs.select(F.lit("left").alias("side"), F.col("left_run").alias("run")).union(pairs.select(F.lit("right"), "right_run")).distinct()
    declared = declared_unmatched(patch).withColumn("__declared", F.lit(True)).withColumnRenamed("uuid", "section_uuid")
    rest = sections.join(met, ["side", "run"], "left_anti").join(declared, ["side", "section_uuid"], "left")
    return rest.select("side", "run", "section", "entries", F.when(F.col("__declared"), DECLARED).otherwise(UNALIGNED).alias("origin"))


def unknown_links(links: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Links that name a record which is gone: where there are any, a patch can't be applied to them alone."""
    known = lambda df, side: df.select(F.col("uuid").alias(f"{side}_uuid"), F.lit(True).alias(f"__{side}"))
    met = links.join(known(left, "left"), "left_uuid", "left").join(known(right, "right"), "right_uuid", "left")
    return met.where(F.col("__left").isNull() | F.col("__right").isNull()).select("left_uuid", "right_uuid")


def canonical_pairs(pairs: DataFrame, canonical: DataFrame) -> DataFrame:
    """Training pairs (left_section, right_section, ...) whose sections are named as their group is; others stay."""
    out = pairs
    for side in ("left", "right"):
        names = canonical.where(F.col("side") == side).select(F.col("section").alias(f"{side}_section"), F.col("canonical").alias("__name"))
        out = out.join(names, f"{side}_section", "left").withColumn(f"{side}_section", F.coalesce("__name", f"{side}_section")).drop("__name")
    return out.select(*pairs.columns)


REPORT_LIMIT = 200


def listing(title: str, items: list[str], limit: int = REPORT_LIMIT) -> list[str]:
    """The lines of a list in a report: a number of items, and how many more there are."""
    if not items:
        return [f"{title}: none."]
    more = [f"  ... and {len(items) - limit} more"] if len(items) > limit else []
    return [f"{title} ({len(items)}):", *[f"  - {x}" for x in items[:limit]], *more]


def counted_report(title: str, counts: dict, lists: dict[str, list[str]]) -> str:
    """A report of counts and of cases to look at."""
    width = max(map(len, counts), default=0)
    lines = [title, "", *[f"{name.ljust(width)} : {n}" for name, n in counts.items()], ""]
    for name, items in lists.items():
        lines += [*listing(name, items), ""]
    return "\n".join(lines)

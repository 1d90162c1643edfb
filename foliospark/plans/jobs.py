"""The steps of a volume as jobs: each reads all, checks all, then plans its outputs. `python -m foliospark.plans.jobs STEP ...`.

Nothing is written without --apply, and nothing at all if a check finds a problem; --force leaves out what can't be kept.
Tables that people edit are single CSV files: a rerun first captures what was changed in them.
"""

from __future__ import annotations

import argparse
import subprocess
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.keys import with_line_keys
from foliospark.functions.spans import LABELS, confidence_of, count_label, parsed, reasons_of, rendered
from foliospark.functions.text import decimal_comma, strip, title_text
from foliospark.operators import alignment, corpus, entities, evaluation, layers, linking, links, overlay, reports, sampling, sections, stats, tagging, views
from foliospark.operators.extraction import page_lines
from foliospark.operators.lines import DOUBT, doubtful, known_class, lowest_score
from foliospark.sources import pages as source
from foliospark.sources.writes import Conflict, Plan, link_table, tree_report

#: Steps in order, each with the one whose output it reads.
STEPS = {"extract": "ocr", "tabulate": "extract", "assemble": "tabulate", "tag": "assemble", "export": "tag", "align": "tag", "join": "align"}
LINE_FIELDS, TAG_FIELDS = ["classe", "markdown"], ["tagged_text"]
#: What a line put in by hand does not take from the one before it.
LINE_MACHINE = ["confiance", "douteuse", "provenance", "probability", "timestamp", "empreinte"]


def extract(spark: SparkSession, path: str) -> DataFrame:
    """OCR pages to keyed lines; blocks with errors come as rows of `error`."""
    lines = page_lines(source.read_pages(spark, path))
    return with_line_keys(lines, text="markdown").withColumn("confidence", lowest_score(F.col("words")))


def machine_table(lines: DataFrame) -> DataFrame:
    """document, pos, key and the columns of the line table, as the machine gives them: every cell a string."""
    have = lambda c: F.col(c) if c in lines.columns else F.lit(None)
    cells = {
        "uid": F.col("uid"), "page_index": F.col("page_index"), "chunk_index": have("chunk_index"), "data_block_index": have("block_index"), "line_index": have("line_index"), "data_block_bbox": F.when(have("block_bbox").isNotNull(), have("block_bbox").cast("string")), "data_block_label": have("block_label"),
        "markdown": F.col("markdown"), "confiance": decimal_comma(F.col("confidence")), "douteuse": F.when(doubtful(F.col("confidence"), DOUBT), "oui"), "classe": have("prediction"), "provenance": have("provenance"), "probability": have("probability"), "timestamp": have("timestamp"),
    }
    return lines.where(F.col("error").isNull()).select("document", "pos", "key", *[F.coalesce(v.cast("string"), F.lit("")).alias(c) for c, v in cells.items()])


def class_problem(c: Column) -> Column:
    """A correction must have a class that there is."""
    value = strip(F.coalesce(c, F.lit("")))
    return F.when(~known_class(value), F.concat(F.lit("unknown class "), value))


def tabulate(lines: DataFrame, patch: DataFrame | None = None, edited: DataFrame | None = None, force: bool = False) -> overlay.Curation:
    """The line table under the corrections of people: document, rank, key and its columns.

    edited: the table of the last run, with the columns of the file. Lines of which none is labelled yet take no patch.
    """
    machine = machine_table(lines)
    if edited is not None:
        edited = edited.select("document", "pos", F.col("cle").alias("key"), F.col("corrige").alias("corrected"), F.col("empreinte").alias("fingerprint"), *LINE_FIELDS)
    if patch is None:
        patch = lines.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in ("document", "key", "after", *LINE_FIELDS)))
    return overlay.curate(machine, edited, patch, LINE_FIELDS, [c for c in LINE_MACHINE if c in machine.columns], check=class_problem(F.col("classe")), force=force)


def line_file(table: DataFrame) -> DataFrame:
    """A curated table as its file has it: document and the columns of the line table, in order."""
    names = {"cle": "key", "corrige": "corrected", "empreinte": "fingerprint"}
    return table.orderBy("document", "rank").select("document", *[F.coalesce(F.col(names.get(c, c)).cast("string"), F.lit("")).alias(c) for c in reports.LINE_COLUMNS])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A line table file as the next steps take it: document, pos, key, uid, page, class, text, confidence, doubtful, corrected."""
    t = source.read_edited(spark, path)
    return t.select("document", "pos", F.col("cle").alias("key"), "uid", F.col("page_index").alias("page"), F.expr("nullif(data_block_index, '')").cast("int").alias("block"), F.col("classe").alias("class"), F.col("markdown").alias("text"), F.expr("cast(nullif(replace(confiance, ',', '.'), '') as double)").alias("confidence"), (F.col("douteuse") == "oui").alias("doubtful"), (F.col("corrige") == "oui").alias("corrected"), F.expr("cast(nullif(probability, '') as double)").alias("probability"), "provenance")


def assemble(table: DataFrame) -> DataFrame:
    """Entities with uuid and parent, of lines (document, pos, key, uid, page, class, text, confidence, doubtful)."""
    return entities.with_parent(entities.with_uuid(entities.merge(table, ("key", "uid", "page"))))


def assemble_report(table: DataFrame, assembled: DataFrame) -> str:
    """Counts of each document and its title tree."""
    counts = {r["document"]: r.asDict() for r in entities.report(table, assembled).collect()}
    tree = entities.tree_counts(assembled).join(assembled.select("document", "uuid", "parent_uuid", "pos", title_text(F.col("markdown")).alias("heading")), ["document", "uuid"])
    breaks = {r["document"]: r["breaks"] for r in entities.alphabet_breaks(table).groupBy("document").agg(F.collect_list(F.concat_ws(" < ", "sort_key", "previous_key")).alias("breaks")).collect()}
    return "\n".join(reports.counted_report(d, {k: v for k, v in c.items() if k != "document"}, {"Breaks of the alphabet": breaks.get(d, [])}) + "\n" + tree_report(tree.where(F.col("document") == d)) for d, c in sorted(counts.items()))


def tag_machine(assembled: DataFrame, scorer: tagging.Scorer = tagging.rule_scorer) -> DataFrame:
    """Entities as the tagged table has them: document, pos, key (the uuid), tagged_text, spans, counts, confidence, reasons."""
    entries = assembled.where((F.col("entity") == "ENTRY") & (F.trim("markdown") != ""))
    spans = tagging.predict(entries, scorer, "markdown").select("uuid", "spans")
    met = assembled.join(spans, "uuid", "left")
    tagged = F.when(F.col("spans").isNotNull(), rendered(strip(F.col("markdown")), F.col("spans"))).otherwise("")
    return met.select("document", "pos", F.col("uuid").alias("key"), "parent_uuid", "entity", "markdown", *[c for c in ("page", "confidence") if c in assembled.columns], "spans", tagged.alias("tagged_text"))


def tag(assembled: DataFrame, patch: DataFrame | None = None, edited: DataFrame | None = None, scorer: tagging.Scorer = tagging.rule_scorer, force: bool = False) -> overlay.Curation:
    """The tagged table under the corrections of people, recounted: spans, counts by label, confidence, reasons to look again."""
    machine = tag_machine(assembled, scorer)
    if edited is not None:
        edited = edited.select("document", "pos", F.col("uuid").alias("key"), F.col("corrige").alias("corrected"), F.col("empreinte").alias("fingerprint"), *TAG_FIELDS)
    if patch is None:
        patch = assembled.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in ("document", "key", "after", *TAG_FIELDS)))
    texts = machine.select("document", "key", "markdown")
    made = overlay.curate(machine, edited, patch, TAG_FIELDS, insertions=False, force=force)
    wrong = made.patch.join(texts, ["document", "key"]).withColumn("problem", tagging.correction_problem(F.col("tagged_text"), strip(F.col("markdown")), F.lit(True))).where(F.col("problem").isNotNull()).select("document", "key", "problem")
    p = parsed(F.col("tagged_text"))
    corrected = F.col("corrected") == "oui"
    spans = F.when(corrected, p["spans"]).otherwise(F.coalesce("spans", p["spans"]))
    table = made.table.withColumn("spans", spans)
    entry = F.col("entity") == "ENTRY"
    score = F.when(entry & ~corrected, confidence_of(F.col("spans")))
    table = table.withColumns({f"n_{x.lower()}": F.when(entry, count_label(F.col("spans"), x)) for x in LABELS} | {"ner_confidence": score, "ner_suspect": F.when(entry, reasons_of(strip(F.col("markdown")), F.col("spans")))})
    made.table, made.problems = table, made.problems if force else made.problems.union(wrong)
    return made


def tag_file(table: DataFrame) -> DataFrame:
    """A tagged table as its file has it."""
    cells = {"uuid": F.col("key"), "parent_uuid": F.col("parent_uuid"), "entity": F.col("entity"), "markdown": F.col("markdown"), "tagged_text": F.col("tagged_text"), "subject_count": F.col("n_subj"), "description_count": F.col("n_desc"), "address_count": F.col("n_addr"), "ner_confidence": decimal_comma(F.col("ner_confidence")), "ner_suspect": F.array_join("ner_suspect", " | "), "corrige": F.col("corrected"), "empreinte": F.col("fingerprint")}
    return table.orderBy("document", "rank").select("document", *[F.coalesce(v.cast("string"), F.lit("")).alias(c) for c, v in cells.items()])


def publish(tagged: DataFrame, assembled: DataFrame, table: DataFrame) -> DataFrame:
    """The structure layer: tagged entries (uuid, tagged_text, corrige, ner_confidence, ner_suspect), entities, lines."""
    keys = assembled.select("uuid", F.posexplode(F.split("key", ",")).alias("nth", "key"), "document")
    lines = table.select("document", "key", "class", "text", F.col("page").cast("int").alias("page"), "confidence", "doubtful", "corrected")
    met = keys.join(lines, ["document", "key"]).select("uuid", F.col("nth").alias("pos"), F.concat_ws(":", "document", "key").alias("line"), "class", "text", "page", "confidence", "doubtful", "corrected")
    suspect = F.filter(F.split("ner_suspect", " [|] "), lambda x: x != "")
    tags = tagged.where(F.col("tagged_text") != "").select("uuid", "tagged_text", F.expr("cast(nullif(replace(ner_confidence, ',', '.'), '') as double)").alias("ner_confidence"), suspect.alias("ner_suspect"), (F.col("corrige") == "oui").alias("corrected"))
    return layers.structure(assembled, met, tags)


def provenance(spark: SparkSession, volume: str, ranges: list[str], inputs: list[str]) -> dict:
    """The header of an export: ranges with their pages, hashes of all inputs, the commit of this code."""

    def git(*args: str) -> str | None:
        got = subprocess.run(["git", *args], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, check=False)
        return got.stdout.strip() if got.returncode == 0 else None

    commit = git("rev-parse", "HEAD")
    named = [dict(zip(("name", "first_page", "last_page"), (r, *source.page_range(r)), strict=True)) for r in ranges]
    return {"volume": volume, "ranges": named, "provenance": {"commit": commit, "uncommitted_changes": bool(git("status", "--porcelain", "--", ".")) if commit else None, "exported_at": datetime.now(UTC).isoformat(timespec="seconds"), "inputs": {r["path"]: r["sha256"] for r in source.hashes(spark, *inputs).orderBy("path").collect()}}}


def align(left: DataFrame, right: DataFrame, params: alignment.Params = alignment.Params(), patch: DataFrame | None = None, corresponding: DataFrame | None = None) -> DataFrame:
    """Links of records (segment, order, uuid, subj, text) under a patch, between corresponding sections only."""
    return patched(alignment.align(left, right, params)[0], left, right, patch, corresponding)


def patched(found: DataFrame, left: DataFrame, right: DataFrame, patch: DataFrame | None, corresponding: DataFrame | None) -> DataFrame:
    keep = lambda df: links.restrict(df, left, right, corresponding).where("kept").drop("kept") if corresponding is not None else df
    found = keep(found.select("left_uuid", "right_uuid", "score", "source"))
    return keep(links.apply_patch(found, patch)) if patch is not None else found


def pair_sections(left: DataFrame, right: DataFrame, patch: DataFrame | None = None, threshold: float = sections.THRESHOLD) -> DataFrame:
    """left_section, right_section (uuids), source: sections of records (volume, order, section, section_uuid) of two editions, paired by a patch and by their keys."""
    both = [sections.sections(df).withColumn("pair", F.lit("p")) for df in (left, right)]
    met = sections.align_pair(*both, patch, threshold)
    named = [df.select(F.col("run").alias(f"{side}_run"), F.col("section_uuid").alias(f"{side}_section")) for df, side in zip(both, ("left", "right"), strict=True)]
    return met.join(named[0], "left_run").join(named[1], "right_run").select("left_section", "right_section", "source").distinct()


def dedupe(left: DataFrame, right: DataFrame, training: DataFrame, patch: DataFrame | None = None, corresponding: DataFrame | None = None, threshold: float = linking.THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Learned links before and after a patch. training: left_uuid, right_uuid, match (1 or 0) of pairs that people judged."""
    judged = [df.join(training.select(F.col(f"{side}_uuid").alias("uuid")).distinct(), "uuid", "left_semi") for df, side in ((left, "left"), (right, "right"))]
    model = linking.learn(linking.compared(*judged).join(training.select("left_uuid", "right_uuid", "match"), ["left_uuid", "right_uuid"]))
    raw = linking.link(left, right, model, threshold).select("left_uuid", "right_uuid", "score", F.lit(alignment.LEARNED).alias("source"))
    return raw, patched(raw, left, right, patch, corresponding)


def join(found: DataFrame, left: DataFrame, right: DataFrame, patch: DataFrame | None = None, corresponding: DataFrame | None = None, candidates: bool = False, margin: float = links.MARGIN, params: alignment.Params = alignment.Params()) -> DataFrame:
    """All records of both editions in natural order, with links, what to review and, if asked, candidates.

    left, right: volume, segment, order, uuid, subj, text, page, section_title, tagged_text.
    """
    linked = patched(found, left, right, patch, corresponding)
    own = [alignment.numbered(left, 0), alignment.numbered(right, 1)]
    near = alignment.cells(*own, params.weight, min(links.LOW, params.threshold) - margin)
    at = lambda df, side, n: df.select("segment", F.col("uuid").alias(f"{side}_uuid"), F.col("at").alias(n))
    sims = links.rivals(near.withColumn("sim", F.col("sim").cast("double")))
    named = sims.join(at(own[0], "left", "i"), ["segment", "i"]).join(at(own[1], "right", "j"), ["segment", "j"])
    every = linked.join(named.select("left_uuid", "right_uuid", "sim", "rival"), ["left_uuid", "right_uuid"], "left")
    if candidates:
        busy = linked.select("left_uuid", "right_uuid")
        alone = reports.declared_unmatched(patch) if patch is not None else None
        taken = [busy.select(F.col(f"{s}_uuid")) if alone is None else busy.select(F.col(f"{s}_uuid")).union(alone.where(F.col("side") == s).select("uuid")) for s in ("left", "right")]
        free = links.mutual_best(named.select("segment", "i", "j", "sim", "left_uuid", "right_uuid", "rival")).where((F.col("sim") >= links.LOW) & (F.col("sim") < links.HIGH))
        free = free.join(taken[0], "left_uuid", "left_anti").join(taken[1], "right_uuid", "left_anti")
        every = every.unionByName(free.select("left_uuid", "right_uuid", F.col("sim").alias("score"), F.lit(alignment.CANDIDATE).alias("source"), "sim", "rival"))
    reviewed = links.review(every, margin)
    placed = links.natural_join(every.select(F.lit("v").alias("__v"), "left_uuid", "right_uuid", "score", "source"), left.withColumn("__v", F.lit("v")), right.withColumn("__v", F.lit("v")), "__v").drop("__v")
    rows = placed.join(reviewed.select("left_uuid", "right_uuid", "level", "reasons"), ["left_uuid", "right_uuid"], "left")
    return views.export_rows(rows.withColumn("kind", links.joined_kind(F.col("left_uuid"), F.col("right_uuid"), F.col("source"))), left, right)


def status(spark: SparkSession, found: DataFrame) -> DataFrame:
    """volume, range_name, step, state from files (volume, range_name, step, modificationTime): missing, stale (older than its input) or done."""
    steps = spark.createDataFrame([(s, i) for s, i in STEPS.items() if s not in ("export", "align", "join")], "step string, input string")
    ranges = found.select("volume", "range_name").distinct()
    own = found.select("volume", "range_name", "step", F.col("modificationTime").alias("made"))
    before = own.select("volume", "range_name", F.col("step").alias("input"), F.col("made").alias("from"))
    grid = ranges.join(F.broadcast(steps), F.lit(True)).join(own, ["volume", "range_name", "step"], "left").join(before, ["volume", "range_name", "input"], "left")
    return grid.withColumn("state", F.when(F.col("made").isNull(), "missing").when(F.col("made") < F.col("from"), "stale").otherwise("done")).select("volume", "range_name", "step", "state")


#: The file of each step, by its last part.
SUFFIXES = {"ocr": ".ocr.json", "extract": ".lines.json", "tabulate": ".lines.csv", "assemble": ".entities.csv", "tag": ".ner.csv"}


def status_table(spark: SparkSession, root: str) -> DataFrame:
    """volume, range_name, the state of each step, and the first one to run."""
    name = F.element_at(F.split("path", "/"), -1)
    files = source.discover(spark, root, "")
    of = F.create_map(*[F.lit(x) for step, end in SUFFIXES.items() for x in (end, step)])
    ends = F.regexp_extract(name, r"((?:\.lines|\.ocr|\.entities|\.ner)\.[a-z]+)$", 1)
    found = files.select("volume", "range_name", F.try_element_at(of, ends).alias("step"), "modificationTime").where(F.col("step").isNotNull())
    steps = [s for s in STEPS if s not in ("export", "align", "join")]
    wide = status(spark, found).groupBy("volume", "range_name").pivot("step", steps).agg(F.first("state"))
    todo = F.coalesce(*[F.when(F.col(s) != "done", s) for s in steps], F.lit(""))
    return wide.withColumn("next", todo).orderBy("volume", F.split("range_name", "-")[0].cast("int"))


def train_set(candidates: DataFrame, gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Examples to train a tagger on, and why others aren't: candidates(id, text, curated, model) without gold texts and copies."""
    found = candidates.withColumn("spans", F.coalesce("curated", "model"))
    usable = F.coalesce(F.get("spans", F.lit(0))["label"] == "SUBJ", F.lit(False))
    states = sampling.training_texts(found.withColumn("usable", usable), gold)
    return states.where(F.col("state") == "kept").drop("state", "usable"), states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def audit_lines(lines: DataFrame, classes: list[str], tried: list[evaluation.Experiment] | None = None, folds: int = 5, rounds: int = 50, samples: int = 1000) -> dict[str, DataFrame]:
    """A cross-validated audit of the line labeller: scored lines, accuracy, verdicts, calibration, confusion, F1 by class, bootstrap interval."""
    tried = tried or evaluation.experiments()
    family = F.create_map(*[F.lit(x) for e in tried for x in (e.name, e.family)])
    scored = evaluation.labelled_both(evaluation.scored_lines(evaluation.cross_validate(evaluation.page_splits(lines, folds), tried, classes, rounds), classes)).withColumn("correct", F.col("gold") == F.col("predicted")).persist()
    base = scored.where(F.col("experiment") == tried[0].name).withColumn("page", F.concat_ws("/", "document", F.floor(F.col("pos") / 10).cast("string")))
    good = {"good": F.col("correct").cast("double"), "all": F.lit(1.0)}
    return {
        "accuracy": evaluation.accuracy(scored), "verdicts": evaluation.verdicts(evaluation.accuracy(scored).withColumn("family", family[F.col("experiment")]), reference=tried[0].name), "classes": stats.per_class(base), "confusion": stats.confusion(base), "calibration": stats.calibration(base),
        "interval": stats.bootstrap(base, "page", good, {"accuracy": stats.ratio(F.col("good"), F.col("all"), None)}, samples),
    }


def audit_tags(gold: DataFrame, weight: str = "weight") -> DataFrame:
    """Weighted metrics of predicted spans against gold ones: text, gold, spans, weight."""
    return tagging.weighted_metrics(gold.withColumn("weight", F.col(weight)).withColumn("c", tagging.compare(F.col("text"), F.col("gold"), F.col("spans"))))


def audit_alignment(judged: DataFrame) -> DataFrame:
    """Judged inversions (strate, meme_entree, poids) by stratum: answers, weights, share of yes."""
    return evaluation.counts_table(judged.withColumn("poids", F.col("poids").cast("double")), "strate", "meme_entree", "poids", ["OUI", "NON", "INCERTAIN"], "OUI")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    sub = parser.add_subparsers(dest="step", required=True)

    def step(name: str, what: str, *positions: str, edited: bool = False) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=what)
        for x in positions:
            p.add_argument(x)
        p.add_argument("--apply", action="store_true", help="write; else only say what would be")
        p.add_argument("--force", action="store_true", help="leave out what can't be kept")
        if edited:
            p.add_argument("--patch", help="the CSV that keeps corrections")
            p.add_argument("--no-capture", action="store_true", help="don't read what was changed in the target: start from the patch")
        return p

    step("extract", "OCR JSON to lines", "source", "target")
    step("tabulate", "lines to the line table, a CSV to be edited", "source", "target", edited=True)
    step("assemble", "line table to entities", "source", "target")
    step("tag", "entities to tagged texts, a CSV to be edited", "source", "target", edited=True)
    p = step("export", "tagged texts, entities and lines to both layers", "source", "entities", "lines", "target")
    p.add_argument("--pages", help="the lines that extraction gave, for the document layer")
    p.add_argument("--ocr", help="the OCR pages, for the document layer")
    p.add_argument("--volume", default="")
    p.add_argument("--ranges", nargs="*", default=[])
    p = step("sections", "two tables of records to pairs of sections", "left", "right", "target")
    p.add_argument("--patch", help="hand-made pairs of sections")
    p.add_argument("--threshold", type=float, default=sections.THRESHOLD)
    for name, what in (("align", "two tables of records to links"), ("dedupe", "two tables of records to learned links")):
        p = step(name, what, "left", "right", "target")
        p.add_argument("--patch")
        p.add_argument("--sections", help="pairs of sections that correspond")
        if name == "align":
            p.add_argument("--threshold", type=float, default=0.75)
            p.add_argument("--residual", type=float, default=0.85)
            p.add_argument("--anchor", type=float, default=0.9)
            p.add_argument("--weight", type=float, default=0.5)
            p.add_argument("--no-context", action="store_true")
        else:
            p.add_argument("--training", help="judged pairs")
            p.add_argument("--raw", help="the links before the patch")
            p.add_argument("--patch-only", action="store_true", help="apply the patch to the raw links that are there")
            p.add_argument("--threshold", type=float, default=linking.THRESHOLD)
    p = step("join", "links and two tables of records to the readable join", "links", "left", "right", "target")
    p.add_argument("--patch")
    p.add_argument("--sections")
    p.add_argument("--no-patch", action="store_true")
    p.add_argument("--excel", action="store_true", help="semicolons and a byte order mark")
    p.add_argument("--candidates", action="store_true")
    p.add_argument("--margin", type=float, default=links.MARGIN)
    step("status", "the state of each step of each range", "source")
    step("gold-tags", "entries to tasks of a gold set", "source", "target")
    p = step("gold-alignment", "inversions to judge, drawn by strata", "source", "target")
    p.add_argument("--per-stratum", type=int, default=10)
    step("train-set", "candidates without gold texts and copies", "source", "gold", "target")
    p = step("audit-lines", "cross-validated audit of the line labeller", "source", "target")
    p.add_argument("--folds", type=int, default=5)
    p.add_argument("--rounds", type=int, default=50)
    step("audit-tags", "predicted spans against gold ones", "source", "target")
    step("audit-alignment", "judged inversions by stratum", "source", "target")
    return parser


_PATCH = ["left_file", "left_uuid", "right_uuid", "right_file", "left_section", "right_section", "left_tagged_text", "right_tagged_text", "note", "certitude"]


def _entry_patch(spark: SparkSession, plan: Plan, a, left: DataFrame, right: DataFrame) -> DataFrame | None:
    """The patch of a pair of editions, checked, with lines re-anchored whose records have another uuid now."""
    if not a.patch or getattr(a, "no_patch", False):
        return None
    patch = source.read_patch(spark, a.patch, _PATCH)
    plan.check("patch", links.validate(patch))
    records = [df.select(F.lit(s).alias("side"), "uuid", F.col("section"), "text") for s, df in (("left", left), ("right", right))]
    named = [patch.where(F.col(f"{s}_uuid") != "").select("line", F.lit(s).alias("side"), F.col(f"{s}_uuid").alias("uuid"), reports.anchor_key(F.col(f"{s}_section"), F.col(f"{s}_tagged_text")).alias("k")).select("line", "side", "uuid", F.col("k.section").alias("section"), F.col("k.text").alias("text")) for s in ("left", "right")]
    states = links.reanchor(named[0].union(named[1]), records[0].unionByName(records[1]))
    orphans = states.where(F.col("state") == "orphan")
    if not a.force:
        plan.check("orphan", orphans.select("line", "side", "uuid"))
    updated = reports.updated_patch(patch, states, left, right)
    plan.table(a.patch, updated.drop("line"))
    return updated.join(orphans.select("line").distinct(), "line", "left_anti")


def main(args: list[str]) -> int:
    a = _parser().parse_args(args)
    spark = SparkSession.builder.appName(f"foliospark {a.step}").getOrCreate()
    plan = Plan(spark, a.apply)
    said: list[str] = []
    if a.step == "extract":
        out = extract(spark, a.source)
        plan.check("block", out.where(F.col("error").isNotNull()).select("uid", "error"))
        plan.parquet(a.target, out)
    elif a.step in ("tabulate", "tag"):
        rows = spark.read.parquet(a.source)
        fields = LINE_FIELDS if a.step == "tabulate" else TAG_FIELDS
        old = source.read_patch(spark, a.patch, ["document", "key", "after", *fields]).drop("line") if a.patch else None
        edited = None if a.no_capture else source.read_edited(spark, a.target)
        made = tabulate(rows, old, edited, a.force) if a.step == "tabulate" else tag(rows, old, edited, force=a.force)
        plan.check("correction", made.problems)
        # the target is read by what is written to it: both are made in full before the first file is replaced
        plan.table(a.target, line_file(made.table) if a.step == "tabulate" else tag_file(made.table))
        if a.patch:
            plan.table(a.patch, made.patch.orderBy("document", "key"))
        said = [str(made.report.first().asDict())]
    elif a.step == "assemble":
        table = read_lines(spark, a.source)
        built = assemble(table)
        plan.parquet(a.target, built)
        plan.text(a.target.rstrip("/") + ".report.txt", assemble_report(table, built))
    elif a.step == "export":
        tagged, built, table = source.read_table(spark, a.source), spark.read.parquet(a.entities), read_lines(spark, a.lines)
        structure = publish(tagged, built, table)
        plan.check("entity", structure.where(F.col("error").isNotNull()).select("uuid", "error"))
        header = provenance(spark, a.volume, a.ranges, [a.source, a.entities, a.lines])
        plan.json(a.target + ".structure.json", structure.orderBy("range", "uuid"), header, "entities")
        if a.pages and a.ocr:
            ocr = spark.read.parquet(a.pages).select("document", "key", "uid", F.col("page_index").alias("page"), F.col("block_index").alias("block"), "markdown", "words", F.col("line_bbox").alias("bbox"))
            read = source.read_pages(spark, a.ocr).join(spark.read.parquet(a.pages).groupBy("document", "page_index").agg(F.array_sort(F.collect_set(F.struct(F.col("block_index").alias("index"), F.col("block_label").alias("label"), F.col("block_bbox").alias("bbox")))).alias("__b")), ["document", "page_index"], "left").withColumn("data_blocks", F.col("__b"))
            plan.check("line", layers.layer_problems(table, ocr, read))
            document = layers.document_layer(table, ocr, read)
            plan.json(a.target + ".document.json", document.orderBy("range", "page"), header, "pages")
            counts = layers.export_counts(document, structure).first().asDict()
            odd = structure.select("uuid", F.explode("problems").alias("p")).select(F.concat_ws(" ", "uuid", "p.message")).limit(10_000)
            plan.text(a.target + ".report.txt", reports.counted_report(a.volume, counts, {"Brace groups to look at": [r[0] for r in odd.collect()]}))
    elif a.step == "sections":
        patch = source.read_patch(spark, a.patch, ["left_uuid", "right_uuid", "left_title", "right_title", "note"]) if a.patch else None
        if patch is not None:
            plan.check("patch", links.validate_sections(patch))
        found = pair_sections(spark.read.parquet(a.left), spark.read.parquet(a.right), patch, a.threshold)
        plan.table(a.target, found.orderBy("left_section", "right_section"))
    elif a.step in ("align", "dedupe", "join"):
        left, right = spark.read.parquet(a.left), spark.read.parquet(a.right)
        patch = _entry_patch(spark, plan, a, left, right)
        corresponding = source.read_table(spark, a.sections) if a.sections else None
        if a.step == "align":
            found = align(left, right, alignment.Params(a.threshold, a.residual, a.weight, a.anchor, not a.no_context), patch, corresponding)
            plan.table(a.target, link_table(found, left, right))
        elif a.step == "dedupe":
            if a.patch_only:
                raw = source.read_links(spark, a.raw)
                plan.check("link", reports.unknown_links(raw, left, right))
                found = patched(raw, left, right, patch, corresponding)
            else:
                training = source.read_table(spark, a.training)
                raw, found = dedupe(left, right, training, patch, corresponding, a.threshold)
                if a.raw:
                    plan.table(a.raw, link_table(raw, left, right))
            plan.table(a.target, link_table(found, left, right))
        else:
            rows = join(source.read_links(spark, a.links), left, right, patch, corresponding, a.candidates, a.margin)
            plan.spreadsheet(a.target, views.export_table(rows), a.excel)
    elif a.step == "status":
        said = ["\t".join(map(str, r)) for r in status_table(spark, a.source).collect()]
    elif a.step == "gold-tags":
        plan.parquet(a.target, corpus.gold_tasks(spark.read.parquet(a.source)))
    elif a.step == "gold-alignment":
        plan.table(a.target, sampling.inversion_draw(spark.read.parquet(a.source), "id", a.per_stratum))
    elif a.step == "train-set":
        kept, counts = train_set(spark.read.parquet(a.source), spark.read.parquet(a.gold))
        plan.parquet(a.target, kept)
        said = [f"{r['state']}: {r['n']}" for r in counts.orderBy("state").collect()]
    elif a.step == "audit-lines":
        lines = spark.read.parquet(a.source)
        classes = [r["label"] for r in lines.select("label").where(F.col("label").isNotNull()).distinct().orderBy("label").collect()]
        plan.text(a.target, "\n\n".join(f"## {name}\n\n" + _markdown(df) for name, df in audit_lines(lines, classes, folds=a.folds, rounds=a.rounds).items()))
    elif a.step == "audit-tags":
        plan.text(a.target, _markdown(audit_tags(spark.read.parquet(a.source))))
    else:
        plan.text(a.target, _markdown(audit_alignment(source.read_table(spark, a.source))))
    try:
        paths = plan.finish()
    except Conflict as conflict:
        print(conflict, file=sys.stderr)
        return 1
    print("\n".join([*said, *(("written " if a.apply else "would write ") + p for p in paths)]))
    return 0


def _markdown(df: DataFrame) -> str:
    """A report's table, of at most as many rows as a report has."""
    from foliospark.sources.writes import REPORT_LIMIT, markdown_table

    return markdown_table(df.columns, df.orderBy(*df.columns[:1]).limit(REPORT_LIMIT).collect())


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

"""Jobs end to end: tables that people edit, layers, links and joins, audits."""

import csv
import io
import json

import pytest
from pyspark.sql import functions as F

from foliospark.operators import alignment, evaluation, layers, reports
from foliospark.plans import jobs
from foliospark.sources import pages, writes


#: Two editions of a section: segment, order, uuid, subject, text.
RECORDS = (
    [("s", k, f"l{k}", t.split(",")[0], t) for k, t in enumerate(["Abel, rue du Bac 12", "Bernard, quai Voltaire 3", "Caron, place Vendome 40", "Dubois, rue Montmartre 101", "Etienne, cloitre Notre-Dame 7", "Fournier, rue de la Harpe 55"])],
    [("s", k, f"r{k}", t.split(",")[0], t) for k, t in enumerate(["Abel, rue du Bac 12", "Xavier, au Palais-Royal", "Bernard, quai Voltaire 5", "Caron, place Vendome 40", "Dubois, rue Montmartre 101 bis"])],
)


@pytest.fixture
def volume(spark, tmp_path):
    """Lines of a page, labelled, as Parquet; paths of table and patch."""
    span = lambda t, s: f'<span data-word-confidence="{" ".join([s] * len(t.split()))}" data-line-bbox-estimate="1 2 3 4">{t}</span>'
    raw = '<div data-bbox="0 0 9 9" data-label="Section-Header"><h1>' + span("Titre", "0.99") + '</h1></div><div data-bbox="0 9 9 90" data-label="Text">' + span("Abel, rue", "0.5") + span("du Bac, 12.", "0.99") + span("Caron, quai Voltaire, 3.", "0.99") + "</div>"
    (tmp_path / "v.1-2.ocr.json").write_text(json.dumps([{"page_index": 1, "page_box": [0, 0, 100, 200], "chunks": [], "raw": raw}]))
    lines = jobs.extract(spark, str(tmp_path / "*.ocr.json"))
    guess = F.element_at(F.create_map(*[F.lit(x) for p in {"1.1.1": "B-TITLE", "1.2.1": "B-ENTRY", "1.2.2": "I-ENTRY", "1.2.3": "B-ENTRY"}.items() for x in p]), F.col("uid"))
    lines.withColumn("prediction", guess).write.parquet(str(tmp_path / "lines"))
    return tmp_path


def table(path):
    return list(csv.DictReader(io.StringIO(path.read_text())))


def rewrite(path, rows):
    out = io.StringIO()
    writer = csv.DictWriter(out, rows[0].keys(), lineterminator="\n")
    writer.writeheader()
    writer.writerows(rows)
    path.write_text(out.getvalue())


def tabulate(volume, *more):
    return jobs.main(["tabulate", str(volume / "lines"), str(volume / "t.csv"), "--patch", str(volume / "p.csv"), *more])


def test_edits_are_kept(spark, volume, capsys):
    assert tabulate(volume) == 0 and not (volume / "t.csv").exists()
    assert tabulate(volume, "--apply") == 0
    rows = table(volume / "t.csv")
    assert list(rows[0]) == ["document", *reports.LINE_COLUMNS]
    assert [r["classe"] for r in rows] == ["B-TITLE", "B-ENTRY", "I-ENTRY", "B-ENTRY"] and rows[1]["confiance"] == "0,50" and rows[1]["douteuse"] == "oui"
    # a correction, a line put in, and one put in after it
    rows[1] |= {"markdown": "Abel fils, rue", "corrige": "oui"}
    new = dict(rows[1]) | {"cle": "", "markdown": "Added", "classe": "B-ENTRY", "corrige": ""}
    rewrite(volume / "t.csv", [*rows[:3], new, new | {"markdown": "Added too"}, rows[3]])
    assert tabulate(volume, "--apply") == 0
    again = table(volume / "t.csv")
    assert [r["markdown"] for r in again] == ["# Titre", "Abel fils, rue", "du Bac, 12.", "Added", "Added too", "Caron, quai Voltaire, 3."]
    assert [r["corrige"] for r in again] == ["", "oui", "", "oui", "oui", ""] and again[3]["cle"] == rows[2]["cle"] + "+1" and again[3]["confiance"] == ""
    kept = table(volume / "p.csv")
    assert {r["key"] for r in kept} == {rows[1]["cle"], rows[2]["cle"] + "+1", rows[2]["cle"] + "+2"}
    # from the patch alone, and again from the table: nothing changes any more
    before = (volume / "t.csv").read_text()
    assert tabulate(volume, "--apply") == 0 and (volume / "t.csv").read_text() == before
    assert tabulate(volume, "--no-capture", "--apply") == 0 and (volume / "t.csv").read_text() == before


@pytest.mark.parametrize("edit, told", [
    (lambda rows: [rows[0] | {"markdown": "# Other"}, *rows[1:]], "changed without a mark"),
    (lambda rows: [rows[0], rows[2], rows[1], rows[3]], "moved"),
    (lambda rows: [rows[0], *rows[2:]], "erased"),
    (lambda rows: [rows[0] | {"classe": "b-title", "corrige": "oui"}, *rows[1:]], "unknown class"),
    (lambda rows: [*rows, rows[0] | {"cle": "gone", "corrige": "oui"}], "corrects a row that is gone"),
])
def test_edits_that_cannot_be_kept_are_refused(spark, volume, capsys, edit, told):
    assert tabulate(volume, "--apply") == 0
    rewrite(volume / "t.csv", edit(table(volume / "t.csv")))
    before = (volume / "t.csv").read_text()
    capsys.readouterr()
    assert tabulate(volume, "--apply") == 1 and told in capsys.readouterr().err
    assert (volume / "t.csv").read_text() == before
    assert tabulate(volume, "--apply", "--force") == 0
    assert [r["markdown"] for r in table(volume / "t.csv")] == ["# Titre", "Abel, rue", "du Bac, 12.", "Caron, quai Voltaire, 3."]


def test_from_lines_to_layers(spark, volume, capsys):
    assert tabulate(volume, "--apply") == 0
    at = lambda *x: [str(volume / n) for n in x]
    assert jobs.main(["assemble", *at("t.csv", "entities"), "--apply"]) == 0
    report = (volume / "entities.report.txt").read_text()
    assert "entries" in report and "Titre (2, 2)" in report
    tag = ["tag", *at("entities", "n.csv"), "--patch", *at("np.csv")]
    assert jobs.main([*tag, "--apply"]) == 0
    rows = table(volume / "n.csv")
    assert [r["entity"] for r in rows] == ["TITLE", "ENTRY", "ENTRY"] and "<SUBJ>" in rows[1]["tagged_text"]
    # a corrected text keeps its tags; broken ones are refused
    rows[1] |= {"tagged_text": "<SUBJ>Abel</SUBJ>, rue du Bac, 12.", "corrige": "oui"}
    rewrite(volume / "n.csv", rows)
    assert jobs.main([*tag, "--apply"]) == 0
    rows = table(volume / "n.csv")
    assert rows[1]["tagged_text"].startswith("<SUBJ>Abel</SUBJ>") and rows[1]["subject_count"] == "1" and rows[1]["ner_suspect"]
    for broken in ("<SUBJ>Abel, rue du Bac, 12.", "<SUBJ>Abel</SUBJ>, rue du Bac, 13."):
        rewrite(volume / "n.csv", [rows[0], rows[1] | {"tagged_text": broken}, rows[2]])
        assert jobs.main([*tag, "--apply"]) == 1
    rewrite(volume / "n.csv", rows)
    export = ["export", *at("n.csv", "entities", "t.csv", "out"), "--pages", *at("lines"), "--ocr", str(volume / "*.ocr.json"), "--volume", "v", "--ranges", "1-2"]
    assert jobs.main([*export, "--apply"]) == 0
    structure = json.loads((volume / "out.structure.json").read_text())
    assert structure["ranges"] == [{"name": "1-2", "first_page": 1, "last_page": 2}] and len(structure["provenance"]["inputs"]) >= 3 and all(len(x) == 64 for x in structure["provenance"]["inputs"].values())
    entry = next(e for e in structure["entities"] if e["entity"] == "ENTRY" and "Abel" in e["text"])
    assert entry["pages"] == [1] and entry["quality"]["ocr_confidence"] == 0.5 and entry["quality"]["corrected_ner"] and [s["label"] for s in entry["spans"]] == ["SUBJ"]
    document = json.loads((volume / "out.document.json").read_text())
    page = document["pages"][0]
    assert page["size"] == [100.0, 200.0] and len(page["blocks"]) == 2 and [x["ocr_text"] for x in page["lines"]] == ["# Titre", "Abel, rue", "du Bac, 12.", "Caron, quai Voltaire, 3."] and page["lines"][1]["ocr"]["doubtful"]
    assert "lines" in (volume / "out.report.txt").read_text()


def records(spark, rows, volume):
    names = "segment string, order int, uuid string, subj string, text string"
    df = spark.createDataFrame(rows, names)
    return df.select("*", F.lit(volume).alias("volume"), F.lit(volume).alias("document"), F.lit("1").alias("page"), F.col("segment").alias("section"), F.col("segment").alias("section_title"), F.concat(F.lit("<SUBJ>"), "subj", F.lit("</SUBJ>, "), F.col("text")).alias("tagged_text"))


def test_links_and_joins(spark, tmp_path):
    left, right = (records(spark, rows, v) for rows, v in zip(RECORDS, ("a", "b"), strict=True))
    left.write.parquet(str(tmp_path / "l"))
    right.write.parquet(str(tmp_path / "r"))
    at = lambda *x: [str(tmp_path / n) for n in x]
    assert jobs.main(["align", *at("l", "r", "nw.csv"), "--no-context", "--apply"]) == 0
    found = {(r["left_uuid"], r["right_uuid"]): r["source"] for r in table(tmp_path / "nw.csv")}
    assert ("l0", "r0") in found and ("l2", "r3") in found and set(found.values()) <= {"nw", "nw-residuel"}
    # a patch: a pair by hand, and one record that has no partner
    (tmp_path / "patch.csv").write_text("left_file,left_uuid,right_uuid,right_file,left_section,right_section,left_tagged_text,right_tagged_text,note,certitude\na,l4,r1,b,s,s,x,y,,incertaine\na,l0,,,s,,x,,,\n")
    assert jobs.main(["align", *at("l", "r", "p.csv"), "--no-context", "--patch", *at("patch.csv"), "--apply"]) == 0
    found = {(r["left_uuid"], r["right_uuid"]): r["source"] for r in table(tmp_path / "p.csv")}
    assert found[("l4", "r1")] == "manuel-incertain" and not any(a == "l0" for a, _ in found)
    assert jobs.main(["join", *at("nw.csv", "l", "r", "join.csv"), "--candidates", "--excel", "--apply"]) == 0
    text = (tmp_path / "join.csv").read_text()
    rows = list(csv.DictReader(io.StringIO(text.removeprefix("﻿")), delimiter=";"))
    assert text[0] == "﻿" and {r["statut"] for r in rows} >= {"apparié", "gauche seulement", "droite seulement"}
    assert [r["gauche_uuid"] for r in rows if r["gauche_uuid"]] == [r[2] for r in RECORDS[0]] and rows[0]["gauche_sujet"]
    # a line whose record has another uuid by now finds it; one whose record is gone is refused
    bad = "a,old,,,s,,<SUBJ>{}</SUBJ>,,,\n"
    head = (tmp_path / "patch.csv").read_text().splitlines()[0] + "\n"
    (tmp_path / "patch.csv").write_text(head + bad.format("nobody at all"))
    assert jobs.main(["align", *at("l", "r", "p.csv"), "--no-context", "--patch", *at("patch.csv"), "--apply"]) == 1
    assert jobs.main(["align", *at("l", "r", "p.csv"), "--no-context", "--patch", *at("patch.csv"), "--apply", "--force"]) == 0
    (tmp_path / "patch.csv").write_text(head + f'a,old,,,s,,"{RECORDS[0][0][4]}",,,\n')
    assert jobs.main(["align", *at("l", "r", "p.csv"), "--no-context", "--patch", *at("patch.csv"), "--apply"]) == 0
    assert table(tmp_path / "patch.csv")[0]["left_uuid"] == "l0"


def test_learned_links(spark, tmp_path):
    left, right = (records(spark, rows, v) for rows, v in zip(RECORDS, ("a", "b"), strict=True))
    true = {("l0", "r0"), ("l1", "r2"), ("l2", "r3"), ("l3", "r4")}
    judged = spark.createDataFrame([(a, b, int((a, b) in true)) for a in ("l0", "l1", "l2") for b in ("r0", "r2", "r3")], "left_uuid string, right_uuid string, match int")
    raw, found = jobs.dedupe(left, right, judged)
    assert {(r["left_uuid"], r["right_uuid"]) for r in found.collect()} >= true and raw.count() == found.count()


def test_status(spark, tmp_path):
    import os

    for k, name in enumerate(("v.1-2.ocr.json", "v.1-2.lines.json", "v.1-2.lines.csv")):
        path = tmp_path / "v" / "1-2" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
        os.utime(path, (1000 - k, 1000 - k) if name.endswith(".csv") else (1000 + k, 1000 + k))
    row = jobs.status_table(spark, str(tmp_path)).collect()[0]
    assert (row["extract"], row["tabulate"], row["assemble"], row["next"]) == ("done", "stale", "missing", "tabulate")
    assert [r["range_name"] for r in pages.discover(spark, str(tmp_path), ".lines.csv", ["1-2"]).collect()] == ["1-2"]
    for bad in (["2-1"], ["0-3"], ["x"], ["3-4"]):
        with pytest.raises(ValueError):
            pages.discover(spark, str(tmp_path), ".lines.csv", bad)


def test_audit_of_lines(spark):
    lines = spark.createDataFrame([(d, p, p // 4, ("# " if p % 4 == 0 else "") + "abc"[p % 3] * 3, "B-TITLE" if p % 4 == 0 else "B-ENTRY") for d in ("a", "b") for p in range(24)], "document string, pos long, page int, text string, label string")
    tried = [evaluation.Experiment("production", "reference", ("bias", "heading")), evaluation.Experiment("+placebo_constant", "placebo", ("bias", "heading", "placebo_constant")), evaluation.Experiment("-heading", "ablation", ("bias",))]
    out = jobs.audit_lines(lines, ["B-ENTRY", "B-TITLE"], tried, folds=3, rounds=20, samples=50)
    accuracy = {r["experiment"]: r for r in out["accuracy"].collect()}
    assert accuracy["production"]["accuracy"] == 1.0 and accuracy["production"]["lines"] == 48 and 0.7 < accuracy["-heading"]["accuracy"] < 0.9
    told = {r["experiment"]: r["verdict"] for r in out["verdicts"].collect()}
    assert told == {"production": "neutre", "+placebo_constant": "neutre", "-heading": "dégrade"}
    assert out["interval"].first()["value"] == 1.0 and evaluation.selection(out["verdicts"], ["bias"])[1] == ["without bias (constant)"]
    names = [e.name for e in evaluation.experiments([(0.1, 0.1)])]
    assert len(names) == len(set(names)) and "only heading" in names and "c1=0.1 c2=0.1" in names


def test_learning_curve(spark):
    lines = spark.createDataFrame([("a", p, p // 4, ("# " if p % 4 == 0 else "") + "abc"[p % 3] * 3, "B-TITLE" if p % 4 == 0 else "B-ENTRY") for p in range(40)], "document string, pos long, page int, text string, label string")
    runs = evaluation.learning_runs(lines, [1, 4], 2, ["B-ENTRY", "B-TITLE"], ("bias", "heading"), rounds=20).collect()
    assert sorted((r["budget"], r["seed"], r["lines"]) for r in runs) == [(1, 1, 36), (1, 2, 36), (4, 1, 24), (4, 2, 24)] and all(r["f1"] == 1.0 for r in runs if r["budget"] == 4)


def test_pairs_of_sections(spark, tmp_path, capsys):
    side = lambda v, names: spark.createDataFrame([(v, k, s, f"{v}{k}") for k, s in enumerate(names)], "volume string, order int, section string, section_uuid string")
    side("l", ["arts", "bois", "vins"]).write.parquet(str(tmp_path / "l"))
    side("r", ["arts", "boulangers", "vins"]).write.parquet(str(tmp_path / "r"))
    at = lambda *x: [str(tmp_path / n) for n in x]
    (tmp_path / "s.csv").write_text("left_uuid,right_uuid,left_title,right_title,note\nl1,r1,,,\n")
    assert jobs.main(["sections", *at("l", "r", "out.csv"), "--patch", *at("s.csv"), "--apply"]) == 0
    assert [(r["left_section"], r["right_section"], r["source"]) for r in table(tmp_path / "out.csv")] == [("l0", "r0", "auto"), ("l1", "r1", "manual"), ("l2", "r2", "auto")]
    (tmp_path / "s.csv").write_text("left_uuid,right_uuid,left_title,right_title,note\nl1,r1,,,\nl1,r1,,,\n")
    assert jobs.main(["sections", *at("l", "r", "out.csv"), "--patch", *at("s.csv"), "--apply"]) == 1
    assert pages.parse_pair("x/1807_A__1808_B.nw.csv") == ("1807_A", "1808_B", ".nw.csv") and pages.pair_name("a", "b") == "a__b"
    for bad in ("a.csv", "a__b__c.csv", "a__b"):
        with pytest.raises(ValueError):
            pages.parse_pair(bad)
    with pytest.raises(ValueError):
        pages.pair_name("a__b", "c")


def test_train_set_and_reports(spark):
    span = lambda label: [(0, 1, label, None)]
    rows = spark.createDataFrame([(1, "a", span("SUBJ"), None), (2, "a", None, span("SUBJ")), (3, "b", None, span("ADDR")), (4, "gold", None, span("SUBJ"))], f"id int, text string, curated {layers.SPAN}, model {layers.SPAN}")
    kept, counts = jobs.train_set(rows, spark.createDataFrame([("gold",)], "text string"))
    assert [r["id"] for r in kept.collect()] == [1] and {r["state"]: r["n"] for r in counts.collect()} == {"kept": 1, "duplicate": 1, "unusable": 1, "gold": 1}
    assert reports.insert_after(["a", "b", "c"], "a", ["x", "c"]) == ["a", "x", "b", "c"]
    with pytest.raises(ValueError):
        reports.insert_after(["a"], "b", ["x"])
    assert reports.listing("Cases", ["a", "b", "c"], 2) == ["Cases (3):", "  - a", "  - b", "  ... and 1 more"]


def test_streamed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writes, "ROWS", 3)
    df = spark.range(10).select("id", F.concat(F.lit('a,"'), F.col("id").cast("string")).alias("t"))
    writes.write_csv(df, str(tmp_path / "t.csv"))
    assert table(tmp_path / "t.csv") == [{"id": str(i), "t": f'a,"{i}'} for i in range(10)]
    writes.write_json(df, str(tmp_path / "t.json"), {"n": 1})
    assert json.loads((tmp_path / "t.json").read_text()) == {"n": 1, "rows": [{"id": i, "t": f'a,"{i}'} for i in range(10)]}
    writes.write_json(df.limit(0), str(tmp_path / "e.json"))
    assert json.loads((tmp_path / "e.json").read_text()) == {"rows": []}


def test_tiles_do_not_change_links(spark, monkeypatch):
    left, right = (records(spark, rows, v) for rows, v in zip(RECORDS, ("a", "b"), strict=True))
    want = sorted(map(tuple, alignment.align(left, right)[0].collect()))
    own = [alignment.numbered(left, 0), alignment.numbered(right, 1)]
    dense = sorted(map(tuple, alignment.cells(*own, 0.5, 0.0).collect()))
    assert len(dense) == left.count() * right.count()
    assert sorted(map(tuple, alignment.cells(*own, 0.5, 0.0, (2, 2)).collect())) == dense
    monkeypatch.setattr(alignment.cells, "__defaults__", ((2, 3),))
    assert sorted(map(tuple, alignment.align(left, right)[0].collect())) == want

from foliospark.llm.licenses import OP3_SQL, find_spans, op3_license
from tests.llm.compare import same


def test_exact_and_drifting_spans(spark):
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    drift = gpl.replace("redistribute it", "redistribute it freely").replace("as published by", "published by")
    docs = spark.createDataFrame([(1, "x " + gpl), (2, drift), (3, "under the MIT license. Under the mit LICENSE"), (4, "general public license of the free world"), (5, "CC-BY-NC, cc by nc")], "doc_id long, text string")
    spans = find_spans(docs).where("label is not null").collect()
    labels = {i: {r["label"] for r in spans if r["key"] == i and r["verified"]} for i in range(1, 6)}
    assert labels == {1: {"gpl-3"}, 2: {"gpl-3"}, 3: {"mit"}, 4: set(), 5: {"cc-by-nc"}}
    assert [r["first"] for r in spans if r["key"] == 1 and r["verified"]] == [1]
    assert sorted(r["first"] for r in spans if r["key"] == 3 and r["exact"] and r["verified"]) == [0, 4]


def test_awkward_rows(spark, awkward, empty):
    got = find_spans(awkward).collect()
    assert len(got) == awkward.count() and all(r["label"] is None for r in got)
    assert {r["n_words"] for r in got if r["key"] in (0, 1, 2)} == {0}
    assert find_spans(empty).count() == 0


def test_native(spark, sf_dir):
    plan = op3_license(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, sf_dir):
    assert same(op3_license(spark, sf_dir), OP3_SQL, sf_dir)

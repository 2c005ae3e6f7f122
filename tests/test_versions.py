"""Runs that commit, their exports, and the commands."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fableloom import cli
from fableloom.plans import run
from fableloom.sources.versions import RunTables

TEXT = "¿Qué pasa hoy? La respuesta es clara. Pero hay un riesgo. Conviene parar."


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "document_id long, text string")


def test_versions_appear_together(spark, tmp_path):
    one = RunTables(spark, str(tmp_path))
    one.write(spark.range(3), "a")
    one.write(spark.range(4), "b")
    assert RunTables(spark, str(tmp_path)).read("a", "id long").count() == 0
    assert one.read("a").count() == 3
    first = one.commit(run_id="r1")
    assert first["number"] == 1 and sorted(first["tables"]) == ["a", "b"]
    two = RunTables(spark, str(tmp_path))
    two.write(spark.range(9), "a")
    assert RunTables(spark, str(tmp_path)).read("a").count() == 3
    two.commit()
    after = RunTables(spark, str(tmp_path))
    assert (after.read("a").count(), after.read("b").count(), after.manifest["number"]) == (9, 4, 2)
    assert after.drop_old() == 1 and RunTables(spark, str(tmp_path)).read("a").count() == 9
    with pytest.raises(RuntimeError, match="another writer"):
        one.write(spark.range(1), "a")
        one.commit()


def test_a_lost_run_leaves_the_one_before(spark, tmp_path, monkeypatch):
    run.run_corpus(docs(spark, TEXT), str(tmp_path), "run_1")
    before = {n: sorted(map(str, RunTables(spark, str(tmp_path)).read(n).collect())) for n in ("documents", "units", "relations", "chains", "manifest")}

    def lost(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(run.chains, "detect_chains", lost)
    with pytest.raises(OSError, match="lost"):
        run.run_corpus(docs(spark, "Otra cosa. Y otra."), str(tmp_path), "run_2")
    tables = RunTables(spark, str(tmp_path))
    assert {n: sorted(map(str, tables.read(n).collect())) for n in before} == before
    assert tables.manifest["about"]["run_id"] == "run_1"


def test_exports(spark, tmp_path):
    reply = lambda request: json.dumps({"functions": ["A"], "primary_function": "A", "confidence": 0.5})
    run.run_corpus(docs(spark, TEXT, "Nada, \"nada\"."), str(tmp_path), "run_e", reply, with_similarity=True)
    units = RunTables(spark, str(tmp_path)).read("units")
    run.evaluate_run(spark, str(tmp_path), units, "run_e")
    cli.main(["export", str(tmp_path)])
    cli.main(["export", str(tmp_path)])  # the second replaces the first
    to = tmp_path / "exports"
    lines = lambda n: [json.loads(x) for f in sorted((to / n).glob("part-*")) for x in f.read_text().splitlines()]
    assert len(lines("units.jsonl")) == units.count() == 5
    assert {len(d["units"]) for d in lines("documents.jsonl")} == {4, 1}
    for name, n in (("units", 14), ("relations", 12), ("chains", 12)):
        table = spark.read.option("header", True).option("escape", "\"").csv(str(to / f"{name}.csv"))
        assert len(table.columns) == n and table.count() == RunTables(spark, str(tmp_path)).read(name).count()
    report = json.loads((to / "evaluation.json").read_text())
    assert report["micro_f1"] == 1.0 and (to / "evaluation.md").read_text().startswith("# Evaluation\n")
    summary = json.loads((to / "audit_summary.json").read_text())
    assert summary["total_units"] == 5 and summary["total_flags"] == summary["errors"] + summary["warnings"] + summary["infos"]
    assert json.loads((to / "similarity_summary.json").read_text())["total_units"] == 5
    assert "units" in json.loads((to / "run_manifest.json").read_text())["tables"]
    assert not list(to.glob("*.tmp"))


def test_model_commands(spark, tmp_path):
    import sys

    (tmp_path / "my_transport.py").write_text(
        "import json\n\n\ndef reply(request):\n    asked = json.loads(request)\n    if 'reviewer_id' in asked or asked.get('profile') in ('aggregator', 'final'):\n        return json.dumps({'decision': 'accept', 'confidence': 0.9})\n    return json.dumps({'functions': ['K'], 'primary_function': 'K', 'confidence': 0.5 if 'risks' not in asked else 0.95})\n"
    )
    folder = str(tmp_path / "run")
    sys.path.insert(0, str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "my_transport.py"))
    try:
        run.run_corpus(docs(spark, "Subió todo. Bajó todo."), folder, "r")
        cli.main(["classify", folder, "--transport", "my_transport:reply"])
        units = RunTables(spark, folder).read("units")
        assert {(u.primary_function, u.confidence) for u in units.collect()} == {("K", 0.5)}
        cli.main(["adjudicate", folder, "--transport", "my_transport:reply"])
        assert {(u.method, u.confidence) for u in RunTables(spark, folder).read("units").collect()} == {("adjudicated", 0.95)}
        cli.main(["review", folder])
        (tmp_path / "reviewers.json").write_text('{"reviewer_id": "r1", "position": 0, "profile": "p"}\n')
        cli.main(["committee", folder, "--input", str(tmp_path / "reviewers.json"), "--transport", "my_transport:reply"])
        assert RunTables(spark, folder).read("finals").where(F.col("final_decision") == "accept").count() > 0
        with pytest.raises(SystemExit):
            cli.main(["classify", folder])
    finally:
        sys.path.remove(str(tmp_path))
    assert Path(folder, "_manifests").exists()

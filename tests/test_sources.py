import json

import pytest

from fableloom.operators.segment import segment_texts, segment_timed
from fableloom.plans import run
from fableloom.sources import sinks, transcripts


def test_folder_walk_prefers_segments_and_stops(spark, tmp_path):
    for name in ("a/transcript.txt", "a/transcript.json", "a/deep/other.txt", "b/notes.txt", "b/transcript_metadata.json", "c/transcript_insights.json"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("{}" if name.endswith("json") else "x")
    found = {r.path.split(f"{tmp_path.name}/")[1] for r in transcripts.list_transcripts(spark, str(tmp_path)).collect()}
    assert found == {"a/transcript.json", "b/notes.txt"}


def test_json_and_jsonl(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"document_id": "j", "segments": [{"start": 1, "end": 2.5, "text": "Hola."}, {"text": " "}], "language": "es"}))
    docs, segments = transcripts.documents_and_segments(transcripts.read_json_files(spark, str(tmp_path / "one.json")))
    assert docs.first().document_id == "j" and docs.first().language == "es"
    assert [(s.start_ms, s.end_ms, s.text) for s in segments.collect()] == [(1000, 2500, "Hola.")]
    (tmp_path / "many.jsonl").write_text('{"document_id": "x", "transcript": "Uno. Dos."}\n{"document_id": "y"}\n')
    rows = transcripts.read_jsonl_files(spark, str(tmp_path / "many.jsonl"))
    assert transcripts.is_segment_file(rows).count() == 0
    docs, _ = transcripts.documents_and_segments(rows)
    assert sorted((d.document_id, d.text, d.language) for d in docs.collect()) == [("x", "Uno. Dos.", "und"), ("y", "", "und")]
    assert segment_texts(docs.select("document_id", "text")).count() == 2
    (tmp_path / "seg.jsonl").write_text('{"video_id": "v", "start_seconds": 0, "end_seconds": 1.5, "text": "Uno."}\n{"video_id": "v", "start_seconds": 1.5, "end_seconds": 20000, "text": "Dos."}\n')
    rows = transcripts.read_jsonl_files(spark, str(tmp_path / "seg.jsonl"))
    assert transcripts.is_segment_file(rows).count() == 1
    found = segment_timed(transcripts.segment_rows(rows)).orderBy("sequence_index").collect()
    assert [(u.unit_id, u.start_ms, u.end_ms) for u in found] == [("v_u00000", 0, 1500), ("v_u00001", 1500, 20000000)]


def test_load_transcripts(spark, tmp_path):
    files = {
        "a/transcript.txt": "Primera idea. Segunda idea?",
        "a/transcript_metadata.json": json.dumps({"video_id": "vid", "language": "es"}),
        "b/one.json": json.dumps({"document_id": "j", "segments": [{"start": 1, "end": 2.5, "text": "Hola."}], "language": "pt"}),
        "c/many.jsonl": '{"document_id": "x", "transcript": "Uno. Dos."}\n{"document_id": "y", "transcript": "Tres."}\n',
        "d/transcript_segments.jsonl": '{"video_id": "v", "start_seconds": 0, "end_seconds": 1.5, "text": "Uno."}\n{"video_id": "v", "start_seconds": 1.5, "end_seconds": 3, "text": "Dos."}\n',
    }
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    docs, segments = transcripts.load_transcripts(spark, str(tmp_path))
    assert sorted((d.document_id, d.source_type, d.language) for d in docs.collect()) == [("j", "json", "pt"), ("v", "jsonl", "und"), ("vid", "txt", "es"), ("x", "jsonl", "und"), ("y", "jsonl", "und")]
    assert sorted((s.document_id, s.start_ms) for s in segments.collect()) == [("j", 1000), ("v", 0), ("v", 1500)]
    out = run.run_corpus(docs, str(tmp_path / "out"), "run_s", segments=segments)
    assert {(u.document_id, u.start_ms) for u in out["units"].collect()} == {("vid", None), ("x", None), ("y", None), ("j", 1000), ("v", 0), ("v", 1500)}
    assert {(r.document_id, r.unit_count, r.has_timestamps) for r in out["document_rollups"].collect()} == {("vid", 2, False), ("x", 2, False), ("y", 1, False), ("j", 1, True), ("v", 2, True)}
    assert [d.document_id for d in transcripts.load_transcripts(spark, str(tmp_path), 1)[0].collect()] == ["vid"]
    assert transcripts.load_transcript(spark, str(tmp_path / "b" / "one.json"))[0].first().document_id == "j"
    with pytest.raises(ValueError, match="more than one"):
        transcripts.load_transcript(spark, str(tmp_path))
    with pytest.raises(ValueError, match="unsupported"):
        transcripts.load_transcripts(spark, str(tmp_path / "x.pdf"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "none.json").write_text('{"document_id": "z"}')
    with pytest.raises(Exception, match="needs text or segments"):
        transcripts.load_transcripts(spark, str(tmp_path / "bad"))[0].collect()


def test_text_and_sidecars(spark, tmp_path):
    (tmp_path / "transcript.txt").write_text("Primera idea. Segunda idea?")
    (tmp_path / "transcript_metadata.json").write_text('{"video_id": "q"}')
    docs = transcripts.with_sidecars(transcripts.read_text_files(spark, str(tmp_path / "transcript.txt")), spark, str(tmp_path)).first()
    assert docs.text.startswith("Primera") and json.loads(docs.source_metadata)["video_id"] == "q" and docs.source_insights is None


def test_sinks(spark, tmp_path):
    own = spark.createDataFrame([("d", 1, ["A", "B"], None, "B_N0{0}"), ("d", 0, [], 1, "A_N0{0}")], "document_id string, sequence_index int, functions array<string>, n int, final_notation string")
    sinks.write_jsonl(own, str(tmp_path / "j"))
    lines = [json.loads(x) for p in (tmp_path / "j").glob("part-*") for x in p.read_text().splitlines()]
    assert len(lines) == 2 and all("n" in x for x in lines)
    assert sinks.notation_sequences(own).first().sequence == "A_N0{0} B_N0{0}"
    sinks.write_csv(own, str(tmp_path / "c"))
    assert "A+B" in "".join(p.read_text() for p in (tmp_path / "c").glob("part-*"))
    sinks.write_table(own, str(tmp_path), "units")
    assert sinks.read_table(spark, str(tmp_path), "units").count() == 2
    assert sinks.read_table(spark, str(tmp_path), "missing", "a int").count() == 0


def test_lines_keep_their_order_and_place(spark, tmp_path):
    """A segment file without segment_index, read in many blocks."""
    n = 4000
    lines = [json.dumps({"video_id": "v", "start_seconds": i, "end_seconds": i + 1, "text": f"Frase {i} " + "x" * (i % 90)}) for i in range(n)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines[:100]) + "\n\n" + "\n".join(lines[100:]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert spark.read.text(str(tmp_path / "a.jsonl")).rdd.getNumPartitions() >= 16
        rows = transcripts.read_jsonl_files(spark, str(tmp_path / "a.jsonl"))
        found = {r.line: r.text for r in rows.collect()}
        assert sorted(found) == [*range(1, 101), *range(102, n + 2)]
        assert all(found[i + 1 if i < 100 else i + 2].startswith(f"Frase {i} ") for i in range(n))
        docs, segments = transcripts.load_transcripts(spark, str(tmp_path))
        text = docs.first().text
        assert [int(w) for w in text.split() if w.isdigit()] == list(range(n))
        assert segments.count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("bad", ["{", "[1]", "3", '{"text": '])
def test_bad_lines_are_named(spark, tmp_path, bad):
    (tmp_path / "a.jsonl").write_text('{"text": "uno"}\n\n' + bad + "\n")
    with pytest.raises(Exception, match=r"a\.jsonl:3"):
        transcripts.read_jsonl_files(spark, str(tmp_path / "a.jsonl")).collect()


def test_a_file_without_records_fails(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "uno"}\n')
    assert transcripts.load_transcripts(spark, str(tmp_path))[0].count() == 1
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "none.jsonl").write_text("\n \n")
    with pytest.raises(Exception, match="holds no record"):
        transcripts.load_transcripts(spark, str(tmp_path))[0].collect()

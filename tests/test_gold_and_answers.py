"""Gold of mixed shapes, and answers that keep a schema."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fableloom.functions.contracts import json_schema, mismatch
from fableloom.operators import evaluate, heuristics, model_calls
from test_operators import units

UNIT = {"unit_id": "u1", "functions": ["A"], "primary_function": "A", "emotion_intensity": 1, "text": "t"}


def of(spark, path, *records):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n", encoding="utf-8")
    return evaluate.gold_records(evaluate.gold_lines(spark, str(path)))


def test_one_file_of_all_shapes(spark, tmp_path):
    shapes = [{"gold_id": "g", "gold_type": "human_gold", "unit": UNIT}, "", {"status": "synthetic_gold_high_confidence", "unit": UNIT | {"unit_id": "u2"}}, {"unit": UNIT | {"unit_id": "u3"}}, UNIT | {"unit_id": "u4", "confidence": 0.5}]
    rows = {r.unit_id: r for r in of(spark, tmp_path / "gold.jsonl", *shapes).collect()}
    assert sorted(rows) == ["u1", "u2", "u3", "u4"] and not any(r.problem for r in rows.values())
    assert [rows[f"u{i}"].line for i in (1, 2, 3, 4)] == [1, 3, 4, 5]
    assert rows["u4"].confidence == 0.5 and rows["u1"].functions == ["A"] and rows["u1"].emotion_intensity == 1
    assert evaluate.read_gold(spark, str(tmp_path / "gold.jsonl")).count() == 4


@pytest.mark.parametrize(
    ("record", "problem"),
    [
        ({"gold_type": "synthetic_gold_medium_confidence", "unit": UNIT}, "not usable as gold: synthetic_gold_medium_confidence"),
        ({"gold_type": None, "unit": UNIT}, "not usable as gold: null"),
        ({"status": "human_gold", "unit": UNIT}, "not usable as gold: human_gold"),
        ({"status": "rejected", "unit": UNIT}, "not usable as gold: rejected"),
        ("no json", "no JSON object"),
        ("[1]", "no JSON object"),
        ({"unit": {"unit_id": "u"}}, "functions is missing"),
        (UNIT | {"functions": 3}, "functions is not of type"),
        (UNIT | {"primary_function": None}, "primary_function is missing"),
        (UNIT | {"emotion_intensity": "much"}, "emotion_intensity is not of type int"),
    ],
)
def test_bad_records_are_named(spark, tmp_path, record, problem):
    path = tmp_path / "gold.jsonl"
    (row,) = of(spark, path, UNIT, record).where("problem IS NOT NULL").collect()
    assert row.line == 2 and row.file.endswith("gold.jsonl") and row.problem.startswith(problem)
    with pytest.raises(Exception, match=r"gold\.jsonl:2: "):
        evaluate.read_gold(spark, str(path)).collect()


def test_empty_gold(spark, tmp_path):
    assert of(spark, tmp_path / "gold.jsonl", "", " ").count() == 0


def test_answers_against_a_schema():
    kind = model_calls.CLASSIFICATION
    good = {"functions": ["A"], "confidence": 1, "evidence_spans": [{"text": "x", "char_start": 0}]}
    assert mismatch(kind, good) is None and mismatch(kind, good | {"stance": None}) is None
    for change, place in (({"more": 1}, r"$: unknown field more"), ({"functions": None}, "$.functions: missing"), ({"functions": [1]}, "$.functions[0]: not a string"), ({"confidence": True}, "$.confidence: not a number"), ({"emotion_intensity": 1.5}, "$.emotion_intensity: not a integer"), ({"evidence_spans": [{}]}, "$.evidence_spans[0].text: missing"), ({"evidence_spans": {}}, "$.evidence_spans: not an array")):
        assert mismatch(kind, good | change) == place
    assert mismatch(kind, []) == "$: not an object"
    assert mismatch(T.MapType(T.StringType(), T.LongType()), {"a": "b"}) == "$.a: not a integer"
    assert json_schema(kind)["required"] == ["functions"]


def test_profile_is_part_of_the_key_and_of_usage(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    folder = str(log)

    def transport(request):
        import os

        open(f"{folder}/{os.urandom(8).hex()}", "w").write(request)
        own = json.loads(request)
        reply = {"functions": ["A"], "primary_function": "A", "confidence": 0.9}
        if "malo" in own["input"]["text"]:
            reply["opinion"] = "more than was asked for"
        return json.dumps(reply), {"input_tokens": len(request), "output_tokens": 7}

    own = heuristics.annotate(units(spark, ("N", "algo"), ("N", "malo")))
    one = model_calls.Profile("classifier", "m1", schema=model_calls.CLASSIFICATION)
    store = str(tmp_path / "answers")
    calls = lambda: len(list(log.iterdir()))
    found = {r.unit_id: r for r in model_calls.classify(own, transport, store=store, profile=one).collect()}
    assert found["u0"].method == "llm" and found["u1"].method == "heuristic" and calls() == 2
    assert not found["u0"].llm_usage.cached and found["u0"].llm_usage.output_tokens == 7 and found["u0"].llm_usage.input_tokens > 100
    sent = json.loads(next(log.iterdir()).read_text())
    assert sent["model"] == "m1" and sent["profile"] == "classifier" and sent["schema"]["additionalProperties"] is False
    again = {r.unit_id: r for r in model_calls.classify(own, transport, store=store, profile=one).collect()}
    assert again["u0"].llm_usage.cached and again["u0"].llm_usage.input_tokens is None and calls() == 3  # the refused one alone
    for other in (model_calls.Profile("classifier", "m1", "v9", model_calls.CLASSIFICATION), model_calls.Profile("classifier", "m2", schema=model_calls.CLASSIFICATION), model_calls.Profile("classifier", "m1")):
        before = calls()
        model_calls.classify(own, transport, store=store, profile=other).collect()
        assert calls() == before + 2


def test_without_a_store_nothing_is_asked_twice(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    folder = str(log)

    def transport(request):
        import os

        open(f"{folder}/{os.urandom(8).hex()}", "w").close()
        return '{"decision": "accept", "confidence": 0.9}' if '"r1"' in request else "nothing"

    items = spark.createDataFrame([("i1", "a"), ("i2", "b")], "review_item_id string, text string")
    reviewers = spark.createDataFrame([("r1", 0, "p"), ("r2", 1, "p")], "reviewer_id string, position int, profile string")
    votes, failures = model_calls.review_by_committee(items, reviewers, transport)
    assert votes.count() == 2 and failures.count() == 2 and votes.count() == 2
    assert len(list(log.iterdir())) == 4


def test_profiles_of_a_configuration():
    found = model_calls.profiles_from_config({"default_model": "m", "profiles": {"a": {}, "b": {"model": "n", "temperature": 0.5, "prompt_version": "v2"}}})
    assert found["a"] == model_calls.Profile("a", "m") and found["b"] == model_calls.Profile("b", "n", "v2", None, 0.5)
    with pytest.raises(ValueError, match="unknown setting colour"):
        model_calls.profiles_from_config({"default_model": "m", "profiles": {"a": {"colour": 1}}})
    with pytest.raises(ValueError, match="no model"):
        model_calls.profiles_from_config({"profiles": {"a": {}}})

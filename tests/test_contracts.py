import pytest
from pyspark.sql import functions as F

from fableloom.functions import contracts
from fableloom.operators import guidance

UNIT = "unit_id string, text string, sequence_index int, functions array<string>, primary_function string, secondary_functions array<string>, certainty string, stance string, emotion_expressed string, emotion_intensity int, confidence double"


@pytest.mark.parametrize(
    ("place", "value", "wanted"),
    [
        (None, None, []),
        (0, "", ["empty_id"]),
        (3, ["A", "A"], ["repeated_functions"]),
        (3, ["A", "N"], ["n_not_alone"]),
        (3, ["K"], ["primary_not_in_functions"]),
        (5, ["A"], ["primary_in_secondary"]),
        (6, "maybe", ["unknown_certainty"]),
        (9, 4, ["intensity_out_of_range"]),
        (10, 1.5, ["confidence_out_of_range"]),
        (3, None, ["no_functions"]),
    ],
)
def test_units(spark, place, value, wanted):
    row = ["u", "t", 0, ["A"], "A", ["D"], "none", "neutral", "N", 0, 0.5]
    if place is not None:
        row[place] = value
    good, bad = contracts.split_by_contract(spark.createDataFrame([tuple(row)], UNIT), contracts.unit_violations())
    assert [r.violations for r in bad.collect()] == ([wanted] if wanted else []) and good.count() == int(not wanted)


def test_relations_chains_fields_and_schema(spark):
    r = spark.createDataFrame([("r", "a", "a", "XXX", 2.0)], "relation_id string, source_unit_id string, target_unit_id string, relation_type string, confidence double")
    assert r.select(contracts.relation_violations()).first()[0] == ["same_ends", "unknown_type", "confidence_out_of_range"]
    c = spark.createDataFrame([("c", ["a", "b"], "a", "z", 0.5)], "chain_id string, unit_ids array<string>, start_unit_id string, end_unit_id string, score double")
    assert c.select(contracts.chain_violations()).first()[0] == ["end_not_in_units"]
    assert spark.range(1).select(contracts.unknown_fields(F.lit('{"a": 1, "z": 2}'), ["a"])).first()[0] == ["z"]
    schema = contracts.json_schema(c.schema)
    assert schema["properties"]["unit_ids"] == {"type": "array", "items": {"type": "string"}} and schema["additionalProperties"] is False


def test_guidance(spark):
    items = spark.createDataFrame([(1, ["A", "K"], ["two"]), (2, ["Z"], [])], "i int, labels array<string>, section_ids array<string>")
    rules = spark.createDataFrame([("A", "a"), ("K", "k"), ("X", "x")], "code string, definition string")
    pairs = spark.createDataFrame([("p1", ["X"]), ("p2", ["K"])], "pair_id string, confusable_labels array<string>")
    sections = guidance.tree_sections(spark, "# Top\n## one a\nfirst\n## two b\nsecond\n")
    found = {r.i: r for r in guidance.with_tree(guidance.with_minimal_pairs(guidance.with_rules(items, rules), pairs), sections).collect()}
    assert [r.code for r in found[1].rules] == ["A", "K"] and found[2].rules == []
    assert [p.pair_id for p in found[1].minimal_pairs] == ["p2"] and [p.pair_id for p in found[2].minimal_pairs] == ["p1", "p2"]
    assert found[1].decision_tree == "## two b\nsecond" and found[2].decision_tree == ""

"""Vectors by providers and their table."""

import os

import pytest
from pyspark.sql import functions as F

from fableloom.operators import embeddings
from fableloom.operators.model_calls import TransientError


def counting(folder, kind="length"):
    """A provider that leaves a file a call with the texts it was asked for."""

    def provider(texts):
        with open(f"{folder}/{os.urandom(8).hex()}", "w") as f:
            f.write("\n".join(texts))
        return [[float(len(t)), 1.0] if kind == "length" else [0.0, float(len(t)), 2.0] for t in texts]

    return provider


def asked(folder):
    return sorted(t for f in os.listdir(folder) for t in open(f"{folder}/{f}").read().split("\n"))


def test_each_text_is_asked_once(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    store, calls = str(tmp_path / "vectors"), str(tmp_path / "calls")
    texts = spark.createDataFrame([(1, "uno"), (2, "dos!"), (3, "uno"), (4, None)], "k int, t string")
    first = embeddings.embed_texts(texts, "k", "t", counting(calls), "p1", store, batch=2, parallel=1)
    assert sorted((r.k, r.vector[0]) for r in first.collect()) == [(1, 3.0), (2, 4.0), (3, 3.0), (4, 0.0)]
    assert asked(calls) == ["", "dos!", "uno"] and len(os.listdir(calls)) == 2
    more = texts.union(spark.createDataFrame([(5, "cinco")], texts.schema))
    second = embeddings.embed_texts(more, "k", "t", counting(calls), "p1", store)
    assert second.count() == 5 and asked(calls) == ["", "cinco", "dos!", "uno"]

    def never(texts):
        raise AssertionError("asked again")

    again = embeddings.embed_texts(more, "k", "t", never, "p1", store)
    assert {r.k: r.vector for r in again.collect()} == {r.k: r.vector for r in second.collect()}


def test_vectors_of_two_providers_do_not_mix(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    store = str(tmp_path / "vectors")
    texts = spark.createDataFrame([(1, "uno")], "k int, t string")
    made = {p: embeddings.embed_texts(texts, "k", "t", counting(tmp_path / "calls", kind), p, store).first().vector for p, kind in (("p1", "length"), ("p2", "other"))}
    assert made == {"p1": [3.0, 1.0], "p2": [0.0, 3.0, 2.0]}
    assert len(os.listdir(tmp_path / "calls")) == 2


def test_wrong_and_failing_providers(spark, tmp_path):
    texts = spark.createDataFrame([(1, "uno"), (2, "dos")], "k int, t string")
    with pytest.raises(Exception, match="1 vectors"):
        embeddings.embed_texts(texts, "k", "t", lambda t: [[1.0]], "p", str(tmp_path / "a"), parallel=1)
    with pytest.raises(Exception, match="lengths"):
        embeddings.embed_texts(texts, "k", "t", lambda t: [[1.0] * (i + 1) for i in range(len(t))], "p", str(tmp_path / "b"), parallel=1)
    flag = str(tmp_path / "failed")

    def busy(texts):
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise TransientError("busy")
        return [[1.0]] * len(texts)

    assert embeddings.embed_texts(texts, "k", "t", busy, "p", str(tmp_path / "c"), parallel=1, backoff=(0.0, 0.0)).count() == 2


def test_local_vectors_and_configuration(spark, tmp_path):
    texts = spark.createDataFrame([("a", "uno dos"), ("b", "¡!"), ("c", "Uno, dos")], "k string, t string")
    local = {r.k: r.vector for r in embeddings.vectors_from_config({}, texts, "k", "t", str(tmp_path)).collect()}
    assert {len(v) for v in local.values()} == {128} and local["a"] == local["c"] and not any(local["b"])
    small = embeddings.vectors_from_config({"embedding": {"provider": "local", "dimensions": 16}}, texts, "k", "t", str(tmp_path))
    assert {len(r.vector) for r in small.collect()} == {16}
    named = {"embedding": {"provider": "tests_provider:lengths", "model": "m1"}}
    (tmp_path / "tests_provider.py").write_text("def lengths(texts, model):\n    return [[float(len(t)), float(len(model))] for t in texts]\n")
    import sys

    sys.path.insert(0, str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "tests_provider.py"))
    try:
        found = embeddings.vectors_from_config(named, texts, "k", "t", str(tmp_path / "store"))
        assert {r.k: r.vector for r in found.collect()} == {"a": [7.0, 2.0], "b": [2.0, 2.0], "c": [8.0, 2.0]}
        assert spark.read.parquet(str(tmp_path / "store")).select("provider_id").distinct().first()[0] == "tests_provider:lengths_m1"
    finally:
        sys.path.remove(str(tmp_path))
    with pytest.raises(ValueError, match="package.module:function"):
        embeddings.named_function("no_function")


def test_a_second_audit_asks_for_nothing(spark, tmp_path):
    from fableloom.plans import run
    from fableloom.sources import sinks
    from fableloom.sources.versions import RunTables

    (tmp_path / "counting_provider.py").write_text(
        "import os\n\n\ndef vectors(texts, folder):\n    open(os.path.join(folder, os.urandom(8).hex()), 'w').close()\n    return [[1.0, float(len(t) % 2)] for t in texts]\n"
    )
    import sys

    sys.path.insert(0, str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "counting_provider.py"))
    (tmp_path / "calls").mkdir()
    rows = [("a", 0, "a0", "uno", ["A"], "A"), ("a", 1, "a1", "dos", ["K"], "K"), ("b", 0, "b0", "tres", ["K"], "K")]
    units = spark.createDataFrame(rows, "document_id string, sequence_index int, unit_id string, text string, functions array<string>, primary_function string")
    units = units.withColumns({"certainty": F.lit("none"), "emotion_expressed": F.lit("N"), "stance": F.lit("neutral"), "emotions_mentioned": F.array().cast("array<string>"), "confidence": F.lit(0.8)})
    sinks.write_table(units, str(tmp_path / "run"), "units")
    config = {"embedding": {"provider": "counting_provider:vectors", "model": str(tmp_path / "calls")}}
    try:
        one = run.audit_run(spark, str(tmp_path / "run"), "r", 0.5, 10, config).count()
        calls = len(os.listdir(tmp_path / "calls"))
        two = run.audit_run(spark, str(tmp_path / "run"), "r", 0.5, 10, config).count()
        assert one == two == 1 and 0 < calls == len(os.listdir(tmp_path / "calls"))
        row = RunTables(spark, str(tmp_path / "run")).read("similarity_summary").first()
        assert (row.total_units, row.total_conflicts, row.total_pairs_considered) == (3, 1, 2) and row.conflicts_by_type == {"likely_inconsistency": 1}
    finally:
        sys.path.remove(str(tmp_path))

"""Documents cut over tasks give what they give whole."""

import random

import pytest
from pyspark.sql import functions as F

from fableloom.operators import chains, relations, segment

KEYS = ("P", "R", "A", "Y", "D", "E", "C", "X", "S", "V", "Z", "L", "I", "K", "T", "M")


def long_units(spark, n=400):
    rng = random.Random(11)
    words = ("porque sí", "pero no", "riesgo", "¿qué?", "la respuesta", "nada", "conviene", "si llueve", "falso")
    rows = [(d, i, f"{d}_{i}", rng.choice(words), [rng.choice(KEYS) for _ in range(rng.randrange(1, 3))]) for d, m in (("long", n), ("one", 1), ("seven", 7), ("eight", 8)) for i in range(m)]
    made = spark.createDataFrame(rows, "document_id string, sequence_index int, unit_id string, text string, functions array<string>")
    return made.withColumns({"normalized_text": F.col("text"), "final_notation": F.array_join("functions", "+")}).repartition(5)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", [5, 7, 64])
def test_cuts_change_nothing(spark, size):
    units = long_units(spark)
    assert rows_of(relations.detect_relations(units, "r", size=size)) == rows_of(relations.detect_relations(units, "r"))
    assert rows_of(chains.sequence_chains(units, size=max(size, 5))) == rows_of(chains.sequence_chains(units))
    beside = lambda order: {"before": segment.around(order, 2, 1), "after": segment.around(order, -1, -2)}
    assert rows_of(segment.with_neighbours(units, 2, 2, beside, size)) == rows_of(segment.with_neighbours(units, 2, 2, beside, 10_000))


@pytest.mark.parametrize("size", [1, 3, 50])
def test_timed_units_are_numbered_over_cuts(spark, size):
    rng = random.Random(2)
    rows = [(d, i, ". ".join(f"Frase {k} larga" for k in range(rng.randrange(0, 4))), i * 1000, i * 1000 + 900) for d in ("a", "b") for i in rng.sample(range(300), 120)]
    segments = spark.createDataFrame(rows, "document_id string, segment_index long, text string, start_ms long, end_ms long").repartition(4)
    cut, whole = (segment.segment_timed(segments, size=s) for s in (size, 1 << 30))
    assert rows_of(cut) == rows_of(whole)
    own = sorted((r.document_id, r.sequence_index, r.unit_count) for r in cut.collect())
    assert all(n == sum(x[0] == d for x in own) for d, _, n in own)
    assert [i for d, i, _ in own if d == "a"] == list(range(sum(d == "a" for d, _, _ in own)))


def test_a_long_document_is_spread_over_tasks(spark):
    """No task holds more than a few cuts of the one document, and no exchange is by document alone."""
    units = spark.range(20_000).select(F.lit("d").alias("document_id"), F.col("id").cast("int").alias("sequence_index"), F.lit("porque").alias("text"))
    made = segment.with_neighbours(units, 1, 1, lambda order: {"context": F.lag("text").over(order)}, size=500)
    assert made.where("context IS NULL").count() == 1 and made.count() == 20_000
    by_cut = segment.with_halo(units, 3, 3, 500).repartition(16, "document_id", segment.CUT)
    sizes = [r[0] for r in by_cut.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= 8 and max(sizes) <= 20_240 / 3


def test_what_is_seen_must_fit_a_cut(spark):
    with pytest.raises(ValueError, match="as long as"):
        segment.with_halo(long_units(spark), 6, 0, 5)

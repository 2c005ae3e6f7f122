"""Predictions against gold, and audit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.notation import jaccard, same_set
from .validate import flag_summary

LABEL_COLUMNS = ("functions", "primary_function", "emotion_expressed", "emotion_intensity", "stance", "certainty", "final_notation")


def gold_units(records: DataFrame) -> DataFrame:
    """Units of gold records: (gold_type or status, unit), unit alone, or bare units. A record that is neither human nor of high synthetic confidence fails."""
    if "unit" not in records.columns:
        records = records.select(*[c for c in ("gold_type", "status") if c in records.columns], F.struct(*[c for c in records.columns if c not in ("gold_type", "status")]).alias("unit"))
    kind = F.coalesce(*[F.col(c) for c in ("gold_type", "status") if c in records.columns], F.lit("human_gold"))
    allowed = kind.isin("human_gold", "synthetic_gold_high_confidence")
    checked = records.withColumn("unit", F.when(allowed, F.col("unit")).otherwise(F.raise_error(F.concat(F.lit("not usable as gold: "), kind)).cast(records.schema["unit"].dataType)))
    return checked.select("unit.*")


#: The fields of a gold unit that evaluation knows, and those that it cannot do without.
GOLD_FIELDS = {
    "unit_id": "string", "document_id": "string", "sequence_index": "int", "text": "string", "functions": "array<string>", "primary_function": "string", "secondary_functions": "array<string>", "certainty": "string",
    "emotion_expressed": "string", "emotion_intensity": "int", "emotions_mentioned": "array<string>", "stance": "string", "confidence": "double", "final_notation": "string", "needs_review": "boolean",
}
GOLD_NEEDS = ("unit_id", "functions", "primary_function")


def gold_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1) and value of the lines of gold files that hold anything. Gold is made by hand or by a committee: one task reads a file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("at", "value"))
    return files.where(F.trim("value") != "").select("file", (F.col("at") + 1).alias("line"), "value")


def gold_records(lines: DataFrame) -> DataFrame:
    """file, line, problem and the fields of a unit for each of lines(file, line, value), of whichever shape each is.

    A record has a unit and a gold_type, or a unit and a status, or a unit alone,
    or is a bare unit: rows are told apart by their own fields, so one file may mix
    them. problem says why a record cannot be used: no JSON object, a kind of gold
    that is no measure, a field that is missing or of another type.
    """
    record = F.try_parse_json("value")
    own = lines.select("file", "line", record.alias("r"), F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>")).alias("keys"))
    has = lambda k: F.array_contains("keys", k)
    kind = F.when(has("gold_type"), F.try_variant_get("r", "$.gold_type", "string")).when(has("status") & has("unit"), F.try_variant_get("r", "$.status", "string"))
    allowed = F.when(has("gold_type"), F.coalesce(kind.isin("human_gold", "synthetic_gold_high_confidence"), F.lit(False))).when(has("status") & has("unit"), F.coalesce(kind == "synthetic_gold_high_confidence", F.lit(False))).otherwise(F.lit(True))
    unit = F.when(has("gold_type") | has("unit"), F.try_variant_get("r", "$.unit", "variant")).otherwise(F.col("r"))
    taken = own.select("file", "line", "r", "keys", kind.alias("kind"), allowed.alias("allowed"), unit.alias("u"))
    typed = taken.select("*", *[F.try_variant_get("u", f"$.{n}", t).alias(n) for n, t in GOLD_FIELDS.items()])
    there = lambda n: F.try_variant_get("u", f"$.{n}", "variant").isNotNull() & ~F.coalesce(F.is_variant_null(F.try_variant_get("u", f"$.{n}", "variant")), F.lit(False))
    wrong = F.when(F.col("r").isNull() | (F.size("keys") == 0), F.lit("no JSON object")).when(~F.col("allowed"), F.concat(F.lit("not usable as gold: "), F.coalesce("kind", F.lit("null"))))
    for n, t in GOLD_FIELDS.items():
        wrong = wrong.when(there(n) & F.col(n).isNull(), F.lit(f"{n} is not of type {t}"))
        wrong = wrong.when(F.col(n).isNull(), F.lit(f"{n} is missing")) if n in GOLD_NEEDS else wrong
    return typed.select("file", "line", wrong.alias("problem"), *GOLD_FIELDS)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The units of gold files of JSON lines; the first record that cannot be used fails, with its file, line and problem."""
    found = gold_records(gold_lines(spark, path))
    place = F.concat(F.lit("invalid gold record at "), "file", F.lit(":"), F.col("line").cast("string"), F.lit(": "), "problem")
    return found.where(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(place).cast("boolean"))).select(*GOLD_FIELDS)


def last_by_unit(units: DataFrame, order: str) -> DataFrame:
    """Of repeated unit_ids the last row by ``order``."""
    return units.groupBy("unit_id").agg(F.max_by(F.struct(*units.columns), order).alias("u")).select("u.*")


def matched(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """p and g of all gold rows with a prediction."""
    return predictions.select(F.col("unit_id"), F.struct(*predictions.columns).alias("p")).join(gold.select("unit_id", F.struct(*gold.columns).alias("g")), "unit_id")


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1, the last from the rounded others."""
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return p, r, F.when(p + r > 0, F.round(2 * p * r / (p + r), 4)).otherwise(F.lit(0.0))


def label_metrics(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """label, tp, fp, fn, precision, recall and f1 of every label on either side.

    Gold without a prediction counts its labels as missed; predictions without
    gold only bring their labels in.
    """
    side = gold.select("unit_id", F.explode(F.array_distinct("functions")).alias("label"), F.lit(1).alias("g"), F.lit(0).alias("p"))
    known = gold.select("unit_id").distinct()
    other = predictions.select("unit_id", F.explode(F.array_distinct("functions")).alias("label"), F.lit(0).alias("g"), F.lit(1).alias("p"))
    scored = other.join(known.withColumn("in_gold", F.lit(True)), "unit_id", "left").withColumn("in_gold", F.coalesce("in_gold", F.lit(False)))
    cells = side.withColumn("in_gold", F.lit(True)).unionByName(scored).groupBy("unit_id", "label", "in_gold").agg(F.max("g").alias("g"), F.max("p").alias("p"))
    hit = lambda c: F.count_if(c & F.col("in_gold"))
    counts = cells.groupBy("label").agg(
        hit((F.col("g") == 1) & (F.col("p") == 1)).alias("tp"), hit((F.col("g") == 0) & (F.col("p") == 1)).alias("fp"), hit((F.col("g") == 1) & (F.col("p") == 0)).alias("fn")
    )
    p, r, f1 = prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.withColumns({"precision": p, "recall": r}).withColumn("f1", f1)


def run_metrics(predictions: DataFrame, gold: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """One row of counts and rates; rates over no rows are 0."""
    p, g = F.col("p"), F.col("g")
    both = matched(predictions, gold)
    shared = F.size(F.array_intersect(p["functions"], g["functions"]))
    pairs = both.agg(
        F.count(F.lit(1)).alias("matched_units"),
        F.count_if(same_set(p["functions"], g["functions"])).alias("exact"),
        *[F.count_if(p[c] == g[c]).alias(f"same_{c}") for c in ("primary_function", "emotion_expressed", "stance", "certainty")],
        F.sum(F.abs(p["emotion_intensity"] - g["emotion_intensity"])).alias("intensity_error"),
        F.sum(F.round(jaccard(p["functions"], g["functions"]), 4)).alias("jaccard"),
        F.count_if((p["final_notation"] == g["final_notation"]) & ~p["needs_review"]).alias("regression"),
        F.coalesce(F.sum(shared), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.size(F.array_except(p["functions"], g["functions"]))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.size(F.array_except(g["functions"], p["functions"]))), F.lit(0)).alias("fn"),
    )
    of_predictions = predictions.agg(
        F.count(F.lit(1)).alias("total_predicted_units"),
        F.count_if(F.size("functions") > 5).alias("over"),
        F.count_if(F.array_contains("functions", "N")).alias("n"),
        F.coalesce(F.sum(F.size("validator_flags")), F.lit(0)).alias("flags"),
        F.count_if("needs_review").alias("review"),
    )
    of_gold = gold.agg(F.count(F.lit(1)).alias("total_gold_units"))
    missing = gold.select("unit_id").distinct().join(predictions, "unit_id", "left_anti").agg(F.count(F.lit(1)).alias("missing_predictions"))
    extra = predictions.select("unit_id").distinct().join(gold, "unit_id", "left_anti").agg(F.count(F.lit(1)).alias("unexpected_predictions"))
    macro = label_metrics(predictions, gold).agg(F.coalesce(F.round(F.avg("f1"), 4), F.lit(0.0)).alias("macro_f1"))
    found = conflicts.agg(F.count(F.lit(1)).alias("conflicts")) if conflicts is not None else predictions.sparkSession.range(1).select(F.lit(0).alias("conflicts"))
    # One row each, so these products are one row too.
    one = pairs.crossJoin(of_predictions).crossJoin(of_gold).crossJoin(missing).crossJoin(extra).crossJoin(macro).crossJoin(found)
    m, t = F.col("matched_units"), F.col("total_predicted_units")
    return one.select(
        "total_gold_units", "total_predicted_units", "matched_units", "missing_predictions", "unexpected_predictions",
        ratio(F.col("exact"), m).alias("functions_exact_match"),
        ratio(F.col("same_primary_function"), m).alias("primary_function_accuracy"),
        ratio(F.col("jaccard"), m).alias("multilabel_jaccard"),
        prf(F.col("tp"), F.col("fp"), F.col("fn"))[2].alias("micro_f1"),
        "macro_f1",
        ratio(F.col("same_emotion_expressed"), m).alias("emotion_expressed_accuracy"),
        ratio(F.col("intensity_error"), m).alias("emotion_intensity_mae"),
        ratio(F.col("same_stance"), m).alias("stance_accuracy"),
        ratio(F.col("same_certainty"), m).alias("certainty_accuracy"),
        ratio(F.col("over"), t).alias("overlabeling_rate"),
        ratio(F.col("n"), t).alias("n_rate"),
        ratio(F.col("flags"), t).alias("validator_violation_rate"),
        ratio(F.col("review"), t).alias("needs_review_rate"),
        ratio(F.col("conflicts"), F.greatest(t, F.lit(1))).alias("similarity_conflict_rate"),
        ratio(F.col("regression"), m).alias("regression_pass_rate"),
    )


def confusions(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """gold_primary, predicted_primary and n of matched pairs that differ there."""
    wrong = matched(predictions, gold).where("p.primary_function <> g.primary_function")
    return wrong.groupBy(F.col("g.primary_function").alias("gold_primary"), F.col("p.primary_function").alias("predicted_primary")).agg(F.count(F.lit(1)).alias("n"))


def confusion_examples(predictions: DataFrame, gold: DataFrame, limit: int = 25) -> DataFrame:
    """The first differing pairs by unit_id, a report of ``limit`` rows."""
    wrong = matched(predictions, gold).where("p.primary_function <> g.primary_function")
    return wrong.select("unit_id", F.col("g.primary_function").alias("gold_primary"), F.col("p.primary_function").alias("predicted_primary"), F.col("p.text").alias("text")).orderBy("unit_id").limit(limit)


def missing_and_unexpected(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """unit_id and side of ids on one side only."""
    ids = lambda d: d.select("unit_id").distinct()
    return ids(gold).join(predictions, "unit_id", "left_anti").withColumn("side", F.lit("missing")).unionByName(ids(predictions).join(gold, "unit_id", "left_anti").withColumn("side", F.lit("unexpected")))


def audit_report(units: DataFrame, relations: DataFrame | None = None, chains: DataFrame | None = None) -> DataFrame:
    """Flags by rule and severity over units and, where given, relations and chains that need review."""
    out = flag_summary(units)
    for frame, rule in ((relations, "relation_needs_review"), (chains, "chain_needs_review")):
        if frame is not None:
            marked = frame.where("needs_review").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
            out = out.unionByName(marked.select(F.lit(rule).alias("rule_id"), F.lit("warning").alias("severity"), "n"))
    return out

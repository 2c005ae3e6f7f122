"""Deterministic repair and checking of labelled units, as a chain of projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.notation import compile_notation, normalize_codes, strings
from ..functions.text import contains_any
from .segment import with_neighbours

FLAG = "struct<rule_id:string,severity:string,message:string,field:string>"
#: What each rule's flag says.
MESSAGES = {
    "N_exclusive": "N stands alone; it was taken away beside other functions.",
    "K_inherits_A": "K is a kind of A; A was taken away and noted as inherited.",
    "primary_function_required": "The primary function was not among the functions.",
    "D_without_evidence": "D needs evidence, a number or a marker of data.",
    "R_without_question_anchor": "R needs a question before it or in it.",
    "possible_emotion_confusion": "An emotion that is told about may not be one that is expressed.",
    "possible_overlabeling": "There are more functions than a unit usually has.",
    "notation_derivation": "The notation did not follow from the fields and was derived anew.",
    "adjudication_applied": "A second answer was applied.",
    "adjudication_failed": "A second answer could not be had.",
    "relation_needs_review": "The relation is plausible, but not sure enough.",
    "chain_needs_review": "The chain is plausible, but not sure enough.",
}
INHERITED = "struct<function:string,inherited_from:string,reason:string>"


def flag(rule: str, field: str, severity: str = "warning") -> Column:
    return F.struct(F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), F.lit(MESSAGES[rule]).alias("message"), F.lit(field).alias("field"))


def flags_if(bad: Column, rule: str, field: str) -> Column:
    """An array of one flag, or an empty one."""
    return F.when(bad, F.array(flag(rule, field))).otherwise(F.array().cast(f"array<{FLAG}>"))


def versions() -> list[Column]:
    """The versions of taxonomy, prompt and validator that made a row."""
    return [F.lit(L.VERSION).alias(f"{n}_version_effective") for n in ("taxonomy", "prompt", "validator")]


def still_relevant(flags: Column, functions: Column) -> Column:
    """Flags without those that the functions have settled."""
    settled = lambda f: (
        ((f["rule_id"] == "D_without_evidence") & ~F.array_contains(functions, "D"))
        | ((f["rule_id"] == "R_without_question_anchor") & ~F.array_contains(functions, "R"))
        | ((f["rule_id"] == "possible_overlabeling") & (F.size(functions) <= L.OVERLABELLED))
    )
    return F.filter(flags, lambda f: ~settled(f))


def _added(checks: list[tuple[str, str, Column]]) -> Column:
    """The flags of the checks that hold and that the unit does not carry yet."""
    made = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), flag(rule, field)) for rule, field, bad in checks]), lambda f: f.isNotNull())
    known = F.transform("_flags", lambda f: f["rule_id"])
    return F.filter(made, lambda f: ~F.array_contains(known, f["rule_id"])).cast(f"array<{FLAG}>")


def validate(units: DataFrame, always_parentheses: bool = False) -> DataFrame:
    """Units with functions, primary and secondary functions, inherited_functions, validator_flags, review marks and notation put right.

    Needs document_id, sequence_index, text, normalized_text, functions,
    primary_function, secondary_functions, certainty, emotion_expressed,
    emotion_intensity, emotions_mentioned, stance, needs_review, review_reasons
    and final_notation; evidence_spans, validator_flags, inherited_functions and
    relation_types count as empty where they are missing. Running it again changes nothing.
    """
    own = units
    for name, kind in (("validator_flags", f"array<{FLAG}>"), ("inherited_functions", f"array<{INHERITED}>"), ("relation_types", "array<string>"), ("evidence_spans", "array<struct<source:string>>")):
        if name not in own.columns:
            own = own.withColumn(name, F.array().cast(kind))
    own = with_neighbours(own, 1, 0, lambda order: {"_before": F.lag("text").over(order)})
    own = own.withColumns({"_flags": F.coalesce("validator_flags", F.array().cast(f"array<{FLAG}>")), "_f": normalize_codes(F.col("functions")), "_was": F.col("final_notation")})
    has = lambda code: F.array_contains("_f", code)

    # Each step is a column of its own, so that none is spelt out again in those that follow.
    own = own.withColumn("_lonely", has("N") & (F.size("_f") > 1))
    own = own.withColumn("_f", F.when(F.col("_lonely"), F.array_remove("_f", "N")).otherwise(F.col("_f")))
    own = own.withColumns({"_k": has("K"), "_both": has("K") & has("A")})
    heir = F.struct(F.lit("A").alias("function"), F.lit("K").alias("inherited_from"), F.lit("K_subclass_of_A").alias("reason"))
    known = F.exists("inherited_functions", lambda i: (i["function"] == "A") & (i["inherited_from"] == "K"))
    own = own.withColumns(
        {
            "inherited_functions": F.when(F.col("_k") & ~known, F.concat("inherited_functions", F.array(heir).cast(f"array<{INHERITED}>"))).otherwise(F.col("inherited_functions")),
            "_f": F.when(F.col("_both"), F.array_remove("_f", "A")).otherwise(F.col("_f")),
        }
    )
    own = own.withColumn("_absent", ~F.coalesce(F.array_contains("_f", F.col("primary_function")), F.lit(False)) & (F.size("_f") > 0))
    own = own.withColumns({"_lost": F.col("_absent") & (F.array_join("_f", "+") != "N"), "primary_function": F.when(F.col("_absent"), F.get("_f", F.lit(0))).otherwise(F.col("primary_function"))})
    own = own.withColumn("secondary_functions", F.filter(normalize_codes(F.col("secondary_functions")), lambda c: F.array_contains("_f", c) & (c != F.col("primary_function"))))

    own = own.withColumn("_text", F.lower(F.concat_ws(" ", F.coalesce("text", F.lit("")), F.coalesce("normalized_text", F.lit("")))))
    text, before, emotion = F.col("_text"), F.coalesce("_before", F.lit("")), F.col("emotion_expressed")
    evident = (F.size("evidence_spans") > 0) | contains_any(text, L.EVIDENCE_MARKERS) | F.rlike(text, F.lit(r"(?U)\d"))
    anchored = contains_any(text, ("?", "¿")) | contains_any(before, ("?", "¿")) | F.exists("relation_types", lambda r: F.upper(r) == "ANS")
    told = F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(c)) for w, c in L.EMOTION_WORDS])
    named = F.array_contains(F.coalesce("emotions_mentioned", strings()), emotion) | F.coalesce(F.array_contains(told, emotion), F.lit(False))
    mixed = (emotion != "N") & (F.coalesce("emotion_intensity", F.lit(0)) >= 2) & named
    own = own.withColumns(
        {
            "_no_evidence": has("D") & ~evident,
            "_no_anchor": has("R") & ~anchored,
            "_mixed": mixed,
            "_over": F.size("_f") > L.OVERLABELLED,
            "final_notation": compile_notation(F.col("_f"), F.col("certainty"), emotion, F.coalesce("emotion_intensity", F.lit(0)), F.col("stance"), always_parentheses),
        }
    )
    checks = [
        ("primary_function_required", "primary_function", F.col("_lost")),
        ("D_without_evidence", "evidence_spans", F.col("_no_evidence")),
        ("R_without_question_anchor", "functions", F.col("_no_anchor")),
        ("possible_emotion_confusion", "emotion_expressed", F.col("_mixed")),
        ("possible_overlabeling", "functions", F.col("_over")),
    ]
    flags = [
        ("N_exclusive", "functions", F.col("_lonely")),
        ("K_inherits_A", "functions", F.col("_both")),
        *checks,
        ("notation_derivation", "final_notation", (F.col("_was") != "") & (F.col("_was") != F.col("final_notation"))),
    ]
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, _, bad in checks]))
    settled = {
        "validator_flags": F.concat("_flags", _added(flags)),
        "needs_review": F.coalesce("needs_review", F.lit(False)) | (F.size(reasons) > 0),
        "review_reasons": F.array_union(F.coalesce("review_reasons", strings()), reasons),
        "functions": F.col("_f"),
    }
    # A row of its own, so that a filter on these columns reads them. It would else be put before the steps above, spelt out with all of them, and search each text many times.
    own = own.withColumn("_settled", F.explode(F.array(F.struct(*[c.alias(n) for n, c in settled.items()])))).withColumns({n: F.col("_settled")[n] for n in settled})
    return own.drop("_before", "_flags", "_f", "_was", "_lonely", "_k", "_both", "_absent", "_lost", "_text", "_no_evidence", "_no_anchor", "_mixed", "_over", "_settled")


def flag_summary(units: DataFrame) -> DataFrame:
    """rule_id, severity and n of all flags."""
    return units.select(F.explode("validator_flags").alias("f")).groupBy("f.rule_id", "f.severity").agg(F.count(F.lit(1)).alias("n"))

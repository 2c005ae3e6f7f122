"""Candidate labels with evidence spans from marker patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicon as L
from ..functions.notation import normalize_codes, strings
from ..functions.text import any_of, apart, folded, matches, matches_any, may_match, unicode_pattern


def first_match(text: Column, patterns: Sequence[str]) -> Column:
    """start and end (0-based) of the first pattern that occurs, else null. Patterns are tried in order, wherever they match."""

    def place(p: str) -> Column:
        pattern = F.lit(unicode_pattern(p))
        start = F.regexp_instr(text, pattern) - 1
        return F.when(matches(text, p), F.struct(start.alias("start"), (start + F.length(F.regexp_substr(text, pattern))).alias("end")))

    return F.coalesce(*[place(p) for p in patterns])


def signal(code: Column | str, rule: str, confidence: float, match: Column, locked: Column | None = None) -> Column:
    """A struct of code, rule_id, confidence, locked, start and end, or null without a match."""
    code = F.lit(code) if isinstance(code, str) else code
    held = F.lit(False) if locked is None else locked
    sure = F.when(held, F.lit(L.LOCKED_CONFIDENCE)).otherwise(F.lit(confidence))
    return F.when(match.isNotNull(), F.struct(code.alias("code"), F.lit(rule).alias("rule_id"), sure.alias("confidence"), held.alias("locked"), match["start"].alias("start"), match["end"].alias("end")))


def with_signals(units: DataFrame, near_end: Column, rules=L.FUNCTION_RULES, conclusions=L.CONCLUSION_PATTERNS) -> DataFrame:
    """units(text, folded) with ``signals``: all function signals of a unit, in the order question, conclusion, rules.

    Most units hold no marker at all, which is tested first, outside the lambdas. The
    matches of the others are a column of their own, so that each is looked for once.
    """
    question = lambda text, fold: F.contains(text, F.lit("?")) | F.contains(text, F.lit("¿")) | F.contains(fold, F.lit("?"))
    marked = question(F.col("text"), F.col("folded")) | may_match(F.col("folded"), (*conclusions, *[p for r in rules for p in r[3]]))

    def places(t: Column) -> Column:
        text, fold = t["text"], t["folded"]
        asked = question(text, fold)
        found = [F.when(asked, F.coalesce(first_match(fold, ("[?¿]",)), first_match(fold, (".",)))), first_match(fold, conclusions)]
        for _, _, _, patterns, skips in rules:
            match = first_match(fold, patterns)
            found.append(F.when(~matches_any(fold, skips), match) if skips else match)
        return F.array(*found)

    def named(m: Column) -> Column:
        at = lambda i: F.get(m["places"], F.lit(i))
        every = [signal("P", L.QUESTION_RULE, L.LOCKED_CONFIDENCE, at(0), F.lit(True)), signal("Z", L.CONCLUSION_RULE, L.CONCLUSION_CONFIDENCE, at(1), m["near"])]
        every += [signal(code, rule, confidence, at(i)) for i, (code, rule, confidence, _, _) in enumerate(rules, 2)]
        return F.filter(F.array(*every), lambda s: s.isNotNull())

    none = F.array().cast("array<struct<code:string,rule_id:string,confidence:double,locked:boolean,start:int,end:int>>")
    own = units.withColumn("_matches", F.struct(F.when(marked, apart(F.struct("text", "folded"), places)).alias("places"), near_end.alias("near")))
    return own.withColumn("signals", F.when(F.col("_matches.places").isNotNull(), apart(F.col("_matches"), named)).otherwise(none)).drop("_matches")


def typed(fold: Column, typed_patterns) -> Column:
    """The first value one of whose patterns occurs."""
    return apart(fold, lambda t: F.coalesce(*[F.when(matches_any(t, patterns), F.lit(value)) for value, patterns in typed_patterns]))


def emotions_mentioned(fold: Column, words=L.EMOTION_WORDS, context: str = L.MENTION_CONTEXT) -> Column:
    """Codes of emotion words that stand near a word of telling about someone."""

    def told(fold: Column, word: str) -> Column:
        # Every occurrence: cut the text at the word and look at the characters before and after each cut.
        parts = F.split(fold, unicode_pattern(rf"\b{word}\b"))
        upto = lambda i: F.array_join(F.slice(parts, 1, i), word)
        beyond = lambda i: F.array_join(F.slice(parts, i + 1, F.size(parts)), word)
        window = lambda i: F.concat(F.right(upto(i), F.lit(L.MENTION_BEFORE)), F.lit(word), F.left(beyond(i), F.lit(L.MENTION_AFTER)))
        cuts = F.sequence(F.lit(1), F.size(parts) - 1)
        near = F.when(F.size(parts) > 1, F.exists(cuts, lambda i: F.rlike(window(i), F.lit(unicode_pattern(context)))))
        return F.coalesce(F.when(F.contains(fold, F.lit(word)), near), F.lit(False))

    import unicodedata

    bare = lambda w: "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))
    return apart(fold, lambda t: F.array_distinct(F.filter(F.array(*[F.when(told(t, bare(w)), F.lit(code)) for w, code in words]), lambda c: c.isNotNull())))


def near_end(units: DataFrame) -> Column:
    """Whether a unit is among the last of its document."""
    total = F.col("unit_count") if "unit_count" in units.columns else F.count(F.lit(1)).over(Window.partitionBy("document_id"))
    return F.col("sequence_index") >= F.greatest(F.lit(0), F.coalesce(total, F.lit(0)) - L.NEAR_END)


def annotate(units: DataFrame, rules=L.FUNCTION_RULES, normalise: bool = True) -> DataFrame:
    """units(document_id, sequence_index, text) with folded, signals, locked_functions, candidate_functions, certainty, stance and emotion candidates, and evidence_spans.

    Spans index the folded text and cut the original, which agree where folding
    keeps the length. unit_count (units of the document), where units have it, spares a shuffle;
    normalise=False a pass over texts that are normalised already, as those of segment_texts.
    """
    own = with_signals(units.withColumn("folded", folded(F.col("text"), normalise)), near_end(units), rules)
    # Most units have no signals, and so no codes to put in order.
    codes = lambda held: F.when(F.size("signals") > 0, normalize_codes(F.transform(F.filter("signals", lambda s: s["locked"] == held), lambda s: s["code"]))).otherwise(strings())
    own = own.withColumn("locked_functions", codes(True))
    own = own.withColumn("candidate_functions", F.when(F.size("locked_functions") > 0, F.array_except(codes(False), F.col("locked_functions"))).otherwise(codes(False)))
    own = own.withColumns({"candidate_certainty": typed(F.col("folded"), L.CERTAINTY), "candidate_stance": typed(F.col("folded"), L.STANCE), "candidate_emotion_expressed": typed(F.col("folded"), L.EMOTION_EXPRESSED)})
    own = own.withColumn("candidate_emotions_mentioned", emotions_mentioned(F.col("folded")))
    span = lambda s: F.struct(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]).alias("text"), s["start"].alias("char_start"), s["end"].alias("char_end"), s["rule_id"].alias("source"))
    return own.withColumn("evidence_spans", F.transform("signals", span))


def counts_by_lang(units: DataFrame) -> DataFrame:
    """lang, code and n: how many units of each language carry a candidate of each code."""
    return units.select("lang", F.explode_outer("signals").alias("s")).where("s IS NOT NULL").groupBy("lang", F.col("s.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


def has_any(functions: Column, *codes: str) -> Column:
    return F.arrays_overlap(functions, strings(*codes))


def asked(text: Column) -> Column:
    return any_of([F.contains(text, F.lit("?")), F.contains(text, F.lit("¿"))])

"""Relations between a unit and the few that follow it."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import apart, contains_any, hash_id, starts_with_any
from .segment import CUT, CUT_UNITS, in_cut, with_halo, with_neighbours
from .validate import flags_if, versions

#: Bits of what a unit is: its functions, then the marker lists found in it, then whether it starts like an answer.
_BITS = {name: 1 << i for i, name in enumerate([*L.FUNCTIONS, *L.MARKERS, "answer_like"])}


@dataclass(frozen=True)
class Rule:
    """Fires for an earlier unit of ``first`` and a later one of ``second``, sets of functions and marker lists of which one is enough.

    Empty sets say nothing; ``but`` must not hold of the later unit. Weak rules are
    for neighbours that nothing else relates, and the first of them alone fires.
    """

    rule_id: str
    relation_type: str
    base: float
    rejected: tuple[str, ...]
    first: tuple[str, ...] = ()
    second: tuple[str, ...] = ()
    either: tuple[str, ...] = ()
    but: tuple[str, ...] = ()
    backward: bool = True
    weak: bool = False


RULES: tuple[Rule, ...] = (
    Rule("ANS_question_answer_anchor", "ANS", 0.92, ("EXPL",), ("P", "QUESTION"), ("R", "answer_like"), backward=False),
    Rule("Y_explains_previous_claim", "CAUSE", 0.82, ("SUP",), ("A", "K", "O", "R"), ("Y",), but=("~CAUSAL",)),
    Rule("Y_explains_previous_claim", "EXPL", 0.74, ("SUP",), ("A", "K", "O", "R"), ("Y",), but=("CAUSAL",)),
    Rule("evidence_supports_prior_claim", "SUP", 0.86, ("CAUSE", "EXPL"), ("A", "K", "O", "Y"), ("D", "Q")),
    Rule("example_illustrates_previous_unit", "EXMP", 0.82, ("ELAB",), ("A", "K", "F", "Y", "S"), ("E",)),
    Rule("analogy_maps_to_previous_unit", "ANLG", 0.84, ("EXMP",), ("A", "K", "F", "Y"), ("G",)),
    Rule("contrast_with_previous_unit", "CONTR", 0.78, ("ELAB",), (), ("C", "CONTRAST")),
    Rule("refutation_targets_previous_unit", "REFUT", 0.84, ("CONTR",), (), ("B", "REFUTATION")),
    Rule("risk_attaches_to_previous_unit", "RISK", 0.8, ("CONTR",), (), ("X", "RISK")),
    Rule("solution_addresses_prior_risk", "SOLV", 0.86, ("CALL",), ("X", "RISK"), ("S", "SOLUTION")),
    Rule("viewer_call_attaches_to_previous_unit", "CALL", 0.72, ("SEQ",), (), ("V",)),
    Rule("conclusion_summarizes_previous_unit", "SUM", 0.76, ("SEQ",), ("A", "K", "Y", "S", "L"), ("Z",)),
    Rule("condition_modifies_previous_unit", "COND", 0.76, ("CAUSE",), (), ("CONDITION",)),
    Rule("adjacent_elaboration", "ELAB", 0.62, ("SEQ",), ("A", "K", "F", "M"), ("A", "F", "M", "U"), weak=True),
    Rule("adjacent_structural_sequence", "SEQ", 0.6, ("ELAB",), either=("T", "M", "L"), backward=False, weak=True),
)
RELATION = "struct<rule_id:string,relation_type:string,backward:boolean,base:double,rejected:array<string>>"


def _any(mask: Column, names: tuple[str, ...]) -> Column:
    return mask.bitwiseAND(F.lit(sum(_BITS[n] for n in names)).cast("long")) != 0


def roles(mask: Column) -> tuple[Column, Column]:
    """Two numbers of a unit: bits of the RULES that it fits as the earlier unit of a pair, and as the later one.

    A rule fires for a pair whose units fit both sides, so that one ``&`` of two
    numbers tells all rules at once. A rule of ``either`` has a second bit, above
    all others: the lower one is for the earlier unit having it, the other for the later.
    """
    first, second = [], []
    for i, r in enumerate(RULES):
        tests = [_any(mask, r.second)] if r.second else []
        tests += [_any(mask, (n[1:],)) if n.startswith("~") else ~_any(mask, (n,)) for n in r.but]
        own = _any(mask, r.first or r.either) if r.first or r.either else F.lit(True)
        first.append((own, 1 << i))
        second.append((reduce(lambda a, b: a & b, tests, F.lit(True)), 1 << i))
        if r.either:
            first.append((F.lit(True), 1 << i + len(RULES)))
            second.append((_any(mask, r.either), 1 << i + len(RULES)))
    return tuple(reduce(lambda a, b: a + b, [F.when(t, F.lit(n)).otherwise(F.lit(0)) for t, n in side]) for side in (first, second))


#: Bits of the rules that hold for any pair, and of those for neighbours alone.
_STRONG = sum(1 << i for i, r in enumerate(RULES) if not r.weak)
_WEAK = [(i, 1 << i | (1 << i + len(RULES) if r.either else 0)) for i, r in enumerate(RULES) if r.weak]


def fired_rules(both: Column, distance: Column) -> Column:
    """Bits of the RULES that fire for a pair. both: what the earlier unit's first and the later one's second number have in common."""
    weak = F.when(distance != 1, 0)
    for i, bits in _WEAK:
        weak = weak.when(both.bitwiseAND(F.lit(bits)) != 0, 1 << i)
    strong = both.bitwiseAND(F.lit(_STRONG))
    return F.when(strong != 0, strong).otherwise(weak.otherwise(0))


def unit_mask(text: Column, start: Column, functions: Column) -> Column:
    """What a unit is, as bits. text: lower case, searched for markers; start: lower case, whose beginning tells an answer."""
    long = lambda n: F.lit(n).cast("long")
    codes = F.create_map(*[x for c in L.FUNCTIONS for x in (F.lit(c), long(_BITS[c]))])
    own = F.aggregate(F.coalesce(functions, F.array().cast("array<string>")), long(0), lambda m, c: m.bitwiseOR(F.coalesce(codes[c], long(0))))

    def named(t: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.when(contains_any(t, m), long(_BITS[k])).otherwise(long(0)) for k, m in L.MARKERS.items()])

    # Most units hold no marker at all, which one search for all of them tells.
    every = "|".join(re.escape(m) for m in dict.fromkeys(m for ms in L.MARKERS.values() for m in ms))
    marked = F.when(F.rlike(text, F.lit(every)), apart(text, named)).otherwise(long(0))
    return own + marked + F.when(starts_with_any(start, L.ANSWER_STARTS), long(_BITS["answer_like"])).otherwise(long(0))


def detect_relations(units: DataFrame, run_id: str = "run_unknown", max_distance: int = L.MAX_DISTANCE, min_confidence: float = L.MIN_CONFIDENCE, size: int = CUT_UNITS, halo: int = 0) -> DataFrame:
    """Relations of units(document_id, unit_id, sequence_index, text, normalized_text, functions).

    Each unit meets the next ``max_distance`` of its document, taken by one
    window over cuts of the document's order: one shuffle and no join. What rules
    ask of either unit is settled before, so that pairs compare two numbers.
    Confidence falls by 0.08 with every further step.

    halo: stay in cuts, each with the relations of so many units on either side,
    and carry ``source`` and ``target``, the units' places and notations, for
    those who go on in the same cuts without another shuffle.
    """
    text, start = F.lower(F.concat_ws(" ", "text", "normalized_text")), F.lower(F.coalesce("normalized_text", F.lit("")))
    kept, place = (["final_notation"], [CUT]) if halo else ([], [])
    masked = units.select("document_id", "sequence_index", "unit_id", "text", *kept, unit_mask(text, start, F.col("functions")).alias("mask"))
    first, second = roles(F.col("mask"))
    own = masked.select("document_id", "sequence_index", F.struct("unit_id", "sequence_index", first.alias("first"), second.alias("second"), "text", *kept).alias("f"))
    later = lambda order: {"later": F.array(*[F.lead("f", k).over(order) for k in range(1, max_distance + 1)])}
    ahead = with_halo(own, halo, halo, size).withColumns(later(in_cut())) if halo else with_neighbours(own, 0, max_distance, later, size)
    pairs = ahead.select("document_id", *place, "f", F.explode("later").alias("s")).where("s IS NOT NULL").withColumn("distance", F.col("s.sequence_index") - F.col("f.sequence_index"))
    fired = pairs.withColumn("fired", fired_rules(F.col("f.first").bitwiseAND(F.col("s.second")), F.col("distance"))).where("fired <> 0")
    table = json.dumps([{"rule_id": r.rule_id, "relation_type": r.relation_type, "backward": r.backward, "base": r.base, "rejected": r.rejected} for r in RULES])
    numbers = F.array_remove(F.array(*[F.when(F.col("fired").bitwiseAND(F.lit(1 << i)) != 0, i).otherwise(-1) for i in range(len(RULES))]), -1)
    # Two rules never give the same type and direction for one pair, so taking the first of each is all there is to repeats.
    # Some rule has fired, so the outer form gives the same rows; the other would be tested for being empty before.
    rows = fired.select("document_id", *place, "f", "s", "distance", F.explode_outer(numbers).alias("number")).withColumn("r", F.get(F.from_json(F.lit(table), f"array<{RELATION}>"), F.col("number")))
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("r.base") - L.STEP_PENALTY * (F.col("distance") - 1)))
    ends = {
        "source_unit_id": F.when(F.col("r.backward"), F.col("s.unit_id")).otherwise(F.col("f.unit_id")),
        "target_unit_id": F.when(F.col("r.backward"), F.col("f.unit_id")).otherwise(F.col("s.unit_id")),
    }
    if halo:
        member = lambda u: F.struct(F.col(f"{u}.sequence_index").cast("int").alias("sequence_index"), F.col(f"{u}.unit_id").alias("unit_id"), F.col(f"{u}.final_notation").alias("notation"))
        ends |= {"source": F.when(F.col("r.backward"), member("s")).otherwise(member("f")), "target": F.when(F.col("r.backward"), member("f")).otherwise(member("s"))}
        place = [*place, "source", "target"]
    rows = rows.withColumns(ends | {"_confidence": confidence}).where(F.round("_confidence", 4) >= min_confidence)
    weak = (F.col("_confidence") < 0.7) | (F.size("r.rejected") > 1)
    return rows.select(
        F.lit(run_id).alias("run_id"),
        hash_id("rel_", run_id, F.col("source_unit_id"), F.col("target_unit_id"), F.concat(F.lit("RelationType."), F.col("r.relation_type")), F.col("r.rule_id")).alias("relation_id"),
        "document_id",
        "source_unit_id",
        "target_unit_id",
        F.col("r.relation_type").alias("relation_type"),
        F.round("_confidence", 4).alias("confidence"),
        F.col("r.rule_id").alias("rule_id"),
        F.col("r.rejected").alias("rejected_relation_types"),
        weak.alias("needs_review"),
        F.col("distance").cast("int").alias("distance"),
        F.lit("heuristic").alias("method"),
        F.array(F.struct(F.col("s.text").alias("text"), F.concat(F.lit("relation_detector:"), F.col("r.rule_id")).alias("source"))).alias("evidence_spans"),
        flags_if(weak, "relation_needs_review", "relation_type").alias("validator_flags"),
        *versions(),
        *place,
    )


def attach_relations(existing: DataFrame, detected: DataFrame) -> DataFrame:
    """The relations that documents have already, and those detected for documents that have none."""
    return existing.unionByName(detected.join(existing.select("document_id").distinct(), "document_id", "left_anti"), allowMissingColumns=True)


def relation_summary(relations: DataFrame) -> DataFrame:
    """relation_type, n and needs_review of all relations."""
    return relations.groupBy("relation_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("needs_review").alias("needs_review"))

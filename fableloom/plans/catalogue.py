"""The registered queries over the driver tables and their DuckDB equivalents."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicon as L
from ..functions.notation import compile_notation, group_labels, normalize_codes, strings
from ..functions.text import folded, normalized
from ..operators import chains as C
from ..operators import evaluate as E
from ..operators import heuristics as H
from ..operators import model_calls as M
from ..operators import relations as R
from ..operators import review as V
from ..operators import rollups as U
from ..operators import segment as S
from ..operators import similarity as Y
from ..operators import validate as Q
from ..sources import sinks
from . import frames as X
from .frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


NORM = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query(f"SELECT doc_id, {NORM} AS normalized FROM documents")
def normalize_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", normalized(F.col("text")).alias("normalized"))


@query(f"SELECT doc_id, strip_accents(lower({NORM})) AS folded FROM documents")
def fold_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", folded(F.col("text")).alias("folded"))


OFFSETS = "coalesce(sum(length(text) + 1) OVER (PARTITION BY document_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"


@query(f"WITH {X.UNITS_SQL} SELECT document_id, seq AS sequence_index, text, {OFFSETS} AS char_start, {OFFSETS} + length(text) AS char_end FROM pieces")
def segment_units(spark, d):
    return X.units(spark, d).select("document_id", "sequence_index", "text", "char_start", "char_end")


UNIT_ID = "document_id || '_u' || lpad(CAST(seq AS VARCHAR), 5, '0')"


@query(f"WITH {X.UNITS_SQL}, ids AS (SELECT document_id, seq, {UNIT_ID} AS unit_id FROM pieces) SELECT unit_id, lag(unit_id) OVER w AS previous_unit_id, lead(unit_id) OVER w AS next_unit_id FROM ids WINDOW w AS (PARTITION BY document_id ORDER BY seq)")
def unit_neighbors(spark, d):
    return X.units(spark, d).select("unit_id", "previous_unit_id", "next_unit_id")


TIMED = X.pieces_sql("(SELECT conv_id AS document_id, turn, text FROM conversations)", "document_id, turn")


@query(f"""WITH {TIMED}, n AS (SELECT *, count(*) OVER (PARTITION BY document_id, turn) AS total FROM pieces)
SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY turn, seq) - 1 AS sequence_index, text, CAST(turn * 4321 + round_even(4321 * seq / total, 0) AS BIGINT) AS start_ms,
  CAST(turn * 4321 + round_even(4321 * (seq + 1) / total, 0) AS BIGINT) AS end_ms, total > 1 AS approximate_timing FROM n""")
def conversation_segments(spark, d):
    turn = F.col("turn")
    own = table(spark, d, "conversations").select(F.col("conv_id").alias("document_id"), turn.alias("segment_index"), "text", (turn * 4321).alias("start_ms"), ((turn + 1) * 4321).alias("end_ms"))
    return S.segment_timed(own).select("document_id", "sequence_index", "text", "start_ms", "end_ms", "approximate_timing")


def _rules_sql() -> str:
    """Rows (document_id, lang, seq, code, rule_id, char_start, char_end) of every rule."""

    def quoted(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    def found(patterns: tuple[str, ...], what: str) -> str:
        before = lambda p: quoted("(?s)^(.*?)(?:" + (p[1:] if p.startswith("^") else p) + ")") if not p.startswith("^") else quoted("^()(?:" + p[1:] + ")")
        value = {"start": lambda p: f"length(regexp_extract(fold, {before(p)}, 1))", "size": lambda p: f"length(regexp_extract(fold, {quoted(p)}, 0))"}[what]
        return "CASE " + " ".join(f"WHEN regexp_matches(fold, {quoted(p)}) THEN {value(p)}" for p in patterns) + " END"

    every = [("P", L.QUESTION_RULE, ("[?¿]",), ()), ("Z", L.CONCLUSION_RULE, L.CONCLUSION_PATTERNS, ()), *[(c, r, p, s) for c, r, _, p, s in L.FUNCTION_RULES]]
    parts = []
    for code, rule, patterns, skips in every:
        skip = "".join(f" AND NOT regexp_matches(fold, {quoted(s)})" for s in skips)
        parts.append(f"SELECT document_id, lang, seq, '{code}' AS code, '{rule}' AS rule_id, {found(patterns, 'start')} AS s, {found(patterns, 'size')} AS n FROM f WHERE true{skip}")
    return f"WITH {X.UNITS_SQL}, f AS (SELECT document_id, lang, seq, {X.FOLD_SQL} AS fold FROM pieces), hits AS ({' UNION ALL '.join(parts)})"


@query(_rules_sql() + " SELECT document_id, seq AS sequence_index, code, rule_id, s AS char_start, s + n AS char_end FROM hits WHERE s IS NOT NULL")
def heuristic_candidates(spark, d):
    # The outer form, as the other would look for all signals once more to leave out units without any.
    own = H.annotate(X.units(spark, d), normalise=False).select("document_id", "sequence_index", F.explode_outer("signals").alias("s")).where("s IS NOT NULL")
    return own.select("document_id", "sequence_index", "s.code", "s.rule_id", F.col("s.start").alias("char_start"), F.col("s.end").alias("char_end"))


@query(_rules_sql() + " SELECT lang, code, count(*) AS n FROM hits WHERE s IS NOT NULL GROUP BY lang, code")
def heuristic_counts_by_lang(spark, d):
    own = X.units(spark, d).withColumn("folded", folded(F.col("text"), normalise=False))
    return H.counts_by_lang(H.with_signals(own, F.lit(False)))


@query(f"WITH {X.UNITS_SQL} SELECT document_id, count(*) AS units, sum(CASE WHEN seq >= greatest(0, total - 3) THEN 1 ELSE 0 END) AS near_end FROM (SELECT *, count(*) OVER (PARTITION BY document_id) AS total FROM pieces) GROUP BY document_id")
def conclusion_near_end(spark, d):
    own = X.units(spark, d)
    own = own.withColumn("near", H.near_end(own))
    return own.groupBy("document_id").agg(F.count(F.lit(1)).alias("units"), F.count_if("near").alias("near_end"))


#: Marker words that the driver's invented corpus has.
CORPUS_CERTAINTY = (("strong", (r"\bthe\b", r"\bder\b")), ("tentative", (r"\bof\b", r"\bque\b")), ("uncertain", (r"\bin\b", r"\bles\b")))


@query(f"WITH {X.UNITS_SQL} SELECT document_id, seq AS sequence_index, CASE WHEN regexp_matches(fold, '\\bthe\\b|\\bder\\b') THEN 'strong' WHEN regexp_matches(fold, '\\bof\\b|\\bque\\b') THEN 'tentative' WHEN regexp_matches(fold, '\\bin\\b|\\bles\\b') THEN 'uncertain' END AS certainty FROM (SELECT *, {X.FOLD_SQL} AS fold FROM pieces)")
def certainty_stance(spark, d):
    return X.units(spark, d).select("document_id", "sequence_index", H.typed(folded(F.col("text"), normalise=False), CORPUS_CERTAINTY).alias("certainty"))


_MENTIONED = ", ".join(
    f"CASE WHEN regexp_matches(fold, '\\b{w}\\b') AND list_bool_or(list_transform(range(1, len(string_split_regex(fold, '\\b{w}\\b'))), lambda i: regexp_matches("
    f"right(array_to_string(string_split_regex(fold, '\\b{w}\\b')[1:i], '{w}'), {L.MENTION_BEFORE}) || '{w}' || left(array_to_string(string_split_regex(fold, '\\b{w}\\b')[i + 1:], '{w}'), {L.MENTION_AFTER}), '\\b(the|und|with)\\b'))) THEN '{c}' END"
    for w, c in (("trash", "D"), ("idiot", "E"), ("ist", "C"))
)


@query(f"WITH {X.UNITS_SQL}, m AS (SELECT document_id, seq, list_filter([{_MENTIONED}], lambda x: x IS NOT NULL) AS codes FROM (SELECT *, {X.FOLD_SQL} AS fold FROM pieces)) SELECT document_id, seq AS sequence_index, array_to_string(codes, '+') AS codes FROM m WHERE len(codes) > 0")
def emotion_mentions(spark, d):
    words, context = (("trash", "D"), ("idiot", "E"), ("ist", "C")), r"\b(the|und|with)\b"
    own = X.units(spark, d).withColumn("folded", folded(F.col("text"), normalise=False)).select("document_id", "sequence_index", H.emotions_mentioned(F.col("folded"), words, context).alias("codes"))
    return own.where(F.size("codes") > 0).select("document_id", "sequence_index", F.array_join("codes", "+").alias("codes"))


CODES = X.ORDERED % "functions"


@query(f"WITH {X.LABELLED_SQL} SELECT unit_id, array_to_string({CODES}, '+') AS codes, {X.notation_sql(CODES)} AS notation FROM lu")
def compile_notations(spark, d):
    n = compile_notation(*[F.col(c) for c in ("functions", "certainty", "emotion_expressed", "emotion_intensity", "stance")])
    own = X.labelled_units(spark, d).withColumn("notation", n)
    return own.select("unit_id", F.array_join(normalize_codes(F.col("functions")), "+").alias("codes"), "notation")


_VALID = f"""WITH {X.LABELLED_SQL},
a AS (SELECT *, {CODES} AS f0 FROM lu),
b AS (SELECT *, list_contains(f0, 'N') AND len(f0) > 1 AS lonely FROM a),
c AS (SELECT *, CASE WHEN lonely THEN list_filter(f0, lambda x: x <> 'N') ELSE f0 END AS f1 FROM b),
e AS (SELECT *, list_contains(f1, 'K') AND list_contains(f1, 'A') AS heir, CASE WHEN list_contains(f1, 'K') THEN list_filter(f1, lambda x: x <> 'A') ELSE f1 END AS f FROM c),
g AS (
  SELECT *, NOT list_contains(f, primary_function) AND array_to_string(f, '+') <> 'N' AS lost, CASE WHEN list_contains(f, primary_function) THEN primary_function ELSE f[1] END AS pf,
    lower(coalesce(text, '') || ' ' || coalesce(text, '')) AS low, coalesce(lag(text) OVER (PARTITION BY document_id ORDER BY k), '') AS before FROM e),
h AS (
  SELECT *, list_contains(f, 'D') AND NOT regexp_matches(low, '%|según|reporte|informe|dato|medimos|muestra|registr|encuesta|tabla|log|\\d') AS no_evidence,
    list_contains(f, 'R') AND NOT regexp_matches(low || before, '[?¿]') AS no_anchor,
    emotion_expressed <> 'N' AND emotion_intensity >= 2 AND list_contains(emotions_mentioned, emotion_expressed) AS mixed, len(f) > 5 AS over FROM g),
v AS (
  SELECT unit_id, k, document_id, f AS functions, pf AS primary_function, {X.notation_sql("f")} AS final_notation, lost OR no_evidence OR no_anchor OR mixed OR over AS needs_review,
    list_filter([CASE WHEN lonely THEN 'N_exclusive' END, CASE WHEN heir THEN 'K_inherits_A' END, CASE WHEN lost THEN 'primary_function_required' END, CASE WHEN no_evidence THEN 'D_without_evidence' END,
      CASE WHEN no_anchor THEN 'R_without_question_anchor' END, CASE WHEN mixed THEN 'possible_emotion_confusion' END, CASE WHEN over THEN 'possible_overlabeling' END], lambda x: x IS NOT NULL) AS flags,
    emotions_mentioned, emotion_intensity, confidence, certainty, emotion_expressed, stance, text FROM h)"""


@query(_VALID + " SELECT unit_id, array_to_string(functions, '+') AS functions, primary_function, final_notation, needs_review, array_to_string(flags, ',') AS flags FROM v")
def validate_units(spark, d):
    flags = F.array_join(F.transform("validator_flags", lambda f: f["rule_id"]), ",")
    return Q.validate(X.labelled_units(spark, d)).select("unit_id", F.array_join("functions", "+").alias("functions"), "primary_function", "final_notation", "needs_review", flags.alias("flags"))


@query(_VALID + " SELECT rule_id, 'warning' AS severity, count(*) AS n FROM (SELECT unnest(flags) AS rule_id FROM v) GROUP BY rule_id")
def validator_flag_summary(spark, d):
    return Q.flag_summary(Q.validate(X.labelled_units(spark, d)))


# Event functions A, D, Y, Z, X, and no marker text: the rules that can fire, in order.
_RELATIONS = f"""WITH {X.EVENTS_SQL},
p AS (SELECT a.document_id, a.unit_id AS fu, b.unit_id AS su, a.f AS ff, b.f AS sf, b.sequence_index - a.sequence_index AS dist FROM eu a JOIN eu b ON a.document_id = b.document_id AND b.sequence_index BETWEEN a.sequence_index + 1 AND a.sequence_index + 3),
r AS (
  SELECT *, 'Y_explains_previous_claim' AS rule_id, 'EXPL' AS t, 0.74 AS base, 1 AS nrej FROM p WHERE sf = 'Y' AND ff = 'A'
  UNION ALL SELECT *, 'evidence_supports_prior_claim', 'SUP', 0.86, 2 FROM p WHERE sf = 'D' AND ff IN ('A', 'Y')
  UNION ALL SELECT *, 'risk_attaches_to_previous_unit', 'RISK', 0.8, 1 FROM p WHERE sf = 'X'
  UNION ALL SELECT *, 'conclusion_summarizes_previous_unit', 'SUM', 0.76, 1 FROM p WHERE sf = 'Z' AND ff IN ('A', 'Y')
  UNION ALL SELECT *, 'adjacent_elaboration', 'ELAB', 0.62, 1 FROM p WHERE dist = 1 AND sf = 'A' AND ff = 'A'),
rel AS (
  SELECT document_id, su AS source_unit_id, fu AS target_unit_id, t AS relation_type, rule_id, round(CAST(base AS DOUBLE) - 0.08::DOUBLE * (dist - 1), 4) AS confidence,
    (CAST(base AS DOUBLE) - 0.08::DOUBLE * (dist - 1)) < 0.7 OR nrej > 1 AS needs_review,
    'rel_' || substr(sha256('run_events::' || su || '::' || fu || '::RelationType.' || t || '::' || rule_id), 1, 16) AS relation_id FROM r WHERE round(CAST(base AS DOUBLE) - 0.08::DOUBLE * (dist - 1), 4) >= 0.58)"""


def _relations(spark, d):
    return R.detect_relations(X.event_units(spark, d), "run_events")


@query(_RELATIONS + """ SELECT relation_id, rel.document_id, source_unit_id, target_unit_id, relation_type, rule_id, confidence, needs_review, 'heuristic' AS method, text AS evidence, 'relation_detector:' || rule_id AS evidence_source,
  CASE WHEN needs_review THEN 1 ELSE 0 END AS flags FROM rel JOIN eu ON eu.unit_id = rel.source_unit_id""")
def pair_relations(spark, d):
    evidence = F.get("evidence_spans", F.lit(0))
    return _relations(spark, d).select(
        "relation_id", "document_id", "source_unit_id", "target_unit_id", "relation_type", "rule_id", "confidence", "needs_review", "method",
        evidence["text"].alias("evidence"), evidence["source"].alias("evidence_source"), F.size("validator_flags").alias("flags"),
    )


@query(_RELATIONS + " SELECT relation_type, count(*) AS n, count(*) FILTER (needs_review) AS needs_review FROM rel GROUP BY relation_type")
def relation_summary(spark, d):
    return R.relation_summary(_relations(spark, d))


@query(f"""WITH {X.EVENTS_SQL},
w AS (SELECT document_id, list(struct_pack(q := sequence_index, f := f, u := unit_id)) OVER (PARTITION BY document_id ORDER BY sequence_index ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS l FROM eu),
a AS (SELECT document_id, l, list_filter(l, lambda x: x.f = 'A')[1] AS s1 FROM w),
b AS (SELECT *, list_filter(l, lambda x: x.q > s1.q AND x.f = 'D')[1] AS s2 FROM a WHERE s1 IS NOT NULL),
c AS (SELECT *, list_filter(l, lambda x: x.q > s2.q AND x.f = 'Y')[1] AS s3 FROM b WHERE s2 IS NOT NULL AND s2.q - s1.q <= 2)
SELECT DISTINCT document_id, 'claim_evidence_explanation_sequence' AS chain_type, s1.u || '|' || s2.u || '|' || s3.u AS unit_ids, 'A_N0{{0}} -> D_N0{{0}} -> Y_N0{{0}}' AS evidence_summary FROM c WHERE s3 IS NOT NULL AND s3.q - s2.q <= 2""")
def sequence_chains(spark, d):
    own = C.sequence_chains(X.event_units(spark, d))
    return own.select("document_id", "chain_type", F.array_join(F.transform("members", lambda m: m["unit_id"]), "|").alias("unit_ids"), "evidence_summary")


_KINDS = ", ".join(f"('{name}', '{t}', {base})" for name, types, base in L.RELATION_CHAINS for t in types)
_SEQUENCES = ORACLES["sequence_chains"].partition("w AS (")[2].partition("SELECT DISTINCT")[0]
_CHAINS = _RELATIONS + f""",
ends AS (SELECT document_id, relation_id, relation_type, source_unit_id AS s, target_unit_id AS t, confidence, needs_review, unnest([target_unit_id, source_unit_id]) AS anchor FROM rel),
kinds AS (SELECT * FROM (VALUES {_KINDS}) AS v(chain_type, relation_type, base)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY document_id, anchor, chain_type ORDER BY confidence DESC, relation_id DESC) AS place FROM ends JOIN kinds USING (relation_type)),
around AS (
  SELECT document_id, anchor, chain_type, string_agg(relation_id, '|' ORDER BY relation_id) AS relation_ids, string_agg(relation_type || ':' || s || '->' || t, '; ' ORDER BY relation_id) AS evidence_summary,
    list_distinct(flatten(list([s, t]))) AS ids, (max(base)::DOUBLE + avg(confidence)) / 2 - CASE WHEN bool_or(needs_review) THEN 0.08::DOUBLE ELSE 0 END AS score FROM ranked WHERE place <= 5 GROUP BY ALL),
members AS (
  SELECT m.document_id, anchor, chain_type, relation_ids, evidence_summary, score, count(*) AS n, string_agg(eu.unit_id, '|' ORDER BY eu.sequence_index) AS unit_ids
  FROM (SELECT *, unnest(ids) AS id FROM around) m JOIN eu ON eu.document_id = m.document_id AND eu.unit_id = m.id GROUP BY ALL HAVING count(*) > 1),
w AS ({_SEQUENCES.rstrip()},
chains AS (
  SELECT DISTINCT document_id, chain_type, unit_ids, relation_ids, evidence_summary, round(score, 4) AS score, round(score, 9) < 0.72 AS needs_review FROM members WHERE round(score, 4) >= 0.58
  UNION ALL SELECT DISTINCT document_id, 'claim_evidence_explanation_sequence', s1.u || '|' || s2.u || '|' || s3.u, '', 'A_N0{{0}} -> D_N0{{0}} -> Y_N0{{0}}', 0.76, false FROM c WHERE s3 IS NOT NULL AND s3.q - s2.q <= 2)"""


def _chains(spark, d):
    units = X.event_units(spark, d)
    return C.detect_chains(units, R.detect_relations(units, "run_events", halo=2 * L.MAX_DISTANCE), "run_events")


@query(_CHAINS + " SELECT 'chain_' || substr(sha256('run_events::' || chain_type || '::' || unit_ids || '::' || relation_ids), 1, 16) AS chain_id, document_id, chain_type, unit_ids, relation_ids, evidence_summary, CAST(score AS DOUBLE) AS score, needs_review FROM chains")
def relation_chains(spark, d):
    return _chains(spark, d).select("chain_id", "document_id", "chain_type", F.array_join("unit_ids", "|").alias("unit_ids"), F.array_join("relation_ids", "|").alias("relation_ids"), "evidence_summary", "score", "needs_review")


@query(_CHAINS + " SELECT chain_type, count(*) AS n FROM chains GROUP BY chain_type")
def chain_counts(spark, d):
    return C.chain_summary(_chains(spark, d)).select("chain_type", "n")


@query(_CHAINS + " SELECT chain_type, count(*) AS n, count(*) FILTER (needs_review) AS needs_review FROM chains GROUP BY chain_type")
def chain_summary(spark, d):
    return C.chain_summary(_chains(spark, d))


@query(_RELATIONS + """ SELECT document_id, count(*) AS unit_count, sum(length(text) + 1) - 1 AS char_count, coalesce(max(n), 0) AS relation_count, coalesce(max(r), 0) AS relation_needs_review_count
FROM eu LEFT JOIN (SELECT document_id, count(*) AS n, count(*) FILTER (needs_review) AS r FROM rel GROUP BY 1) USING (document_id) GROUP BY document_id""")
def document_rollups(spark, d):
    own = U.document_rollups(X.event_units(spark, d), _relations(spark, d))
    return own.select("document_id", "unit_count", "char_count", "relation_count", "relation_needs_review_count")


@query(_RELATIONS + """, marked AS (SELECT relation_id, document_id, document_id % 2 = 0 AND relation_type = 'SUP' AS existing, bool_or(document_id % 2 = 0 AND relation_type = 'SUP') OVER (PARTITION BY document_id) AS has FROM rel)
SELECT relation_id, document_id, existing FROM marked WHERE existing OR NOT has""")
def attach_relations(spark, d):
    found = _relations(spark, d).select("relation_id", "document_id", "relation_type")
    kept = found.where("document_id % 2 = 0 AND relation_type = 'SUP'").withColumn("existing", F.lit(True))
    return R.attach_relations(kept, found.withColumn("existing", F.lit(False))).select("relation_id", "document_id", "existing")


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+')) AS token FROM documents),
n AS (SELECT doc_id, sha256(token) AS h, count(*) AS n FROM t GROUP BY ALL),
s AS (SELECT doc_id, CAST(('0x' || substr(h, 1, 8))::BIGINT % 128 AS INTEGER) AS bucket, sum(CASE WHEN ('0x' || substr(h, 9, 2))::BIGINT % 2 = 0 THEN n ELSE -n END) AS s FROM n GROUP BY ALL)
SELECT doc_id, bucket, round(s / sqrt(sum(s * s) OVER (PARTITION BY doc_id)), 6) AS weight FROM s WHERE s <> 0""")
def hash_embedding(spark, d):
    return Y.hash_embedding(table(spark, d, "documents"), "doc_id", "text").withColumn("weight", F.round("weight", 6))


def _similar(spark, d):
    return Y.similar_pairs(Y.normalise_vectors(table(spark, d, "embeddings"), "vec_id", "embedding", F.lit(0), F.col("vec_id")), 0.3, L.SIMILARITY_TOP_K)


_SIMILAR = """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.3),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS r FROM p),
pairs AS (SELECT i, j, s FROM k WHERE r <= 10 AND i < j)"""


@query(_SIMILAR + " SELECT i, j, round(s, 6) AS similarity FROM pairs")
def similarity_pairs(spark, d):
    return _similar(spark, d).withColumn("similarity", F.round("similarity", 6))


def _vector_units(spark, d):
    codes = [c for c in L.FUNCTIONS if c != "N"][:10]
    label = F.get(strings(*codes), F.col("label"))
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("unit_id"), F.col("vec_id").alias("document_id"), F.lit(0).alias("sequence_index"), F.lit("text").alias("text"), F.array(label).alias("functions"), label.alias("primary_function"), F.lit("none").alias("certainty"),
        F.when(F.col("label") % 2 == 0, "N").otherwise("A").alias("emotion_expressed"), F.lit("neutral").alias("stance"), strings().alias("emotions_mentioned"), F.lit(0.8).alias("confidence"),
    )


_CONFLICTS = _SIMILAR + """, u AS (SELECT vec_id, ['A','K','O','F','Y','D','Q','P','R','E'][label + 1] AS f, label % 2 AS e FROM embeddings),
c AS (
  SELECT i, j, s, a.f AS fa, b.f AS fb, (1 + 1 + CASE WHEN a.e = b.e THEN 0 ELSE 1 END) / 5 AS dist, a.e <> b.e AS emo FROM pairs JOIN u a ON a.vec_id = i JOIN u b ON b.vec_id = j WHERE a.f <> b.f),
con AS (
  SELECT 'sim_' || substr(sha256('run_vectors::' || least(i, j) || '::' || greatest(i, j)), 1, 16) AS conflict_id, i AS unit_id_a, j AS unit_id_b, round(dist, 6) AS notation_distance, round(s * dist * 0.8, 6) AS conflict_score,
    CASE WHEN fa IN ('A','K','O') AND fb IN ('A','K','O') THEN 'likely_inconsistency' ELSE 'needs_human_review' END AS conflict_explanation_type,
    CASE WHEN emo THEN 'functions,primary_function,emotion_expressed' ELSE 'functions,primary_function' END AS differing_fields FROM c)"""


@query(_CONFLICTS + " SELECT * FROM con")
def similarity_conflicts(spark, d):
    found = Y.conflicts(_similar(spark, d), _vector_units(spark, d), "run_vectors")
    return found.select("conflict_id", "unit_id_a", "unit_id_b", "notation_distance", "conflict_score", "conflict_explanation_type", F.array_join("differing_fields", ",").alias("differing_fields"))


@query(_CONFLICTS + " SELECT conflict_explanation_type, count(*) AS n, count(*) AS needs_review FROM con GROUP BY 1")
def conflict_explanations(spark, d):
    return Y.conflict_summary(Y.conflicts(_similar(spark, d), _vector_units(spark, d), "run_vectors"))


def _has(side: str, *codes: str) -> str:
    return f"list_has_any({side}.f, [{', '.join(repr(c) for c in codes)}])"


def _says(side: str, marker: str) -> str:
    return "(" + " OR ".join(f"contains({side}.low, '{m}')" for m in L.MARKERS[marker]) + ")"


_ANSWERS = "(" + " OR ".join(f"starts_with(lower(b.text), '{x}')" for x in L.ANSWER_STARTS) + ")"
#: Each rule on units a and b, a the earlier: condition, name, type, base, rejected types, and whether it points back.
_ALL_RULES = [
    (f"({_has('a', 'P')} OR {_says('a', 'QUESTION')}) AND ({_has('b', 'R')} OR {_ANSWERS})", "ANS_question_answer_anchor", "ANS", 0.92, 1, False),
    (f"{_has('b', 'Y')} AND {_has('a', 'A', 'K', 'O', 'R')} AND {_says('b', 'CAUSAL')}", "Y_explains_previous_claim", "CAUSE", 0.82, 1, True),
    (f"{_has('b', 'Y')} AND {_has('a', 'A', 'K', 'O', 'R')} AND NOT {_says('b', 'CAUSAL')}", "Y_explains_previous_claim", "EXPL", 0.74, 1, True),
    (f"{_has('b', 'D', 'Q')} AND {_has('a', 'A', 'K', 'O', 'Y')}", "evidence_supports_prior_claim", "SUP", 0.86, 2, True),
    (f"{_has('b', 'E')} AND {_has('a', 'A', 'K', 'F', 'Y', 'S')}", "example_illustrates_previous_unit", "EXMP", 0.82, 1, True),
    (f"{_has('b', 'G')} AND {_has('a', 'A', 'K', 'F', 'Y')}", "analogy_maps_to_previous_unit", "ANLG", 0.84, 1, True),
    (f"{_has('b', 'C')} OR {_says('b', 'CONTRAST')}", "contrast_with_previous_unit", "CONTR", 0.78, 1, True),
    (f"{_has('b', 'B')} OR {_says('b', 'REFUTATION')}", "refutation_targets_previous_unit", "REFUT", 0.84, 1, True),
    (f"{_has('b', 'X')} OR {_says('b', 'RISK')}", "risk_attaches_to_previous_unit", "RISK", 0.8, 1, True),
    (f"({_has('b', 'S')} OR {_says('b', 'SOLUTION')}) AND ({_has('a', 'X')} OR {_says('a', 'RISK')})", "solution_addresses_prior_risk", "SOLV", 0.86, 1, True),
    (_has("b", "V"), "viewer_call_attaches_to_previous_unit", "CALL", 0.72, 1, True),
    (f"{_has('b', 'Z')} AND {_has('a', 'A', 'K', 'Y', 'S', 'L')}", "conclusion_summarizes_previous_unit", "SUM", 0.76, 1, True),
    (_says("b", "CONDITION"), "condition_modifies_previous_unit", "COND", 0.76, 1, True),
]
_WEAK_RULES = [
    (f"{_has('a', 'A', 'K', 'F', 'M')} AND {_has('b', 'A', 'F', 'M', 'U')}", "adjacent_elaboration", "ELAB", 0.62, 1, True),
    (f"{_has('a', 'T', 'M', 'L')} OR {_has('b', 'T', 'M', 'L')}", "adjacent_structural_sequence", "SEQ", 0.6, 1, False),
]


def _case(rules: list) -> list[str]:
    return [f"CASE WHEN {c} THEN struct_pack(rule_id := '{n}', t := '{t}', base := {b}::DOUBLE, nrej := {k}, back := {str(w).lower()}) END" for c, n, t, b, k, w in rules]


_CODED_RELATIONS = f"""WITH {X.CODED_SQL},
p AS (
  SELECT a.document_id, a.unit_id AS fu, b.unit_id AS su, b.sequence_index - a.sequence_index AS dist, list_filter([{", ".join(_case(_ALL_RULES))}], lambda x: x IS NOT NULL) AS strong, coalesce({", ".join(_case(_WEAK_RULES))}) AS weak
  FROM cu a JOIN cu b ON a.document_id = b.document_id AND b.sequence_index BETWEEN a.sequence_index + 1 AND a.sequence_index + 3),
r AS (SELECT document_id, fu, su, dist, unnest(CASE WHEN len(strong) > 0 THEN strong WHEN dist = 1 AND weak IS NOT NULL THEN [weak] ELSE [] END) AS x FROM p),
rel AS (
  SELECT document_id, CASE WHEN x.back THEN su ELSE fu END AS source_unit_id, CASE WHEN x.back THEN fu ELSE su END AS target_unit_id, x.rule_id AS rule_id, x.t AS relation_type,
    round(x.base - 0.08::DOUBLE * (dist - 1), 4) AS confidence, x.base - 0.08::DOUBLE * (dist - 1) < 0.7 OR x.nrej > 1 AS needs_review FROM r WHERE round(x.base - 0.08::DOUBLE * (dist - 1), 4) >= 0.58)"""


def _coded_relations(spark, d):
    return R.detect_relations(X.coded_units(spark, d), "run_coded")


@query(_CODED_RELATIONS + " SELECT document_id, source_unit_id, target_unit_id, rule_id, relation_type, confidence, needs_review FROM rel")
def document_relations(spark, d):
    return _coded_relations(spark, d).select("document_id", "source_unit_id", "target_unit_id", "rule_id", "relation_type", "confidence", "needs_review")


@query(_CODED_RELATIONS + " SELECT rule_id, relation_type, count(*) AS n, count(*) FILTER (needs_review) AS needs_review FROM rel GROUP BY ALL")
def relation_rule_counts(spark, d):
    return _coded_relations(spark, d).groupBy("rule_id", "relation_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("needs_review").alias("needs_review"))


def _pattern_sql(name: str, steps: tuple[tuple[str, ...], ...]) -> str:
    """Chains of one pattern of three steps from w(document_id, l), l the six units from each on."""
    takes = [f"list_has_any(x.f, [{', '.join(repr(c) for c in s)}])" for s in steps]
    return f"""SELECT DISTINCT document_id, '{name}' AS chain_type, s1.u || '|' || s2.u || '|' || s3.u AS unit_ids FROM (
  SELECT document_id, s1, s2, list_filter(l, lambda x: x.q > s2.q AND {takes[2]})[1] AS s3 FROM (
    SELECT document_id, l, s1, list_filter(l, lambda x: x.q > s1.q AND {takes[1]})[1] AS s2 FROM (
      SELECT document_id, l, list_filter(l, lambda x: {takes[0]})[1] AS s1 FROM w) WHERE s1 IS NOT NULL)
  WHERE s2 IS NOT NULL AND s2.q - s1.q <= {L.CHAIN_GAP}) WHERE s3 IS NOT NULL AND s3.q - s2.q <= {L.CHAIN_GAP}"""


@query(f"""WITH {X.CODED_SQL},
w AS (SELECT document_id, list(struct_pack(q := sequence_index, f := f, u := unit_id)) OVER (PARTITION BY document_id ORDER BY sequence_index ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS l FROM cu)
""" + " UNION ALL ".join(_pattern_sql(name, steps) for name, steps, _ in L.SEQUENCE_CHAINS))
def document_sequence_chains(spark, d):
    own = C.sequence_chains(X.coded_units(spark, d))
    return own.select("document_id", "chain_type", F.array_join(F.transform("members", lambda m: m["unit_id"]), "|").alias("unit_ids"))


def _told_units(spark, d):
    """Vectors as units of four a document, with sets of functions and texts that every explanation of a conflict turns up for."""
    k = F.col("vec_id")
    pick = lambda n, *v: F.get(F.array(*v), (k % n).cast("int"))
    functions = pick(7, strings("A"), strings("A", "V"), strings("R"), strings("Y"), strings("K"), strings("E"), strings("R", "X"))
    return table(spark, d, "embeddings").select(
        k.alias("unit_id"), F.floor(k / 4).alias("document_id"), (k % 4).cast("int").alias("sequence_index"), pick(3, F.lit("para ti"), F.lit("¿por qué?"), F.lit("nada")).alias("text"), functions.alias("functions"), F.get(functions, F.lit(0)).alias("primary_function"),
        F.lit("none").alias("certainty"), F.when(k % 2 == 0, "N").otherwise("A").alias("emotion_expressed"), F.lit("neutral").alias("stance"), F.when(k % 5 == 0, strings("T")).otherwise(strings()).alias("emotions_mentioned"), F.lit(0.8).alias("confidence"),
    )


@query(_SIMILAR + """, u AS (
  SELECT vec_id AS k, [['A'], ['A', 'V'], ['R'], ['Y'], ['K'], ['E'], ['R', 'X']][vec_id % 7 + 1] AS f, ['para ti', '¿por qué?', 'nada'][vec_id % 3 + 1] AS text, vec_id % 2 AS e, CASE WHEN vec_id % 5 = 0 THEN ['T'] ELSE [] END AS m,
    coalesce(contains(lag(['para ti', '¿por qué?', 'nada'][vec_id % 3 + 1]) OVER (PARTITION BY vec_id // 4 ORDER BY vec_id), '¿'), false) AS before FROM embeddings),
met AS (
  SELECT i, j, a.f AS fa, b.f AS fb, a.text = 'para ti' OR b.text = 'para ti' AS address, (contains(a.text, '¿') OR a.before) AS qa, (contains(b.text, '¿') OR b.before) AS qb, a.e <> b.e AS emo, len(a.m) <> len(b.m) AS told,
    list_concat(list_filter(a.f, lambda x: NOT list_contains(b.f, x)), list_filter(b.f, lambda x: NOT list_contains(a.f, x))) AS odd, list_distinct(list_concat(a.f, b.f)) AS every,
    (1 - len(list_intersect(a.f, b.f)) / len(list_distinct(list_concat(a.f, b.f))) + CASE WHEN a.f[1] = b.f[1] THEN 0 ELSE 1 END + CASE WHEN a.e = b.e THEN 0 ELSE 1 END) / 5 AS distance
  FROM pairs JOIN u a ON a.k = i JOIN u b ON b.k = j),
told AS (
  SELECT i, j, distance, CASE WHEN odd = ['V'] AND address THEN 'viewer'
    WHEN list_has_any(fa, ['R', 'Y']) AND list_has_any(fb, ['R', 'Y']) AND list_contains(every, 'R') AND list_contains(every, 'Y') AND qa <> qb THEN 'context'
    WHEN list_has_any(fa, ['A', 'K', 'O']) AND list_has_any(fb, ['A', 'K', 'O']) AND list_filter(fa, lambda x: x IN ('A', 'K', 'O')) <> list_filter(fb, lambda x: x IN ('A', 'K', 'O')) THEN 'claims'
    WHEN emo OR told THEN 'emotion' ELSE 'other' END AS branch FROM met WHERE (len(odd) > 0 OR emo OR told) AND distance > 0)
SELECT i AS unit_id_a, j AS unit_id_b, round(distance, 6) AS notation_distance, branch NOT IN ('viewer', 'context') AS needs_review,
  CASE branch """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.EXPLANATIONS.items()) + " END AS explanation FROM told")
def told_conflicts(spark, d):
    found = Y.conflicts(_similar(spark, d), _told_units(spark, d), "run_told")
    return found.select("unit_id_a", "unit_id_b", "notation_distance", "needs_review", "explanation")


@query(f"WITH {X.LABELLED_SQL} SELECT unit_id, round(1 - len(list_intersect(functions, ['A','D'])) / len(list_distinct(list_concat(functions, ['A','D']))), 6) AS label_distance FROM lu")
def label_distance(spark, d):
    return X.labelled_units(spark, d).select("unit_id", F.round(Y.label_distance(F.col("functions"), strings("A", "D")), 6).alias("label_distance"))


# Gold is the validated unit; predictions carry other codes, miss every ninth unit and add every eleventh under another id.
def _gold_and_predictions(spark, d):
    gold = Q.validate(X.labelled_units(spark, d))
    k = F.col("k")
    raw = X.labelled_units(spark, d).withColumn("functions", F.when(k % 4 == 0, strings("A", "X")).when(k % 4 == 1, F.array_union("functions", strings("D"))).otherwise(F.col("functions")))
    raw = raw.withColumn("unit_id", F.when(k % 11 == 0, F.concat(F.lit("extra"), k.cast("string"))).otherwise(F.col("unit_id")))
    return gold, Q.validate(raw.where(k % 9 != 0))


_PREDICTED = _VALID.replace("FROM labels JOIN documents USING (doc_id)", "FROM labels JOIN documents USING (doc_id) WHERE doc_id % 9 <> 0").replace(
    "a AS (SELECT *, " + CODES + " AS f0 FROM lu)",
    "lup AS (SELECT * REPLACE (CASE WHEN k % 4 = 0 THEN ['A','X'] WHEN k % 4 = 1 THEN list_concat(functions, ['D']) ELSE functions END AS functions, CASE WHEN k % 11 = 0 THEN 'extra' || k ELSE unit_id END AS unit_id) FROM lu),\na AS (SELECT *, " + CODES + " AS f0 FROM lup)",
)
RATES = (
    "functions_exact_match", "primary_function_accuracy", "multilabel_jaccard", "micro_f1", "emotion_expressed_accuracy", "emotion_intensity_mae", "stance_accuracy", "certainty_accuracy",
    "overlabeling_rate", "n_rate", "validator_violation_rate", "needs_review_rate", "regression_pass_rate",
)
_BOTH = f"WITH gold AS ({_VALID} SELECT * FROM v), pred AS ({_PREDICTED} SELECT * FROM v)"
_CELLS = """, side AS (
  SELECT unit_id, unnest(functions) AS label, 1 AS g, 0 AS p FROM gold UNION ALL SELECT unit_id, unnest(functions), 0, 1 FROM pred),
cells AS (SELECT unit_id, label, max(g) AS g, max(p) AS p FROM side GROUP BY ALL),
counts AS (
  SELECT label, count(*) FILTER (g = 1 AND p = 1) AS tp, count(*) FILTER (g = 0 AND p = 1 AND unit_id IN (SELECT unit_id FROM gold)) AS fp, count(*) FILTER (g = 1 AND p = 0) AS fn FROM cells GROUP BY label)"""


# Ratios are rounded to 4 digits and F1 is taken from the rounded ones, as the figures of a report are; compared to 3 digits.
_PRF = "CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 4) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 4) ELSE 0 END AS r"


@query(_BOTH + _CELLS + f" SELECT label, tp, fp, fn, round(p, 3) AS precision, round(r, 3) AS recall, round(CASE WHEN p + r > 0 THEN round(2 * p * r / (p + r), 4) ELSE 0 END, 3) AS f1 FROM (SELECT *, {_PRF} FROM counts)")
def eval_label_metrics(spark, d):
    gold, pred = _gold_and_predictions(spark, d)
    return E.label_metrics(pred, gold).select("label", "tp", "fp", "fn", *[F.round(c, 3).alias(c) for c in ("precision", "recall", "f1")])


@query(_BOTH + " SELECT g.primary_function AS gold_primary, p.primary_function AS predicted_primary, count(*) AS n FROM gold g JOIN pred p USING (unit_id) WHERE g.primary_function <> p.primary_function GROUP BY ALL")
def eval_confusions(spark, d):
    gold, pred = _gold_and_predictions(spark, d)
    return E.confusions(pred, gold)


@query(_BOTH + " SELECT unit_id, 'missing' AS side FROM gold WHERE unit_id NOT IN (SELECT unit_id FROM pred) UNION ALL SELECT unit_id, 'unexpected' FROM pred WHERE unit_id NOT IN (SELECT unit_id FROM gold)")
def eval_missing_unexpected(spark, d):
    gold, pred = _gold_and_predictions(spark, d)
    return E.missing_and_unexpected(pred, gold)


@query(_BOTH + """, m AS (
  SELECT g.functions AS gf, p.functions AS pf, g.primary_function = p.primary_function AS same, g.final_notation = p.final_notation AND NOT p.needs_review AS reg, g.emotion_expressed = p.emotion_expressed AS emo,
    g.stance = p.stance AS st, g.certainty = p.certainty AS cert, abs(g.emotion_intensity - p.emotion_intensity) AS err FROM gold g JOIN pred p USING (unit_id)),
sums AS (SELECT sum(len(list_intersect(gf, pf))) AS tp, sum(len(pf) - len(list_intersect(gf, pf))) AS fp, sum(len(gf) - len(list_intersect(gf, pf))) AS fn FROM m)
SELECT (SELECT count(*) FROM gold) AS total_gold_units, (SELECT count(*) FROM pred) AS total_predicted_units, count(*) AS matched_units,
  round(count(*) FILTER (list_sort(gf) = list_sort(pf)) / count(*), 3) AS functions_exact_match, round(count(*) FILTER (same) / count(*), 3) AS primary_function_accuracy,
  round(count(*) FILTER (reg) / count(*), 3) AS regression_pass_rate, round((SELECT count(*) FILTER (needs_review) / count(*) FROM pred), 3) AS needs_review_rate,
  round(round(avg(round(len(list_intersect(gf, pf)) / len(list_distinct(list_concat(gf, pf))), 4)), 4), 3) AS multilabel_jaccard, (SELECT round(2 * tp / (2 * tp + fp + fn), 3) FROM sums) AS micro_f1,
  round(count(*) FILTER (emo) / count(*), 3) AS emotion_expressed_accuracy, round(sum(err) / count(*), 3) AS emotion_intensity_mae, round(count(*) FILTER (st) / count(*), 3) AS stance_accuracy, round(count(*) FILTER (cert) / count(*), 3) AS certainty_accuracy,
  (SELECT count(*) FROM gold WHERE unit_id NOT IN (SELECT unit_id FROM pred)) AS missing_predictions, (SELECT count(*) FROM pred WHERE unit_id NOT IN (SELECT unit_id FROM gold)) AS unexpected_predictions,
  (SELECT round(count(*) FILTER (len(functions) > 5) / count(*), 3) FROM pred) AS overlabeling_rate, (SELECT round(count(*) FILTER (list_contains(functions, 'N')) / count(*), 3) FROM pred) AS n_rate, (SELECT round(sum(len(flags)) / count(*), 3) FROM pred) AS validator_violation_rate FROM m""")
def eval_run_metrics(spark, d):
    gold, pred = _gold_and_predictions(spark, d)
    m = E.run_metrics(pred, gold)
    return m.select("total_gold_units", "total_predicted_units", "matched_units", "missing_predictions", "unexpected_predictions", *[F.round(c, 3).alias(c) for c in RATES])


_REASONS = _VALID + """, r AS (SELECT *, list_filter([
  CASE WHEN needs_review THEN 'needs_review' END, CASE WHEN len(flags) > 0 THEN 'validator_flags' END, CASE WHEN len(list_filter(functions, lambda c: c NOT IN ('F','P','V','N'))) > 0 THEN 'confusable_functions' END,
  CASE WHEN emotion_intensity >= 3 THEN 'intense_emotion' END, CASE WHEN len(emotions_mentioned) > 0 THEN 'emotions_mentioned' END, CASE WHEN len(functions) > 3 THEN 'many_functions' END,
  CASE WHEN confidence < 0.85 THEN 'low_or_medium_confidence' END], lambda x: x IS NOT NULL) AS reasons FROM v),
q AS (
  SELECT *, CASE WHEN list_contains(reasons, 'confusable_functions') THEN 'hard' WHEN len(list_intersect(reasons, ['validator_flags','needs_review','low_or_medium_confidence'])) > 0 THEN 'medium' ELSE 'easy' END AS difficulty,
    CASE WHEN list_contains(reasons, 'confusable_functions') THEN 'resolve_confusion' WHEN len(list_intersect(reasons, ['validator_flags','needs_review'])) > 0 THEN 'find_alternative' ELSE 'validate' END AS goal FROM r),
items AS (
  SELECT 'review_' || substr(sha256('unit::' || unit_id || '::' || array_to_string(reasons, ',')), 1, 16) AS review_item_id, unit_id, difficulty, goal, reasons FROM q WHERE len(reasons) > 0
  UNION ALL
  SELECT 'review_' || substr(sha256('unit::' || unit_id || '::high_confidence_sample'), 1, 16), unit_id, 'easy', 'validate', ['high_confidence_sample']
  FROM (SELECT unit_id FROM v WHERE confidence >= 0.85 AND NOT needs_review AND len(flags) = 0 ORDER BY confidence DESC, unit_id LIMIT 10))"""


@query(_REASONS + " SELECT unit_id, array_to_string(reasons, ',') AS reasons FROM r")
def review_reasons(spark, d):
    return Q.validate(X.labelled_units(spark, d)).select("unit_id", F.array_join(V.review_reasons(F.lit(False)), ",").alias("reasons"))


@query(_REASONS + " SELECT review_item_id, 'unit' AS item_type, unit_id AS unit_ids, array_to_string(reasons, ',') AS reasons, difficulty, goal FROM items")
def review_set(spark, d):
    own = V.build_review_set(Q.validate(X.labelled_units(spark, d)))
    return own.select("review_item_id", "item_type", F.array_join("unit_ids", "|").alias("unit_ids"), F.array_join("reasons", ",").alias("reasons"), "difficulty", "goal")


_WITH_CONFLICTS = _REASONS.replace("CASE WHEN len(list_filter(functions, lambda c: c NOT IN", "CASE WHEN k % 10 < 2 THEN 'similarity_conflict' END, CASE WHEN len(list_filter(functions, lambda c: c NOT IN", 1)
_WITH_CONFLICTS = _WITH_CONFLICTS.replace("CASE WHEN list_contains(reasons, 'confusable_functions') THEN", "CASE WHEN list_contains(reasons, 'confusable_functions') OR list_contains(reasons, 'similarity_conflict') THEN")
# Every tenth unit and the next id are a pair in conflict; only pairs of units that are there make an item.
_WITH_CONFLICTS += """,
named AS (SELECT unit_id, k, document_id, text FROM v),
around AS (
  SELECT unit_id, md5(array_to_string(list_filter([lag(text, 2) OVER w, lag(text) OVER w], lambda x: x IS NOT NULL), chr(10))) AS before, md5(array_to_string(list_filter([lead(text) OVER w, lead(text, 2) OVER w], lambda x: x IS NOT NULL), chr(10))) AS after
  FROM named WINDOW w AS (PARTITION BY document_id ORDER BY k)),
pairs AS (SELECT 'c' || a.k AS conflict_id, a.unit_id AS ua, b.unit_id AS ub FROM named a JOIN named b ON b.k = a.k + 1 WHERE a.k % 10 = 0)
SELECT review_item_id, 'unit' AS item_type, unit_id AS unit_ids, array_to_string(reasons, ',') AS reasons, difficulty, goal, before, after FROM items JOIN around USING (unit_id)
UNION ALL SELECT 'review_' || substr(sha256('similar_pair::' || conflict_id), 1, 16), 'similar_pair', ua || '|' || ub, 'similarity_conflict', 'hard', 'resolve_confusion', md5(''), md5('') FROM pairs
UNION ALL SELECT 'review_' || substr(sha256('minimal_pair::m1'), 1, 16), 'minimal_pair', '', 'minimal_pair', 'hard', 'resolve_confusion', md5(''), md5('')"""


@query(_WITH_CONFLICTS)
def review_set_conflicts(spark, d):
    units = Q.validate(X.labelled_units(spark, d))
    k = F.col("k")
    both = units.where(k % 10 < 2).select(F.concat(F.lit("c"), (k - k % 10).cast("string")).alias("conflict_id"), F.concat(F.lit("unit"), (k - k % 10).cast("string")).alias("unit_id_a"), F.concat(F.lit("unit"), (k - k % 10 + 1).cast("string")).alias("unit_id_b")).distinct()
    minimal = spark.createDataFrame([("m1", "one", "two")], "pair_id string, text_a string, text_b string")
    own = V.build_review_set(units, both, minimal)
    lines = lambda c: F.md5(F.array_join(c, "\n"))
    return own.select("review_item_id", "item_type", F.array_join("unit_ids", "|").alias("unit_ids"), F.array_join("reasons", ",").alias("reasons"), "difficulty", "goal", lines("context_before").alias("before"), lines("context_after").alias("after"))


@query(_REASONS + " SELECT 'unit' AS item_type, difficulty, goal, count(*) AS n FROM items GROUP BY ALL")
def review_manifest(spark, d):
    return V.review_manifest(V.build_review_set(Q.validate(X.labelled_units(spark, d))))


@query(f"WITH {X.LABELLED_SQL} SELECT unit_id, array_to_string(list_sort(list_distinct(flatten(list_filter([['A','K','O'],['R','Y'],['D','Q','K'],['E','H','G'],['S','I','U'],['C','B','X'],['T','M','L','Z']], lambda g: len(list_intersect(g, functions)) > 0)))), ',') AS labels FROM lu")
def confusable_labels(spark, d):
    return X.labelled_units(spark, d).select("unit_id", F.array_join(group_labels(F.col("functions"), L.REVIEW_CONFUSION_GROUPS), ",").alias("labels"))


def _votes(spark, d):
    """Events as reviewers' votes, three to an item: the type decides, the id makes the confidence."""
    decision = F.when(F.col("event_type").isin("view", "click"), "accept").when(F.col("event_type") == "error", "reject").otherwise("revise")
    confidence = F.lit(0.7) + (F.col("event_id") % 30) / 100
    return table(spark, d, "events").select(F.floor(F.col("event_id") / 3).alias("review_item_id"), F.col("event_id").alias("position"), decision.alias("decision"), confidence.alias("confidence"))


_VOTES = """WITH votes AS (
  SELECT event_id // 3 AS review_item_id, event_id AS position, CASE WHEN event_type IN ('view','click') THEN 'accept' WHEN event_type = 'error' THEN 'reject' ELSE 'revise' END AS decision, CAST(0.7 AS DOUBLE) + (event_id % 30) / 100 AS confidence FROM events),
counts AS (SELECT review_item_id, decision, count(*) AS n, min(position) AS first FROM votes GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY review_item_id ORDER BY n DESC, first) AS r FROM counts),
agg AS (
  SELECT review_item_id, nv AS n_votes, decision AS top_decision, n / nv AS a, m, CASE WHEN n / nv < 0.67 OR m < 0.75 THEN 'needs_review' ELSE decision END AS aggregate_decision
  FROM top JOIN (SELECT review_item_id, count(*) AS nv, avg(confidence) AS m FROM votes GROUP BY 1) USING (review_item_id) WHERE r = 1)"""
_FINALS = _VOTES + """, finals AS (
  SELECT review_item_id, CASE WHEN review_item_id % 4 = 0 THEN 'reject' ELSE aggregate_decision END AS final_decision,
    CASE WHEN review_item_id % 3 = 0 THEN 'synthetic_gold_high_confidence' WHEN review_item_id % 3 = 1 THEN 'synthetic_gold_medium_confidence' END AS gold_status, 0.75 + (review_item_id % 25) / 100 AS reliability_score FROM agg)"""


@query(_VOTES + " SELECT review_item_id, n_votes, top_decision, round(a, 4) AS agreement, aggregate_decision, aggregate_decision <> 'needs_review' AS needs_final_adjudication FROM agg")
def committee_vote(spark, d):
    own = V.committee_vote(_votes(spark, d))
    return own.select("review_item_id", "n_votes", "top_decision", "agreement", "aggregate_decision", "needs_final_adjudication")


@query(_VOTES + " SELECT count(*) AS items, round(avg(round(a, 4)), 3) AS inter_reviewer_agreement FROM agg")
def inter_reviewer_agreement(spark, d):
    own = V.decision_counts(_votes(spark, d)).groupBy("review_item_id").agg(F.round(F.max("n") / F.sum("n"), 4).alias("a"))
    return own.agg(F.count(F.lit(1)).alias("items"), F.round(F.avg("a"), 3).alias("inter_reviewer_agreement"))


def _finals(spark, d):
    k = F.col("review_item_id")
    own = V.committee_vote(_votes(spark, d))
    return own, own.select(
        "review_item_id", F.when(k % 4 == 0, "reject").otherwise(F.col("aggregate_decision")).alias("final_decision"),
        F.when(k % 3 == 0, "synthetic_gold_high_confidence").when(k % 3 == 1, "synthetic_gold_medium_confidence").alias("gold_status"), (F.lit(0.75) + (k % 25) / 100).alias("reliability_score"),
        F.lit(False).alias("needs_human_review"), F.concat(F.lit("u"), k.cast("string")).alias("unit_id"), F.lit("A_N0{0}").alias("final_notation"),
    )


@query(_FINALS + " SELECT count(*) AS comparable, count(*) FILTER (final_decision = aggregate_decision) AS agreed FROM agg JOIN finals USING (review_item_id) WHERE aggregate_decision <> 'needs_review'")
def adjudicator_agreement(spark, d):
    return V.adjudicator_agreement(*_finals(spark, d)).select("comparable", "agreed")


_CANDIDATES = _FINALS + ", candidates AS (SELECT review_item_id, gold_status AS status, reliability_score, 'synthetic_candidate_' || substr(sha256('run_votes::' || review_item_id || '::u' || review_item_id || '::A_N0{0}'), 1, 16) AS candidate_id FROM finals WHERE final_decision IN ('accept','revise') AND gold_status IS NOT NULL AND reliability_score >= 0.8)"


@query(_CANDIDATES + " SELECT candidate_id, review_item_id, status, CASE WHEN status = 'synthetic_gold_high_confidence' THEN 'high' ELSE 'medium' END AS bucket FROM candidates")
def gold_buckets(spark, d):
    return V.gold_buckets(V.gold_candidates(_finals(spark, d)[1], "run_votes")).select("candidate_id", "review_item_id", "status", "bucket")


@query(_CANDIDATES + " SELECT candidate_id FROM candidates WHERE status = 'synthetic_gold_high_confidence' AND reliability_score >= 0.9")
def regression_eligible(spark, d):
    return V.regression_eligible(V.gold_candidates(_finals(spark, d)[1], "run_votes")).select("candidate_id")


@query(_CANDIDATES + " SELECT coalesce(f.gold_status, c.status) AS status, count(*) AS n FROM (SELECT * FROM finals WHERE gold_status IS NOT NULL) f FULL JOIN candidates c USING (review_item_id) GROUP BY 1")
def gold_status_counts(spark, d):
    finals = _finals(spark, d)[1]
    return V.gold_status_counts(finals, V.gold_candidates(finals, "run_votes"))


@query(_CANDIDATES + """ SELECT (SELECT count(*) FROM votes) AS reviewer_output_count, (SELECT count(*) FROM agg) AS aggregated_review_count, (SELECT count(*) FROM candidates) AS synthetic_gold_candidate_count,
  (SELECT count(*) FROM candidates WHERE status = 'synthetic_gold_high_confidence' AND reliability_score >= 0.9) AS regression_eligible_count, (SELECT count(*) FROM finals WHERE final_decision = 'needs_review') AS needs_review_count""")
def reliability_metrics(spark, d):
    votes = _votes(spark, d)
    aggregated, finals = _finals(spark, d)
    m = V.reliability_metrics(votes, aggregated, finals, V.gold_candidates(finals, "run_votes"), 100)
    return m.select("reviewer_output_count", "aggregated_review_count", "synthetic_gold_candidate_count", "regression_eligible_count", "needs_review_count")


@query(_VALID + " SELECT k % 20 AS document_id, string_agg(final_notation, ' ' ORDER BY k) AS sequence FROM v GROUP BY 1")
def dna_sequences(spark, d):
    own = Q.validate(X.labelled_units(spark, d)).select((F.col("k") % 20).alias("document_id"), F.col("k").alias("sequence_index"), "final_notation")
    return sinks.notation_sequences(own)


@query(_VALID + " SELECT unit_id, array_to_string(functions, '+') AS functions, array_to_string(emotions_mentioned, '+') AS emotions_mentioned, final_notation FROM v")
def csv_units(spark, d):
    return sinks.csv_columns(Q.validate(X.labelled_units(spark, d)).select("unit_id", "functions", "emotions_mentioned", "final_notation"))


@query("SELECT event_id, list_count(json_keys(props)) AS n_keys FROM events")
def json_contract_roundtrip(spark, d):
    props = F.from_json("props", "map<string,string>")
    again = F.from_json(F.to_json(props), "map<string,string>")
    return table(spark, d, "events").select("event_id", F.size(again).cast("long").alias("n_keys"))


#: As in the SQL.
_DIGIT = re.compile("[0-9]")


def stub_transport(request: str) -> str:
    """A model that answers from the text alone, for tests and dry systems."""
    text = json.loads(request).get("text") or ""
    return f'{{"functions": ["{"D" if _DIGIT.search(text) else "A"}"], "confidence": 0.9}}'


@query(_rules_sql() + """, p AS (SELECT DISTINCT document_id, seq FROM hits WHERE code = 'P' AND s IS NOT NULL),
u AS (SELECT pieces.*, row_number() OVER (PARTITION BY document_id ORDER BY seq DESC) AS back FROM pieces), z AS (SELECT DISTINCT document_id, seq FROM hits JOIN u USING (document_id, seq) WHERE code = 'Z' AND s IS NOT NULL AND back <= 3)
SELECT u.lang, CASE WHEN p.seq IS NOT NULL THEN 'P' WHEN z.seq IS NOT NULL THEN 'Z' WHEN regexp_matches(u.text, '\\d') THEN 'D' ELSE 'A' END AS primary_function, 'llm' AS method, count(*) AS n
FROM u LEFT JOIN p USING (document_id, seq) LEFT JOIN z USING (document_id, seq) GROUP BY ALL""")
def llm_stub_classify(spark, d):
    # Names of units differ where those of documents do.
    distinct = table(spark, d, "documents").groupBy("doc_id").count().where("count > 1").isEmpty()
    by = ("lang", "primary_function", "method")
    own = M.classify(H.annotate(X.units(spark, d, context=2, offsets=False), normalise=False), stub_transport, parallel=None, distinct=distinct, only=by)
    return own.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))

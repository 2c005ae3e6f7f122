import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from fableloom.operators import chains, evaluate, heuristics, model_calls, relations, review, rollups, segment, similarity, validate

UNIT = "document_id string, unit_id string, sequence_index int, text string, normalized_text string, functions array<string>, final_notation string"


def units(spark, *rows, document="d"):
    return spark.createDataFrame([(document, f"u{i}", i, t, t.lower(), list(f), f"{f}_N0{{0}}") for i, (f, t) in enumerate(rows)], UNIT)


def labelled(spark, **changes):
    base = dict(document_id="d", unit_id="u", sequence_index=0, text="text", normalized_text="text", functions=["A"], primary_function="A", secondary_functions=["A"], certainty="none", emotion_expressed="N", emotion_intensity=0, emotions_mentioned=["N"], stance="neutral", confidence=0.9, needs_review=False, review_reasons=["x"], final_notation="")
    kinds = {list: "array<string>", str: "string", int: "int", float: "double", bool: "boolean"}
    return spark.createDataFrame([Row(**(base | changes))], ", ".join(f"{k} {kinds[type(v)]}" for k, v in base.items()))


def flags(df):
    return [f["rule_id"] for f in df.first()["validator_flags"]]


def test_segment_offsets_and_neighbours(spark):
    text = "Primera idea.  Segunda idea? ¿Tercera? Palabra " + "palabra " * 60 + "fin, " + "x" * 300
    found = segment.segment_texts(spark.createDataFrame([("a", text), ("b", None), ("c", "")], "document_id string, text string")).orderBy("sequence_index").collect()
    whole = " ".join(text.split())
    assert {r.document_id for r in found} == {"a"}
    assert all(whole[r.char_start : r.char_end] == r.text for r in found)
    assert " ".join(r.text for r in found) == whole
    assert all(len(r.text) <= 280 or " " not in r.text for r in found)
    assert [r.text for r in found][:3] == ["Primera idea.", "Segunda idea?", "¿Tercera?"]
    assert found[0].unit_id == "a_u00000" and found[0].previous_unit_id is None and found[1].previous_unit_id == "a_u00000"


def test_pieces_keep_digits_like_their_number(spark):
    own = spark.createDataFrame([("a", "Uno. 1 dos 1. 28.68.191.2"), ("b", "Uno. 1"), ("c", "Fin, " + "4" * 200 + " " + "x" * 70 + ", 1" + "y" * 60)], "document_id string, text string")
    found = segment.segment_texts(own).orderBy("document_id", "sequence_index").collect()
    assert [r.text for r in found if r.document_id == "a"] == ["Uno.", "1 dos 1.", "28.68.191.2"]
    assert [r.text for r in found if r.document_id == "b"] == ["Uno.", "1"]
    assert [r.text for r in found if r.document_id == "c"] == ["Fin,", "4" * 200 + " " + "x" * 70 + ",", "1" + "y" * 60]


def test_segment_timing(spark):
    own = spark.createDataFrame([("a", 0, "Una. Dos. Tres.", 0, 9000), ("a", 1, "Sola.", None, None)], "document_id string, segment_index int, text string, start_ms long, end_ms long")
    found = segment.segment_timed(own).orderBy("sequence_index").collect()
    assert [(r.start_ms, r.end_ms) for r in found] == [(0, 3000), (3000, 6000), (6000, 9000), (None, None)]
    assert [r.approximate_timing for r in found] == [True, True, True, False]


def test_heuristics(spark):
    rows = [("A", "¿Según el estudio, 20% creció?"), ("A", "Pero bueno, nada."), ("A", "Pero no."), ("A", "En resumen, la gente siente miedo."), ("A", "Nada")]
    found = heuristics.annotate(units(spark, *rows)).orderBy("sequence_index").collect()
    assert found[0].locked_functions == ["P"] and found[0].candidate_functions == ["D"]
    assert found[1].candidate_functions == [] and found[2].candidate_functions == ["C"]
    assert found[3].locked_functions == ["Z"] and found[3].candidate_emotions_mentioned == ["M"]
    assert found[2].evidence_spans[0]["text"] == "Pero"
    assert found[4].signals == []


@pytest.mark.parametrize(
    ("changes", "wanted"),
    [
        (dict(functions=["N", "P", "V"], primary_function="P"), ["N_exclusive"]),
        (dict(functions=["A", "K", "Y"], primary_function="K"), ["K_inherits_A"]),
        (dict(functions=["D"], primary_function="D"), ["D_without_evidence"]),
        (dict(functions=["R"], primary_function="R"), ["R_without_question_anchor"]),
        (dict(emotion_expressed="M", emotion_intensity=2, text="tengo miedo"), ["possible_emotion_confusion"]),
        (dict(functions=list("AOFYDQ"), text="20 %"), ["possible_overlabeling"]),
        (dict(functions=["Y"], primary_function="K"), ["primary_function_required"]),
        (dict(final_notation="wrong"), ["notation_derivation"]),
        (dict(), []),
    ],
)
def test_validate(spark, changes, wanted):
    once = validate.validate(labelled(spark, **changes))
    assert flags(once) == wanted
    again = validate.validate(once)
    assert flags(again) == wanted and again.first()["final_notation"] == once.first()["final_notation"]


def test_relations(spark):
    rows = [("P", "¿Qué pasa?"), ("R", "La respuesta es esta"), ("K", "Afirmo"), ("D", "20 %"), ("Y", "porque sí"), ("X", "Cuidado"), ("S", "Conviene parar")]
    found = {(r.source_unit_id, r.target_unit_id, r.relation_type): r for r in relations.detect_relations(units(spark, *rows), "run_rel").collect()}
    assert {("u0", "u1", "ANS"), ("u3", "u2", "SUP"), ("u4", "u2", "CAUSE"), ("u6", "u5", "SOLV")} <= set(found)
    assert found["u0", "u1", "ANS"].relation_id == "rel_654197a7829a27bb"
    assert found["u4", "u2", "CAUSE"].confidence == 0.74 and found["u3", "u2", "SUP"].needs_review
    assert all(0 < r.distance <= 3 for r in found.values())


def test_chains(spark):
    rows = [("X", "a"), ("SI", "b"), ("V", "c")]
    found = chains.sequence_chains(units(spark, *rows)).collect()
    assert [(r.chain_type, [m["unit_id"] for m in r.members]) for r in found] == [("problem_solution_call_sequence", ["u0", "u1", "u2"])]
    kdy = units(spark, ("K", "Afirmo"), ("D", "20 %"), ("Y", "porque sí"))
    both = chains.detect_chains(kdy, relations.detect_relations(kdy)).collect()
    assert {r.chain_type for r in both} >= {"claim_evidence_explanation_sequence", "claim_support_explanation"}
    assert all(r.start_unit_id == r.unit_ids[0] for r in both)


def brute_match(rows, steps):
    taken = []
    for i, f in rows:
        if len(taken) == len(steps) or (taken and i - taken[-1] > 2):
            break
        if set(f) & set(steps[len(taken)]):
            taken.append(i)
    return taken if len(taken) == len(steps) else None


def test_chains_in_cuts_are_those_of_joined_relations(spark):
    import random

    pick = random.Random(5)
    own = units(spark, *[(pick.choice("ADYZXA"), "text") for _ in range(60)])
    rows = lambda df: sorted(map(str, df.collect()))
    whole = rows(chains.relation_chains(own, relations.detect_relations(own, "r")))
    assert len(whole) == len(set(whole)) > 60
    for size in (8, 17, 100):
        near = chains.relation_chains(own, relations.detect_relations(own, "r", halo=6, size=size), size=size)
        assert rows(near) == whole
    # Only the order of units moves anything.
    assert near._jdf.queryExecution().executedPlan().toString().split("== Initial")[0].count("Exchange hash") == 1


def test_blocks_grow_before_they_become_many():
    assert [similarity.block_count(n) for n in (0, 4096, 5000, 50_000, 390_000, 1_000_000)] == [1, 1, 2, 12, 12, 31]
    assert similarity.block_count(50, 7) == 8


def test_sequence_matching_against_brute_force(spark):
    import random

    from fableloom.functions.lexicon import SEQUENCE_CHAINS

    r = random.Random(3)
    rows = [("".join(r.sample("AKODQYECBSZXIUVLT", r.randint(1, 2))), "t") for _ in range(120)]
    wanted = set()
    for name, steps, _ in SEQUENCE_CHAINS:
        for s in range(len(rows)):
            if m := brute_match([(i, rows[i][0]) for i in range(s, min(len(rows), s + 6))], steps):
                wanted.add((name, *m))
    found = {(x.chain_type, *[m["sequence_index"] for m in x.members]) for x in chains.sequence_chains(units(spark, *rows)).collect()}
    assert found == wanted and wanted


def test_similarity(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0])], "id long, v array<double>")
    pairs = similarity.similar_pairs(similarity.normalise_vectors(vectors, "id", "v", F.lit(0), F.col("id")), 0.8, 1).collect()
    assert [(p.i, p.j) for p in pairs] == [(1, 2)]
    a = labelled(spark, unit_id="a", document_id="a", functions=["A"], primary_function="A")
    b = labelled(spark, unit_id="b", document_id="b", functions=["K"], primary_function="K")
    found = similarity.conflicts(spark.createDataFrame([("a", "b", 0.95)], "i string, j string, similarity double"), a.union(b)).first()
    assert found.conflict_explanation_type == "likely_inconsistency" and found.notation_distance == 0.4
    v = labelled(spark, unit_id="b", document_id="b", functions=["A", "V"], text="para ti")
    assert similarity.conflicts(spark.createDataFrame([("a", "b", 0.95)], "i string, j string, similarity double"), a.union(v)).first().conflict_explanation_type == "allowed_by_taxonomy"


@pytest.mark.parametrize("block", [7, 64])
def test_nearest_against_all_pairs(spark, block):
    import numpy as np

    r = np.random.default_rng(block)
    v = np.round(r.normal(size=(60, 3)), 0)
    v[v.any(1) == 0] = 1
    rows = [(f"i{k}", f"d{k // 9}", k % 9, x.tolist()) for k, x in enumerate(v)]
    frame = spark.createDataFrame(rows, "id string, doc string, seq long, v array<double>")
    vectors = similarity.normalise_vectors(frame, "id", "v", F.col("doc"), F.col("seq"))
    found = {(p.i, p.j) for p in similarity.similar_pairs(vectors, 0.5, 3, block, skip_neighbours=True).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    wanted = set()
    for a, (i, di, si, _) in enumerate(rows):
        near = [(-round(float(u[a] @ u[b]), 12), dj, sj, j) for b, (j, dj, sj, _) in enumerate(rows) if a != b and u[a] @ u[b] >= 0.5 - 1e-12 and not (di == dj and abs(si - sj) == 1)]
        wanted |= {(i, j) for _, dj, sj, j in sorted(near)[:3] if (di, si) < (dj, sj)}
    assert found == wanted


def hashed_units(n, words=3000, seed=1):
    """Rows (id, doc, seq, v) of texts of some 20 words with few frequent ones, in 128 buckets; every tenth text is like the one before."""
    import numpy as np

    r = np.random.default_rng(seed)
    bucket, sign, often = r.integers(0, 128, words), r.choice([-1.0, 1.0], words), 1 / (np.arange(words) + 10)
    drawn = r.choice(words, (n, 22), p=often / often.sum())
    rows = []
    for k in range(n):
        if k % 10 or not k:
            w = drawn[k]
        else:
            w = w.copy()
            w[: k // 10 % 6] = r.integers(0, words, k // 10 % 6)
        v = np.zeros(128)
        np.add.at(v, bucket[w], sign[w])
        rows.append((k, k // 40, k % 40, v))
    return rows


@pytest.mark.parametrize("head", [8, 32, 64])
def test_bounds_lose_no_pair(spark, head):
    import numpy as np

    rows = hashed_units(900)
    frame = spark.createDataFrame([(i, d, s, v.tolist()) for i, d, s, v in rows], "id long, doc long, seq long, v array<double>")
    vectors = similarity.normalise_vectors(frame, "id", "v", F.col("doc"), F.col("seq"))
    found = {(p.i, p.j) for p in similarity.similar_pairs(vectors, 0.82, 4, 200, head=head).collect()}
    norm = np.array([np.linalg.norm(v) for _, _, _, v in rows])
    u = np.array([v / n if n else v for (_, _, _, v), n in zip(rows, norm)])
    cos = np.round(u @ u.T, 12)
    wanted = set()
    for i in range(len(rows)):
        near = sorted((-cos[i, j], j) for j in range(len(rows)) if j != i and norm[j] and cos[i, j] >= 0.82)[:4]
        wanted |= {(i, int(j)) for _, j in near if i < j}
    assert found == wanted and len(wanted) > 40


def test_few_pairs_are_compared(spark):
    """Of all pairs of distinct vectors, whole vectors are multiplied for less than a tenth."""
    n = 8000
    frame = spark.createDataFrame([(i, d, s, v.tolist()) for i, d, s, v in hashed_units(n)], "id long, doc long, seq long, v array<double>")
    vectors = similarity.normalise_vectors(frame, "id", "v", F.col("doc"), F.col("seq"))
    _, first = similarity.vector_classes(vectors, 1)
    found = similarity.near_classes(first.select("cls", "doc", "seq", "vector"), 0.82, 13)
    compared = found.agg(F.sum("compared")).first()[0]
    assert 0 < compared < n * n / 10


def test_ten_thousand_equal_units(spark):
    frame = spark.range(10_000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    vectors = similarity.normalise_vectors(frame, "id", "v", F.lit(0), F.col("id"))
    assert similarity.similar_pairs(vectors, 0.8, 10).count() == sum(range(1, 11))  # only the first rows are near to later ones


def test_rollups_and_attached_relations(spark):
    own = units(spark, ("P", "¿Qué?"), ("R", "Es esto"), ("K", "Afirmo"), ("D", "20 %"))
    found = relations.detect_relations(own, "r")
    assert all(r.evidence_spans[0]["source"] == f"relation_detector:{r.rule_id}" and r.method == "heuristic" and bool(r.validator_flags) == r.needs_review for r in found.collect())
    row = rollups.document_rollups(own, found, chains.detect_chains(own, found)).first()
    assert (row.unit_count, row.char_count, row.has_timestamps, row.relation_count) == (4, 25, False, found.count())
    earlier = found.limit(1)
    assert relations.attach_relations(earlier, found).count() == 1
    other = relations.detect_relations(units(spark, ("P", "¿Qué?"), ("R", "Es esto"), document="e"))
    assert relations.attach_relations(earlier, found.unionByName(other)).count() == 1 + other.count()


def test_long_document_offsets(spark):
    text = " ".join(f"Frase número {i}." for i in range(3000))
    found = segment.segment_texts(spark.createDataFrame([("a", text)], "document_id string, text string"))
    rows = found.orderBy("sequence_index").collect()
    assert len(rows) == 3000 and all(text[r.char_start : r.char_end] == r.text and r.unit_count == 3000 for r in rows)
    assert all(a.next_unit_id == b.unit_id and b.previous_unit_id == a.unit_id for a, b in zip(rows, rows[1:]))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_adjudication_settles_flags(spark):
    own = validate.validate(labelled(spark, functions=["D"], primary_function="D", review_reasons=[])).withColumn("risks", F.array(F.lit("D_without_evidence")))
    own = own.withColumns({"method": F.lit("llm")})
    good = model_calls.adjudicate(own, lambda r: '{"functions": ["A"], "primary_function": "A"}').first()
    assert good.functions == ["A"] and [f["rule_id"] for f in good.validator_flags] == ["adjudication_applied"] and good.validator_flags[0]["message"]
    bad = model_calls.adjudicate(own, lambda r: "none").first()
    assert bad.functions == ["D"] and bad.needs_review and bad.review_reasons[-1] == "adjudication_failed" and [f["rule_id"] for f in bad.validator_flags] == ["D_without_evidence", "adjudication_failed"]
    grown = model_calls.adjudicate(own, lambda r: '{"functions": ["A", "D"]}').first()
    assert grown.functions == ["D"]  # no more functions without evidence


def test_spans_are_merged(spark):
    kind = "array<struct<text:string,char_start:int,char_end:int,source:string>>"
    own = spark.createDataFrame([([("a", 0, 1, "x"), ("b", 1, 2, "x")], [("a", 0, 1, "x"), ("a", 0, 1, "y")], None)], f"s {kind}, t {kind}, n {kind}")
    row = own.select(model_calls.merge_spans(F.col("s"), F.col("t")).alias("m"), model_calls.merge_spans(F.col("n"), F.col("t")).alias("k"), model_calls.merge_spans(F.col("n"), F.col("n")).alias("e")).first()
    assert [(x["text"], x["source"]) for x in row.m] == [("a", "x"), ("b", "x"), ("a", "y")] and len(row.k) == 2 and row.e == []


def test_evaluate(spark):
    gold = validate.validate(labelled(spark, unit_id="1").union(labelled(spark, unit_id="2", functions=["K"], primary_function="K")))
    pred = validate.validate(labelled(spark, unit_id="1").union(labelled(spark, unit_id="2", functions=["X"], primary_function="X")).union(labelled(spark, unit_id="9")))
    m = evaluate.run_metrics(pred, gold).first()
    assert (m.functions_exact_match, m.primary_function_accuracy, m.multilabel_jaccard, m.micro_f1) == (0.5, 0.5, 0.5, 0.5)
    assert (m.missing_predictions, m.unexpected_predictions) == (0, 1)
    by_label = {r.label: (r.tp, r.fp, r.fn) for r in evaluate.label_metrics(pred, gold).collect()}
    assert by_label == {"A": (1, 0, 0), "K": (0, 0, 1), "X": (0, 1, 0)}
    same = evaluate.run_metrics(gold, gold).first()
    assert same.micro_f1 == same.macro_f1 == same.regression_pass_rate == 1.0
    empty = evaluate.run_metrics(pred.limit(0), gold.limit(0)).first()
    assert empty.micro_f1 == 0 and empty.matched_units == 0


def test_gold_is_checked(spark):
    unit = F.struct("unit_id", "functions")
    own = labelled(spark).select(F.lit("synthetic_gold_medium_confidence").alias("gold_type"), unit.alias("unit"))
    with pytest.raises(Exception, match="not usable as gold"):
        evaluate.gold_units(own).collect()
    assert evaluate.gold_units(own.withColumn("gold_type", F.lit("human_gold"))).count() == 1
    bare = labelled(spark)
    assert evaluate.gold_units(bare.select(F.struct("*").alias("unit"))).columns == evaluate.gold_units(bare).columns == bare.columns
    with pytest.raises(Exception, match="not usable as gold"):
        evaluate.gold_units(bare.withColumn("status", F.lit("rejected"))).collect()


def test_committee(spark):
    votes = spark.createDataFrame([("a", 0, "accept", 0.9), ("a", 1, "accept", 0.9), ("a", 2, "reject", 0.9), ("b", 0, "revise", 0.9), ("b", 1, "revise", 0.8)], "review_item_id string, position int, decision string, confidence double")
    found = {r.review_item_id: r for r in review.committee_vote(votes).collect()}
    assert found["a"].aggregate_decision == "needs_review" and found["a"].agreement == 0.6667
    assert found["b"].aggregate_decision == "revise" and found["b"].confidence == 0.85
    finals = review.fallback_finals(review.committee_vote(votes))
    assert {r.final_decision for r in finals.collect()} == {"needs_review"}


def test_review_set(spark):
    own = validate.validate(labelled(spark, unit_id="1", functions=["F"], primary_function="F", review_reasons=[], emotions_mentioned=[]).union(labelled(spark, unit_id="2", functions=["K"], primary_function="K", confidence=0.5, review_reasons=[], emotions_mentioned=[])))
    items = review.build_review_set(own).collect()
    assert {(i.unit_ids[0], i.difficulty) for i in items} == {("1", "easy"), ("2", "hard")}
    risks = {r.unit_id: r.risks for r in review.adjudication_reasons(own).collect()}
    assert risks["1"] == [] and "low_confidence" in risks["2"]


def test_filters_on_validated_units_do_not_search_their_texts_again(spark):
    own = validate.validate(labelled(spark))
    for out in (own.where(F.size("validator_flags") > 0), validate.flag_summary(own), review.build_review_set(own)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Contains(" in plan and not [line for line in plan.splitlines() if "Filter " in line and "Contains(" in line]


def test_model_calls(spark, tmp_path):
    log = tmp_path / "calls"

    def transport(request):
        with log.open("a") as f:
            f.write("x")
        if "slow" in request and log.read_text() == "x":
            raise model_calls.TransientError("busy")
        if "bad" in request:
            return "no json"
        return 'Here: ```json\n{"label": "ok"}\n``` done'

    ask = lambda *r, **k: {x.cache_key: x for x in model_calls.call_model(spark.createDataFrame([(x,) for x in r], "request string"), transport, lambda d: None if d.get("label") == "ok" else "wrong", backoff=(0.0, 0.0), parallel=1, **k).collect()}
    (slow,) = ask("slow").values()
    assert slow.ok and slow.attempts == 2 and json.loads(slow.response) == {"label": "ok"}
    (bad,) = ask("bad").values()
    assert not bad.ok and bad.attempts == 1
    before = log.read_text()
    (dry,) = ask("slow", dry_run=True).values()
    assert dry.ok and dry.response is None
    cache = spark.createDataFrame([(slow.cache_key, slow.response)], "cache_key string, response string")
    (hit,) = ask("slow", cache=cache).values()
    assert hit.ok and hit.attempts == 0 and log.read_text() == before
    store = str(tmp_path / "answers")
    assert {x.ok for x in ask("one", "bad", store=store).values()} == {True, False}
    before = log.read_text()
    assert {x.attempts for x in ask("one", "two", store=store).values()} == {0, 1} and len(log.read_text()) == len(before) + 1


def test_requests_are_moved_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(model_calls, "settled", lambda df: seen.append(df) or df)
    asked = spark.createDataFrame([(f'{{"k": {k % 50}}}',) for k in range(100)], "request string")
    found = model_calls.call_model(asked, lambda request: '{"a": 1}', lambda answer: None, parallel=3)
    assert found.count() == 50 and found.select("cache_key").distinct().count() == 50
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("== Initial")[0]
    assert plan.count("Exchange hash") == 1 and seen[0].rdd.getNumPartitions() == 3


def told(df):
    return sorted(map(str, df.select("unit_id", "functions", "primary_function", "method", "needs_review", "review_reasons", "confidence", "evidence_spans", "llm_usage").collect()))


def test_distinct_requests_are_asked_where_they_stand(spark, monkeypatch, tmp_path):
    texts = [("a", "Uno. ¿Dos? malo. Tres 4. Pero no. En resumen, fin."), ("b", "Solo uno"), ("c", "malo. Bueno, dijo: sí")]
    cut = segment.segment_texts(spark.createDataFrame(texts, "document_id string, text string"), context=2)
    own, plain = (heuristics.annotate(u, normalise=False) for u in (cut, cut.drop("context_before", "context_after")))
    asked = lambda df: sorted(r.request for r in model_calls.classification_requests(df).collect())
    assert asked(own) == asked(plain) and '"before":["Uno."],' in asked(own)[1]
    log, seen, keep = tmp_path / "calls", [], model_calls.settled

    def reply(request):
        with log.open("a") as f:
            f.write("x")
        return "nothing" if "malo" in json.loads(request)["text"] else ('{"functions": ["N", "A"], "confidence": 0.9}', {"input_tokens": 7})

    wanted = told(model_calls.classify(plain, reply))
    n = len(log.read_text())
    monkeypatch.setattr(model_calls, "settled", lambda df: seen.append(df) or keep(df))
    found = model_calls.classify(own, reply, distinct=True)
    assert told(found) == told(found) == wanted and len(log.read_text()) == 2 * n == 2 * own.count()
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan
    assert model_calls.classify(own, reply, distinct=True, only=("unit_id", "method")).columns == ["unit_id", "method"]


def test_stub_query_cuts_texts_once_and_keeps_repeated_documents(spark, monkeypatch, tmp_path):
    from fableloom.plans import catalogue

    rows = [(1, "Uno. ¿Dos? Tres 4.", "es"), (2, "One. Two 2.", "en"), (3, None, "en"), (4, "En resumen, fin.", "es")]
    seen, keep = [], model_calls.settled
    monkeypatch.setattr(model_calls, "settled", lambda df: seen.append(df) or keep(df))

    def counted(rows):
        d = str(tmp_path / str(len(seen)))
        spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{d}/documents.parquet")
        return sorted(tuple(r) for r in catalogue.llm_stub_classify(spark, d).collect())

    assert counted(rows) == [("en", "A", "llm", 1), ("en", "D", "llm", 1), ("es", "A", "llm", 1), ("es", "D", "llm", 1), ("es", "P", "llm", 1), ("es", "Z", "llm", 1)]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate posexplode") == 1 and "Exchange hash" not in plan and seen[0].columns == ["lang", "primary_function", "method"]
    # The same document twice, and another text under an id that is taken.
    assert counted([*rows, rows[1], (4, "Fin. 5", "fr")]) == [("en", "A", "llm", 2), ("en", "D", "llm", 2), ("es", "A", "llm", 1), ("es", "D", "llm", 1), ("es", "P", "llm", 1), ("es", "Z", "llm", 1), ("fr", "A", "llm", 1), ("fr", "D", "llm", 1)]


def test_classify_keeps_locks_and_falls_back(spark):
    own = heuristics.annotate(units(spark, ("N", "¿Qué dices?"), ("N", "malo")))
    reply = lambda r: "nothing" if "malo" in json.loads(r)["text"] else '{"functions": ["A"], "primary_function": "A", "confidence": 0.9}'
    found = {r.unit_id: r for r in model_calls.classify(own, reply).collect()}
    assert found["u0"].functions == ["A", "P"] and found["u0"].primary_function == "P" and found["u0"].needs_review
    assert found["u1"].functions == ["N"] and found["u1"].method == "heuristic" and found["u1"].confidence == 0.6

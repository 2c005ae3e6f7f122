import json

from pyspark.sql import functions as F

from fableloom.plans import run
from fableloom.plans.catalogue import ORACLES, QUERIES, stub_transport


def test_run_without_a_model(spark, tmp_path):
    docs = spark.createDataFrame([("a", "¿Qué pasa hoy? La respuesta es clara. Pero hay un riesgo. Conviene parar."), ("b", "Nada.")], "document_id string, text string")
    out = run.run_corpus(docs, str(tmp_path), "run_t")
    units = out["units"].collect()
    assert {u.final_notation for u in units} == {"N_N0{0}"} and len(units) == 5
    kinds = {r.relation_type for r in out["relations"].collect()}
    assert {"ANS", "CONTR", "SOLV"} <= kinds and out["chains"].count() > 0
    assert out["manifest"].first().run_id == "run_t"
    assert run.review_run(spark, str(tmp_path)).count() == 5


def test_run_with_a_model_review_and_evaluation(spark, tmp_path):
    docs = spark.createDataFrame([("a", "Subió 20 por ciento. Todo bien por aquí."), ("b", "Subió 20 por ciento. Todo bien por aquí.")], "document_id string, text string")
    out = run.run_corpus(docs, str(tmp_path), "run_m", stub_transport, with_similarity=True)
    assert {u.unit_id: u.primary_function for u in out["units"].collect()} == {"a_u00000": "D", "a_u00001": "A", "b_u00000": "D", "b_u00001": "A"}
    # In their contexts all four read alike; those labelled differently are conflicts, but for neighbours.
    assert {(c.unit_id_a, c.unit_id_b) for c in out["similarity_conflicts"].collect()} == {("a_u00000", "b_u00001"), ("a_u00001", "b_u00000")}
    reviewers = spark.createDataFrame([("r1", 0, "x"), ("r2", 1, "y")], "reviewer_id string, position int, profile string")
    run.review_run(spark, str(tmp_path))

    def judge(request):
        asked = json.loads(request)
        if asked["profile"] == "final":
            return json.dumps({"decision": "accept", "confidence": 0.95, "gold_status": "synthetic_gold_high_confidence"})
        return "no answer" if asked["profile"] == "y" else json.dumps({"decision": "accept", "confidence": 0.9})

    vote = run.committee_run(spark, str(tmp_path), reviewers, judge, "run_m")
    n = vote["aggregated"].count()
    assert {r.aggregate_decision for r in vote["aggregated"].collect()} == {"accept"} and vote["votes"].count() == n > 0
    assert {(r.profile, r.error is None) for r in vote["failures"].collect()} == {("r2", False)} and vote["failures"].count() == n
    assert vote["gold_candidates"].count() > 0 and run.reliability_run(spark, str(tmp_path)).first().regression_eligible_count == vote["gold_candidates"].count()
    scores = run.evaluate_run(spark, str(tmp_path), out["units"].withColumn("functions", F.col("functions")))
    assert scores["evaluation"].first().micro_f1 == 1.0


def test_each_unit_is_asked_about_once(spark, tmp_path):
    log = tmp_path / "calls"

    def transport(request):
        with log.open("a") as f:
            f.write(json.loads(request)["unit_id"] + ("R" if "risks" in json.loads(request) else "") + "\n")
        return json.dumps({"functions": ["A"], "confidence": 0.5})

    docs = spark.createDataFrame([(f"d{i}", "Una frase corta. Otra frase corta.") for i in range(10)], "document_id string, text string")
    out = run.run_corpus(docs, str(tmp_path / "run"), "run_o", transport)
    calls = log.read_text().split()
    assert len(calls) == len(set(calls)) == 40 and out["units"].count() == 20  # each once, and each doubtful one once more
    assert {r.relation_count >= 0 and r.unit_count for r in out["document_rollups"].collect()} == {2}


def test_every_query_with_sql_is_registered():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 40

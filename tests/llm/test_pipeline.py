import random

import corpus_pipeline
from fableloom.llm.common import table
from fableloom.llm.decontamination import find_contamination
from fableloom.llm.near_dups import find_near_duplicates
from fableloom.llm.quality_rules import judge_quality


def write(spark, folder):
    r = random.Random(8)
    words = ["".join(r.choices("aeioulmnrst", k=r.randint(3, 8))) for _ in range(800)]
    prose = [" ".join(w for k in range(70) for w in (r.choice(words), "the" if k % 4 == 0 else r.choice(words))) + "." for _ in range(60)]
    passage = " ".join(r.choices(words, k=25))
    texts = [*prose, prose[3].replace(".", " end."), prose[4], "short text", prose[5].upper().replace(" ", "!! "), prose[6][:300] + " " + passage + " " + prose[7][300:], None, ""]
    texts += [p.replace(" the ", " vilefool ", 2) for p in (" ".join(r.sample(prose[i].split(), 120)) for i in range(20))]
    labels = [(i, 1, 0) for i in range(60)] + [(i, 1, 1) for i in range(len(texts) - 20, len(texts))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return len(texts)


def test_stages(spark, tmp_path):
    d = str(tmp_path)
    n = write(spark, d)
    docs = table(spark, d, "documents")
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, d)
        docs.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        assert docs.columns == before.columns
        after[name] = {r.doc_id for r in docs.collect()}
    start = table(spark, d, "documents")
    assert after["quality_rules"] == {r.doc_id for r in judge_quality(start).where("kept").collect()} and set(range(60)) <= after["quality_rules"]
    toxic = set(range(n - 20, n))
    assert not after["toxicity"] & toxic and set(range(60)) <= after["toxicity"]
    kept = find_near_duplicates(spark.read.parquet(f"{d}/toxicity")).where("kept").collect()
    assert after["near_dedup"] == {r.doc_id for r in kept} and not after["near_dedup"] & {60, 61}
    hit = find_contamination(spark.read.parquet(f"{d}/near_dedup"), table(spark, d, "benchmark")).where("contaminated").collect()
    assert {r.doc_id for r in hit} == {64} and after["decontamination"] == after["near_dedup"] - {64}
    pieces = corpus_pipeline.run(spark, d)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == after["decontamination"]
    assert corpus_pipeline.STAGES[-1][0] == "packing"

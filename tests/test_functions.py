import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fableloom.functions.notation import compile_notation, group_labels, jaccard, normalize_codes, strings
from fableloom.functions.text import folded, hash_id, normalized
from fableloom.functions.lexicon import REVIEW_CONFUSION_GROUPS


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def notation(*codes, certainty="none", emotion="N", intensity=0, stance="neutral", always=False):
    return compile_notation(strings(*codes), F.lit(certainty), F.lit(emotion), F.lit(intensity), F.lit(stance), always)


@pytest.mark.parametrize(
    ("made", "wanted"),
    [
        (dict(codes="PV", emotion="S", intensity=1), "(P+V)_S1{0}"),
        (dict(codes="YK", certainty="strong", emotion="E", intensity=2, stance="negative"), "(K+Y)!_E2{-}"),
        (dict(codes="SIU", emotion="C", intensity=1, stance="positive"), "(S+I+U)_C1{+}"),
        (dict(codes="N"), "N_N0{0}"),
        (dict(codes="K", intensity=1, always=True), "(K)_N1{0}"),
    ],
)
def test_notation(spark, made, wanted):
    codes = made.pop("codes")
    assert one(spark, notation(*codes, **made)) == wanted


@pytest.mark.parametrize("bad", [dict(certainty="maybe"), dict(stance="x"), dict(intensity=4)])
def test_notation_fails_without_symbol(spark, bad):
    with pytest.raises(PySparkException):
        one(spark, notation("A", **bad))


def test_normalized(spark):
    own = spark.createDataFrame([("Hola​  “vida”\r\nnueva …",), (None,), ("",), ("ﬁn",)], "t string")
    assert [r.x for r in own.select(normalized(F.col("t")).alias("x")).collect()] == ['Hola "vida" nueva ...', None, "", "fin"]


def test_folded(spark):
    assert one(spark, folded(F.lit("ÁRBOL  Según Ñandú"))) == "arbol segun nandu"


def test_codes(spark):
    assert one(spark, normalize_codes(strings("N", "A", "?", "A"))) == ["A", "N", "?"]
    assert one(spark, normalize_codes(F.lit(None).cast("array<string>"))) == []
    assert one(spark, jaccard(strings("A", "V"), strings("A"))) == 0.5
    assert one(spark, group_labels(strings("T"), REVIEW_CONFUSION_GROUPS)) == ["L", "M", "T", "Z"]


def test_hash_id(spark):
    assert one(spark, hash_id("rel_", "run_rel", "u0", "u1", "RelationType.ANS", "ANS_question_answer_anchor")) == "rel_654197a7829a27bb"


def test_texts_settled_without_python_are_as_python_has_them(spark):
    from fableloom.functions import text as t

    import pandas as pd

    chars = [chr(i) for i in range(1, 0x3000) if not 0xD800 <= i < 0xE000]
    texts = [*chars, *[f"a{c}B́" for c in chars[:0x200]], "Año ſüß – „x“ İ", "", None]
    own = spark.createDataFrame(list(enumerate(texts)), "k int, x string").select("k", t.compatible(F.col("x")).alias("c"), t.bare(F.col("x")).alias("b"), F.rlike("x", F.lit(t._UNCOMMON)).alias("sent")).orderBy("k").collect()
    assert [r.c for r in own] == list(t._compatible(pd.Series(texts, dtype=object)))
    assert [r.b for r in own] == list(t._bare(pd.Series(texts, dtype=object)))
    assert not any(r.sent for r, x in zip(own, texts) if x and x in "abcXYZ áéñüß¿¡«»–—“”")


def test_normalised_texts_are_as_python_has_them(spark):
    import re
    import unicodedata

    from fableloom.functions import text as t

    def plain(x):
        x = unicodedata.normalize("NFKC", x)
        x = "".join(t.REPLACED.get(c, c) for c in x if c not in t.ZERO_WIDTH).replace("\u2026", "...")
        return re.sub(r"[\s\x1c-\x1f\x85]+", " ", x).strip(" ")

    texts = [f" a{chr(i)}  b{chr(i)}{chr(i)}c\td" for i in (*range(1, 0x2100), *range(0x3000, 0x3010), 0xFEFF, 0x1F600, 0x1D400)]
    own = spark.createDataFrame(list(enumerate(texts)), "k int, x string").select("k", normalized(F.col("x")).alias("n")).orderBy("k").collect()
    assert [r.n for r in own] == [plain(x) for x in texts]
    # Whole texts are not searched by classes of many ranges, of which ASCII has no part.
    assert t._UNSTABLE.startswith("(?=[^\\x00-\\x7f])") and t._UNCOMMON.startswith("(?=[^\\x00-\\x7f])")


def test_texts_that_may_match_hold_all_that_do(spark):
    from fableloom.functions import lexicon
    from fableloom.functions import text as t

    rules = (*[p for r in lexicon.FUNCTION_RULES for p in r[3]], *lexicon.CONCLUSION_PATTERNS, r"\b¿que\b", r"\b3 veces\b", r"\bste\b", r"\bte\b", r"\bte digo\b")
    words = ["te", "te recomiendo", "ste", "texto", "dijo: no", "dijo:", "año¿que", "en resumen", "13 veces", "3 veces", "ñte", "te1", "datos", "datosa", 'x "y" z', "50%", "haz algo", "no haz", "porque", "por que", "٣", "nada", ""]
    texts = [*words, *[f"{a}{b}{c}" for a in ("x ", "(", "é", "_", "1") for b in words for c in ("", ".", "s", "_", "é", " y")]]
    own = spark.createDataFrame([(x,) for x in texts], "x string").select("x", t.matches_any(F.col("x"), rules).alias("is"), t.may_match(F.col("x"), rules).alias("may"))
    found = own.collect()
    assert not [r.x for r in found if r["is"] and not r.may] and [r.x for r in found if not r.may]
    assert own.where("x IN ('nada', 'texto', 'datosa', 'no haz')").where("may").count() == 0
    assert spark.range(1).select(t.may_match(F.lit("a"), (r"\d",)).alias("m")).first().m is False


def test_units_do_not_carry_their_document(spark):
    """Made rows of a long document took the square of its length, as each held all pieces; signals were looked for twice."""
    from fableloom.operators import heuristics, segment

    docs = spark.createDataFrame([("a", "Una frase. " * 2000, "es")], "document_id string, text string, lang string")
    found = heuristics.counts_by_lang(heuristics.with_signals(segment.segment_texts(docs, keep=("lang",)).withColumn("folded", folded(F.col("text"), normalise=False)), F.lit(False)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    carried = [line for line in plan.splitlines() if "Generate" in line and "posexplode" in line]
    assert carried and not any("_pieces" in line.split("), [")[1].split("]")[0] for line in carried)
    assert plan.split("== Initial")[0].count("ArrowEvalPython") == 2

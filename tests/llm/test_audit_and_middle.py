import hashlib
import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from fableloom.llm import fill_middle as M
from fableloom.llm import filter_audit as A
from fableloom.llm import queries as Q


def plain_audit(docs, labels):
    """The rows of audit_filters by applying every order to every document."""
    good, toxic = ({i for i, q, t in labels if x(q, t) == 1 and i is not None} for x in (lambda q, t: q, lambda q, t: t))
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = {}
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        parts.setdefault(s or "", []).append((i, {k for k, v in fails.items() if v}))
    out, shapley = {}, {}
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for k, f in enumerate(order):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                failing = [r for r in rows if f in r[1]]
                out[part, order, k + 1] = (len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in rows), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(df, labels):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in A.audit_filters(df, labels).collect()}


def test_audit_against_every_order(spark, clashing):
    rng = random.Random(3)
    long = lambda: " ".join(rng.choice("abcdefghij") * rng.randrange(1, 30) for _ in range(rng.choice([150, 199, 200, 260])))
    texts = [long() for _ in range(25)] + [long().upper() for _ in range(4)] + [long() + " a|b" for _ in range(4)] + [None, "", " \n", "ÄÖÜ", "A", "ß#"]
    docs = [(i, rng.choice(texts), rng.choice(["x", "y", "", None])) for i in range(150)]
    docs += [(None, texts[0], "x"), (None, texts[0], "z"), (4, texts[1], "x"), (4, texts[1], "x"), (0, texts[1], "y")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(None, 1, 1), (2, 1, 1), (9999, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    # Of repeated labels one is enough.
    want = plain_audit(docs, labels)
    assert audited(df, marks) == want
    assert audited(clashing(df).withColumn("mask", F.lit(1)).withColumn("part", F.lit("q")), clashing(marks)) == want
    assert len(want) == 600 * len({s or "" for _, _, s in docs})


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit_filters(none, marks).count() == 0
    one = spark.createDataFrame([(1, None, None)], none.schema)
    assert {k[0] for k in audited(one, marks)} == {""}


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(i, text, seed=42):
    """n, form, prefix_chars, middle_chars and output of one document."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 80 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def middle_of(df):
    return sorted((tuple(r) for r in M.fill_middle(df).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=repr)


def test_middle_against_plain(spark, docs, clashing):
    rng = random.Random(5)
    piece = lambda: rng.choice(["word", "ä", "𝒳y", " ", "\n\n", "\t", " ", "<", "S>", "<S", "\x0b", "<M", "1"])
    texts = ["".join(piece() for _ in range(rng.randrange(0, 60))) for _ in range(300)] + ["a <P> b", "<M>", "  ", "x " * 100_000, "\n" * 5000]
    df = docs(*texts)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = sorted(((i, *plain_middle(i, t)) for i, t in rows), key=repr)
    assert middle_of(df) == want
    assert middle_of(clashing(df).withColumns({"form": F.lit("x"), "n": F.lit(1), "copies": F.lit(2)})) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert middle_of(df.limit(0)) == []
    back = M.fill_middle(df).select("doc_id", M.restored(F.col("form"), F.col("output")).alias("t"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(i, t or "") for i, t in rows], key=repr)


def test_repeated_rows_come_back_as_often(spark):
    i = next(i for i in range(100) if plain_middle(i, "a b c")[1] != "plain")
    df = spark.range(25_001).select(F.lit(i).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    got = M.fill_middle(df).groupBy("doc_id", "output").count().collect()
    assert [tuple(r) for r in got] == [(i, plain_middle(i, "a b c")[4], 25_001)]


def test_units_are_not_shuffled(spark, docs):
    """Texts move once; no exchange is dealt by the ordinal."""
    plan = M.fill_middle(docs("a b", "c d"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange" in x]
    assert exchanges and all("hashpartitioning(key#" in x and "ordinal" not in x for x in exchanges)


def test_queries_carry_sql():
    assert {"op11_exact_dedup", "op12_filter_audit", "op13_fill_middle"} <= set(Q.ORACLES)

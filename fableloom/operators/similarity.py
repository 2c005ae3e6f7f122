"""Units that read alike but are labelled differently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..functions import lexicon as L
from ..functions.notation import jaccard, same_set, strings
from ..functions.text import folded, hash_id, matches_any, tokens
from .heuristics import asked, has_any
from .segment import with_neighbours


def hash_embedding(texts: DataFrame, key: str, text: str, size: int = L.EMBEDDING_SIZE) -> DataFrame:
    """key, bucket and weight: signed token counts in hashed buckets, scaled to length 1. Texts without tokens have no rows."""
    digest = F.sha2(F.col("token"), 256)
    bucket = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % size).cast("int")
    sign = F.when(F.conv(F.substring(digest, 9, 2), 16, 10).cast("int") % 2 == 0, 1.0).otherwise(-1.0)
    # Partial sums per token first: a token's digest is taken once for each text and not for each occurrence.
    counted = texts.select(key, F.explode(tokens(folded(F.col(text), normalise=False))).alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy(key, bucket.alias("bucket")).agg(F.sum(sign * F.col("n")).alias("s")).where("s <> 0")
    norm = F.sqrt(F.sum(F.col("s") * F.col("s")).over(Window.partitionBy(key)))
    return sums.select(key, "bucket", (F.col("s") / norm).alias("weight"))


def context_text(order: WindowSpec, text: str = "normalized_text") -> Column:
    """A unit's text between those of its neighbours."""
    return F.trim(F.concat_ws(" ", F.lag(text).over(order), F.col(text), F.lead(text).over(order)))


def heavy_first(vectors: DataFrame) -> list[int]:
    """The buckets of vectors(vector) by their sum of squares, the largest first; one number a bucket comes to the driver."""
    found = vectors.select(F.posexplode("vector").alias("bucket", "weight")).groupBy("bucket").agg(F.sum(F.col("weight") * F.col("weight")).alias("mass"))
    return [r["bucket"] for r in found.orderBy(F.desc("mass"), "bucket").collect()]


#: Rows of a block where blocks are few, of one where there are many, and the number of small blocks that counts as few.
SMALL_BLOCK, LARGE_BLOCK, FEW_BLOCKS = 4096, 32768, 12


def block_count(rows: int, rows_per_block: int | None = None) -> int:
    """How many blocks rows are cut into. Every row is moved once for each block, so these grow with the rows before they become many."""
    if rows_per_block:
        return max(1, -(-rows // rows_per_block))
    return max(1, -(-rows // LARGE_BLOCK), min(-(-rows // SMALL_BLOCK), FEW_BLOCKS))


def near_classes(classes: DataFrame, threshold: float, most: int, rows_per_block: int | None = None, head: int = 32) -> DataFrame:
    """ci, cj, d, s and similarity of classes(cls, doc, seq, vector) at or above a cosine threshold, and how many pairs were compared.

    Exact. Each two blocks of vectors meet once in a task. There only the first
    ``head`` buckets, those that carry most of all weights, are multiplied for
    every pair; with the norms of the rest they bound the cosine from above, and
    whole vectors are multiplied only where that bound reaches the threshold. Of
    each class the ``most`` nearest of a block leave the task, the earlier by
    (doc, seq) among equals. One row a block pair has ci null and the number of
    pairs whose whole vectors were multiplied in ``compared``.
    """
    found = classes.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vector")).alias("size")).first()
    n = block_count(found["rows"], rows_per_block)
    order = heavy_first(classes) if (found["size"] or 0) > 2 * head else None
    own = classes.withColumn("own", F.pmod(F.xxhash64("cls"), F.lit(n)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    dealt = own.select(F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "cls", "doc", "seq", "vector")

    def products(a, b):
        """Rows, columns and cosines of the pairs at or above the threshold, and the number of pairs compared."""
        import numpy as np

        if order is None:
            found = np.round(a @ b.T, 12)
            r, c = np.nonzero(found >= threshold)
            return r, c, found[r, c], found.size
        rest = [np.sqrt(np.maximum(0, (m[:, head:] ** 2).sum(1))) for m in (a, b)]
        r, c = np.nonzero(a[:, :head] @ b[:, :head].T + np.outer(*rest) >= threshold - 1e-9)
        if len(r) > a.shape[0] * b.shape[0] / 4:  # one product of all is quicker then
            found = np.round(a @ b.T, 12)
            r, c = np.nonzero(found >= threshold)
            return r, c, found[r, c], found.size
        value = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", a[r[k : k + 65536]], b[c[k : k + 65536]]) for k in range(0, len(r), 65536)]])
        value = np.round(value, 12)
        near = value >= threshold
        return r[near], c[near], value[near], len(r)

    def multiply(pdf):
        import numpy as np
        import pandas as pd

        blocks = [pdf[pdf["own"] == k].sort_values(["doc", "seq"], kind="stable") for k in sorted({pdf["bi"].iat[0], pdf["bj"].iat[0]})]
        matrices = [np.stack(b["vector"]).astype(float)[:, order or slice(None)] if len(b) else np.zeros((0, 1)) for b in blocks]
        rows, compared = [], 0
        x, y = (0, 0) if len(blocks) == 1 else (0, 1)
        if len(blocks[x]) and len(blocks[y]):
            step = max(1, (1 << 21) // max(SMALL_BLOCK, len(blocks[y])))  # at most so many products at a time
            for start in range(0, len(blocks[x]), step):
                r, c, value, n_pairs = products(matrices[x][start : start + step], matrices[y])
                compared += n_pairs
                rows.append((r + start, c, value))
        r, c, value = (np.concatenate([p[k] for p in rows]) if rows else np.zeros(0, int) for k in range(3))
        sides = [(x, r, y, c)] + ([(y, c, x, r)] if x != y else [])
        parts = [pd.DataFrame({"ci": [None], "cj": [None], "d": blocks[0]["doc"].iloc[:1].tolist() if len(blocks[0]) else [None], "s": [0], "similarity": [0.0], "compared": [compared]})]
        for p, i, q, j in sides:
            best = np.lexsort((j, -value, i))  # rows stand in the order of (doc, seq)
            i, j, near = i[best], j[best], value[best]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            i, j, near = (v[place < most] for v in (i, j, near))
            a, b = blocks[p], blocks[q]
            parts.append(pd.DataFrame({"ci": a["cls"].to_numpy()[i], "cj": b["cls"].to_numpy()[j], "d": b["doc"].to_numpy()[j], "s": b["seq"].to_numpy()[j], "similarity": np.clip(near, 0, 1), "compared": 0}))
        return pd.concat([p for p in parts if len(p)], ignore_index=True)

    out = f"ci string, cj string, d {dict(classes.dtypes)['doc']}, s long, similarity double, compared long"
    return dealt.groupBy("bi", "bj").applyInPandas(multiply, out)


def normalise_vectors(frame: DataFrame, key: str, vector: str, doc: Column, seq: Column) -> DataFrame:
    """id, doc, seq and vector of length 1; zero vectors are left out, as they are like nothing."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    own = frame.select(F.col(key).alias("id"), doc.alias("doc"), seq.cast("long").alias("seq"), v.alias("v")).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    return own.where("norm > 0").select("id", "doc", "seq", F.transform("v", lambda x: x / F.col("norm")).alias("vector"))


def vector_classes(vectors: DataFrame, members: int) -> tuple[DataFrame, DataFrame]:
    """vectors with ``cls``, the same for equal vectors by a hash of 128 bits, and the first ``members`` of each class by doc and seq, numbered in ``place``."""
    named = vectors.withColumn("cls", F.concat_ws("-", F.xxhash64("vector"), F.xxhash64(F.lit("other"), "vector")))
    first = Window.partitionBy("cls").orderBy("doc", "seq", "id")
    return named, named.withColumn("place", F.row_number().over(first)).where(F.col("place") <= members)


def similar_pairs(vectors: DataFrame, threshold: float = L.SIMILARITY_THRESHOLD, top_k: int = L.SIMILARITY_TOP_K, rows_per_block: int | None = None, skip_neighbours: bool = False, head: int = 32) -> DataFrame:
    """i, j (i earlier by doc and seq) and similarity, where j is among the top_k of i. vectors(id, doc, seq, vector): of normalise_vectors.

    The cut to top_k comes first and for each row alone, so a pair counts only if
    the later one is near enough for the earlier. skip_neighbours: rows beside
    each other in one doc are left out before that.

    Equal vectors are one class: classes are compared once, and of each class only
    the first top_k + 3 rows can be among the nearest of any row, as a row leaves
    out itself and two neighbours at most. So a vector of a third of all rows costs
    one vector, and the pairs among its rows are never listed.
    """
    most = top_k + 3
    named, members = vector_classes(vectors, most)
    found = near_classes(members.where("place = 1").select("cls", "doc", "seq", "vector"), threshold, most, rows_per_block, head).where("ci IS NOT NULL")
    by_class = Window.partitionBy("ci").orderBy(F.desc("similarity"), "d", "s")
    near = found.withColumn("rank", F.row_number().over(by_class)).where(F.col("rank") <= most).select("ci", F.col("cj").alias("cls"), "similarity")
    rows = near.join(members.select("cls", F.col("doc").alias("dj"), F.col("seq").alias("sj"), F.col("id").alias("j")), "cls")
    by_row = Window.partitionBy("ci").orderBy(F.desc("similarity"), "dj", "sj")
    ranked = rows.withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= most)
    lists = ranked.groupBy(F.col("ci").alias("cls")).agg(F.array_sort(F.collect_list(F.struct("rank", "dj", "sj", "j", "similarity"))).alias("near"))
    both = named.select("cls", F.col("id").alias("i"), F.col("doc").alias("di"), F.col("seq").alias("si")).join(lists, "cls")

    def other(c: Column) -> Column:
        apart = c["j"] != F.col("i")
        return apart & ~((c["dj"] == F.col("di")) & (F.abs(c["sj"] - F.col("si")) == 1)) if skip_neighbours else apart

    kept = both.select("i", "di", "si", F.explode(F.slice(F.filter("near", other), 1, top_k)).alias("n")).select("i", "di", "si", "n.*")
    return kept.where("di < dj OR (di = dj AND si < sj)").select("i", "j", "similarity")


def notation_distance(a: Column, b: Column) -> Column:
    """Mean of five: label distance, and whether primary function, certainty, emotion and stance differ."""
    same = [F.when(a[f] == b[f], 0.0).otherwise(1.0) for f in ("primary_function", "certainty", "emotion_expressed", "stance")]
    return (label_distance(a["functions"], b["functions"]) + sum(same[1:], same[0])) / 5


def label_distance(a: Column, b: Column) -> Column:
    return 1 - jaccard(a, b)


def differing_fields(a: Column, b: Column) -> Column:
    tests = [F.when(~same_set(a["functions"], b["functions"]), F.lit("functions"))]
    tests += [F.when(a[f] != b[f], F.lit(f)) for f in ("primary_function", "certainty", "emotion_expressed", "stance")]
    tests.append(F.when(~same_set(a["emotions_mentioned"], b["emotions_mentioned"]), F.lit("emotions_mentioned")))
    return F.filter(F.array(*tests), lambda f: f.isNotNull())


def conflicts(pairs: DataFrame, units: DataFrame, run_id: str = "run_unknown") -> DataFrame:
    """Conflicts of similar pairs(i, j, similarity) of units that carry different notations.

    units: unit_id, document_id, sequence_index, text and the notation fields.
    """
    own = with_neighbours(units, 1, 0, lambda order: {"_near": asked(F.col("text")) | F.coalesce(asked(F.lag("text").over(order)), F.lit(False))})
    own = own.withColumn("_address", matches_any(folded(F.col("text"), normalise=False), (L.VIEWER_ADDRESS,)))
    fields = ["unit_id", "functions", "primary_function", "certainty", "emotion_expressed", "stance", "emotions_mentioned", "confidence", "_near", "_address"]
    own = own.select(F.struct(*fields).alias("u"))
    both = pairs.join(own.select(F.col("u.unit_id").alias("i"), F.col("u").alias("a")), "i").join(own.select(F.col("u.unit_id").alias("j"), F.col("u").alias("b")), "j")
    a, b = F.col("a"), F.col("b")
    both = both.withColumns({"differing_fields": differing_fields(a, b), "notation_distance": notation_distance(a, b)}).where((F.size("differing_fields") > 0) & (F.col("notation_distance") > 0))
    odd = F.array_union(F.array_except(a["functions"], b["functions"]), F.array_except(b["functions"], a["functions"]))
    viewer = (F.array_join(odd, "") == "V") & (a["_address"] | b["_address"])
    every = F.array_union(a["functions"], b["functions"])
    context = has_any(a["functions"], "R", "Y") & has_any(b["functions"], "R", "Y") & F.array_contains(every, "R") & F.array_contains(every, "Y") & (a["_near"] != b["_near"])
    group = strings("A", "K", "O")
    ga, gb = F.array_intersect(a["functions"], group), F.array_intersect(b["functions"], group)
    claims = (F.size(ga) > 0) & (F.size(gb) > 0) & ~same_set(ga, gb)
    kind = F.when(viewer, "allowed_by_taxonomy").when(context, "context_explains_difference").when(claims, "likely_inconsistency").otherwise("needs_human_review")
    emotion = F.arrays_overlap("differing_fields", strings("emotion_expressed", "emotions_mentioned"))
    says = F.lit(L.EXPLANATIONS["other"])
    for name, test in (("emotion", emotion), ("claims", claims), ("context", context), ("viewer", viewer)):
        says = F.when(test, L.EXPLANATIONS[name]).otherwise(says)
    score = F.col("similarity") * F.col("notation_distance") * (a["confidence"] + b["confidence"]) / 2
    return both.select(
        hash_id("sim_", run_id, F.least("i", "j"), F.greatest("i", "j")).alias("conflict_id"),
        F.lit(run_id).alias("run_id"),
        F.col("i").alias("unit_id_a"),
        F.col("j").alias("unit_id_b"),
        F.round("similarity", 6).alias("similarity"),
        F.round("notation_distance", 6).alias("notation_distance"),
        F.round(score, 6).alias("conflict_score"),
        kind.alias("conflict_explanation_type"),
        says.alias("explanation"),
        "differing_fields",
        (~(viewer | context)).alias("needs_review"),
    )


def conflict_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("conflict_explanation_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("needs_review").alias("needs_review"))


def audit_summary(found: DataFrame) -> DataFrame:
    """total_conflicts and conflicts_by_type, one row; no type is listed where there is no conflict."""
    by_type = conflict_summary(found).select("conflict_explanation_type", "n")
    entries = F.array_sort(F.collect_list(F.struct("conflict_explanation_type", "n")))
    return by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_conflicts"), F.map_from_entries(entries).alias("conflicts_by_type"))

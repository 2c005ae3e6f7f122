import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fableloom.llm import exact_dedup as X


def plain_copies(rows):
    """doc_id, keep_id, group_size, kept and text_sha256 of rows (doc_id, text), sorted."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        top = max(known, default=None)
        stays = ids.index(top)
        out += [(i, top, len(ids), k == stays, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_nulls_empties_ties_and_repeats(spark, docs, clashing):
    df = docs("one", "two", "one", "Two", "two ", "one", None, "", "ä", "ä", "x" * 300_000, "x" * 299_999 + "y")
    want = plain_copies([(r["doc_id"], r["text"]) for r in df.collect()])
    assert rows_of(X.find_copies(df)) == want
    assert rows_of(X.find_copies(clashing(df))) == want
    assert rows_of(X.find_copies(df.limit(0))) == []


@pytest.mark.parametrize("partitions", [1, 5])
def test_split_buckets_pages_and_collisions(spark, partitions):
    """Small buckets are split; hashes of four values chain different texts; a text of a third of all rows, many without id, overflows into pages."""
    rng = random.Random(7)
    rows = [(i, f"text {rng.randrange(300)} " + "w" * rng.randrange(50)) for i in range(900)]
    rows += [(1000 + i, "hot") for i in range(400)] + [(None, "hot")] * 50 + [(None, "no id at all")] * 120 + [(7, "hot")] * 3 + [(1399, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    want = plain_copies(rows)
    weak = lambda t: F.shiftleft(F.pmod(F.xxhash64(t), F.lit(4)), 62)
    for hashed, least in ((F.xxhash64, 8), (weak, 4)):
        index = X.build_index(df, capacity=4000, hashed=hashed)
        assert len(index.directory.buckets) >= least and max(index.directory.pages()) > 1
        assert rows_of(index.classes()) == want
        chains = index.files.groupBy("owner", "h").agg(F.max("chain").alias("n")).agg(F.max("n")).first()[0]
        assert hashed is F.xxhash64 or chains > 1
        index.delete()


def test_directory_doubles_for_full_buckets_only(spark):
    hashes = [0, 1, 2, 3, 1 << 62, -(1 << 63), -1]
    sizes = spark.createDataFrame([(h, 10) for h in hashes] + [(5 << 40, 1000)] * 3, "h long, size long")
    d = X.grow_directory(sizes, capacity=100)
    large = [b for b in d.buckets if b.size > 100]
    assert len(large) == 1 and large[0].depth == X.MAX_DEPTH or large[0].least == large[0].most
    assert len(d.entries()) == 1 << d.depth
    assert sum(b.size for b in d.buckets) == 3070
    assert sum(1.0 / (1 << b.depth) for b in d.buckets) == 1.0
    found = {r["h"]: r["b"] for r in sizes.select("h", d.bucket_of(F.col("h")).alias("b")).collect()}
    for h, b in found.items():
        own = d.buckets[b]
        assert (h % (1 << 64)) >> (64 - own.depth) == own.prefix if own.depth else True


def test_drop_copies_keeps_all_columns(spark, clashing):
    df = clashing(spark.createDataFrame([(1, "a", "p"), (2, "a", "q"), (3, "b", None), (None, "c", "r"), (None, "c", "r")], "doc_id long, text string, h string"))
    kept = X.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"], r["h"]) for r in kept.collect()), key=repr) == sorted([(2, "a", "q"), (3, "b", None), (None, "c", "r")], key=repr)

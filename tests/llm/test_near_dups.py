import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fableloom.llm import near_dups
from fableloom.llm.near_dups import drop_near_duplicates, edit_distance, find_near_duplicates, keys_of, run_counts, similar, word_bags, words_of


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_against_the_full_table():
    r = random.Random(5)
    for _ in range(2000):
        a = r.choices("abcd", k=r.randint(0, 22))
        b = list(a) if r.random() < 0.6 else r.choices("abcd", k=r.randint(0, 22))
        for _ in range(r.randint(0, 5)):
            i = r.randint(0, len(b))
            b[i : i + r.randint(0, 2)] = r.choices("abcde", k=r.randint(0, 2))
        limit, wanted = r.randint(0, 12), plain_distance(a, b)
        assert edit_distance(a, b, limit) == min(wanted, limit + 1)


def corpus(r):
    words = ["".join(r.choices("abcdefghij", k=5)) for _ in range(3000)]
    base = [r.choices(words, k=r.randint(40, 120)) for _ in range(30)]
    shared = r.choices(words, k=60)
    texts = [" ".join(b) for b in base]
    for b in base[:12]:
        for _ in range(r.randint(1, 4)):
            c = list(b)
            for _ in range(r.randint(0, len(c) // 25)):
                c[r.randrange(len(c))] = r.choice(words)
            texts.append(" ".join(c))
    texts += [" ".join(r.choices(words, k=90) + shared) for _ in range(8)]  # a passage is no copy
    return texts


def test_classes_against_all_pairs(spark, docs, clashing):
    frame = docs(*corpus(random.Random(7)))
    rows = frame.collect()
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(rows):
        for j in range(i):
            a, b = x.text or "", rows[j].text or ""
            if a == b or (a.strip() and b.strip() and similar(a, b)):
                parent[root(i)] = root(j)
    ids = {}
    for i, x in enumerate(rows):
        ids.setdefault(root(i), []).append(x.doc_id)
    wanted = sorted((str(i), str(min((k for k in own if k is not None), default=None)), len(own)) for own in ids.values() for i in own)
    found = find_near_duplicates(clashing(frame)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in found) == wanted
    assert sum(r.kept for r in found) == len(ids)
    left = drop_near_duplicates(frame)
    assert left.columns == frame.columns and left.count() == len(ids)


def test_large_group_and_empty(spark, docs):
    r = random.Random(1)
    base = ["w%d" % r.randrange(999) for _ in range(80)]
    many = []
    for i in range(300):
        c = list(base)
        c[i % 80] = f"x{i}"
        many.append(" ".join(c))
    found = find_near_duplicates(docs(*many, extra=False))
    assert {(x.class_id, x.class_size, x.class_texts) for x in found.collect()} == {(0, 300, 300)}
    assert find_near_duplicates(docs().limit(0)).count() == 0
    assert drop_near_duplicates(docs().where(F.lit(False))).count() == 0


def edited(r, base, share, fresh):
    """base with about that share of its words replaced, taken away or added."""
    out = list(base)
    for _ in range(int(share * len(base))):
        at, kind = r.randrange(len(out)), r.random()
        out[at : at + (kind < 0.8)] = [] if 0.7 < kind < 0.8 else [f"x{next(fresh)}"]
    return out


def by_pairs(texts):
    """Class numbers of texts by comparing all pairs that share a key."""
    keys = [set(k.tolist()) for k in keys_of(texts)[1]]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if top(i) != top(j) and keys[i] & keys[j] and similar(texts[i], texts[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


@pytest.mark.parametrize(("group", "partitions"), [(64, "2"), (2, "7"), (64, "64")])
def test_stars_and_a_passage_of_all_under_any_partitions(spark, docs, monkeypatch, group, partitions):
    """Variants like their source but not like each other, and unlike texts behind one passage; keys of any size, cut anywhere."""
    r, fresh = random.Random(3), iter(range(10**6))
    words = ["w%d" % i for i in range(3000)]
    passage, texts = r.choices(words, k=50), []
    for n in (60, 20, 3, 1, 1, 1):
        base = r.choices(words, k=60) + passage
        texts.append(" ".join(base))
        for _ in range(n):
            c = list(base)
            for at in r.sample(range(60), 13):
                c[at] = f"x{next(fresh)}"
            texts.append(" ".join(c))
    for _ in range(90):
        texts.append(" ".join(r.choices(words, k=60) + passage))
    r.shuffle(texts)
    texts += ["one", "One!", "one ?", "two words", "Two - words"]
    wanted = by_pairs(texts)
    assert len(set(wanted)) < len(texts) - 60
    monkeypatch.setattr(near_dups, "GROUP", group)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {x.doc_id: x.class_id for x in find_near_duplicates(docs(*texts, extra=False)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [found[i] for i in range(len(texts))] == wanted
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("near_dups")]


@pytest.mark.parametrize(("share", "least"), [(0.05, 0.99), (0.1, 0.99), (0.15, 0.97), (0.18, 0.9), (0.2, 0.88)])
def test_share_of_similar_pairs_with_a_common_key(share, least):
    r, fresh = random.Random(6), iter(range(10**7))
    hits, pairs = 0, 0
    for n in (60, 150, 400):
        for _ in range(100):
            base = r.choices([f"w{i}" for i in range(5000)], k=n)
            a, b = " ".join(base), " ".join(edited(r, base, share, fresh))
            if similar(a, b):
                x, y = keys_of([a, b])[1]
                hits, pairs = hits + bool(set(x.tolist()) & set(y.tolist())), pairs + 1
    assert pairs > 150 and hits / pairs >= least


@pytest.mark.parametrize("n", [5, 10, 15, 20, 30, 45, 60])
@pytest.mark.parametrize("share", [0.1, 0.2])
def test_short_texts_share_a_key_too(n, share):
    r, fresh = random.Random(8), iter(range(10**7))
    hits, pairs = 0, 0
    while pairs < 150:
        base = r.choices([f"w{i}" for i in range(5000)], k=n)
        a, b = " ".join(base), " ".join(edited(r, base, max(share, 1.0001 / n), fresh))
        if similar(a, b):
            x, y = keys_of([a, b])[1]
            hits, pairs = hits + bool(set(x.tolist()) & set(y.tolist())), pairs + 1
    print(n, share, hits / pairs)
    assert hits / pairs >= 0.9


def test_a_failed_job_leaves_nothing(spark, docs, monkeypatch):
    def fail(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(near_dups, "components", fail)
    made = []
    own = near_dups.Scratch
    monkeypatch.setattr(near_dups, "Scratch", lambda *a: made.append(own(*a)) or made[-1])
    with pytest.raises(RuntimeError, match="stopped"):
        find_near_duplicates(docs("some words of a text", "some words of a text here"))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("near_dups")] and len(made) == 1
    path = spark._jvm.org.apache.hadoop.fs.Path(made[0].root)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_keys_against_plain_order_minhash():
    texts = ["a b c d e f g h a b c d e f g h a b c d e", "", None, "one two", "x " * 30, "p q r s t"]
    sizes, keys = keys_of(texts)
    assert sizes.tolist() == [21, 0, 0, 2, 30, 5]
    for i, t in enumerate(texts):  # the keys of a text do not depend on its batch
        assert (keys_of([t])[1][0] == keys[i]).all()
    assert not len(keys[1]) and not len(keys[2]) and keys[0].all() and len(set(keys[0].tolist())) > 8
    assert {len(k) for i, k in enumerate(keys) if sizes[i]} == {2 * near_dups.BANDS}
    assert [len(k) for k in keys_of(["w " * 75, "w " * 76])[1]] == [2 * near_dups.BANDS, near_dups.BANDS]
    words, own = near_dups.hashed([texts[0]])
    grams, counts = near_dups.labelled_grams(words, own)
    assert counts.tolist() == [17] and len(set(grams.tolist())) == 17  # repeated runs are told apart


def test_no_similar_pair_is_ruled_out():
    """Word counts and rarest runs are necessary for similarity."""
    r, fresh = random.Random(9), iter(range(10**6))
    for _ in range(300):
        base = r.choices("abcdefghijklmnopqrstuvwxyz", k=r.choice((r.randint(1, 60), r.randint(170, 240))))
        a, b = " ".join(base), " ".join(edited(r, base, r.choice((0.05, 0.1, 0.2)), fresh))
        if not similar(a, b):
            continue
        limit = near_dups.edits(max(len(words_of(a)), len(words_of(b))), 0.8)
        x, y = near_dups._bags(word_bags([a, b])[1])
        assert near_dups._may_be_similar(x[None], y[None], np.array([limit]))[0]
        plain, labelled, counts, sizes = run_counts([a, b])
        first = []
        for at, m, n in ((0, counts[0], sizes[0]), (counts[0], counts[1], sizes[1])):
            order = np.lexsort((labelled[at : at + m], plain[at : at + m] % 7))  # any order that is the same for both
            first.append(set(labelled[at : at + m][order[: int(0.6 * n + 1e-9) + 1]].tolist()))
        assert first[0] & first[1]


def test_user_columns_keep_their_names_and_values(spark, docs):
    names = ("row", "h1", "h2", "n", "keys", "doc", "_row", "_h1", "_sketch", "tid", "c", "first")
    own = docs("same text of words", "same text of words", "other").withColumns({n: F.col("doc_id") * 10 for n in names})
    found = drop_near_duplicates(own)
    assert found.columns == own.columns
    assert all(r[n] == (None if r.doc_id is None else r.doc_id * 10) for r in found.collect() for n in names)


def test_components_of_any_shape(spark):
    from fableloom.llm.common import Scratch

    r = random.Random(4)
    path = r.sample(range(1000, 1300), 300)
    links = list(zip(path, path[1:])) + [(7, i) for i in range(20, 60)] + [(i, 60) for i in range(20, 30)] + [(2000, 2001), (2001, 2000), (2001, 2002), (5, 5)]
    scratch = Scratch(spark, "test")
    found = near_dups.components(spark.createDataFrame(links, "a long, b long"), scratch).collect()
    classes = {}
    for x in found:
        classes.setdefault(x.c, set()).add(x.v)
    assert sorted(map(sorted, classes.values())) == sorted([sorted(path), sorted({7, 60, *range(20, 60)}), [2000, 2001, 2002]])
    assert len(scratch.made) < 40 and near_dups.components(spark.createDataFrame([], "a long, b long"), scratch).isEmpty()
    scratch.clear()


def test_components_of_a_path_that_only_grows(spark):
    """Copies of copies, by number; a round must not take away a few ends of it only."""
    from fableloom.llm.common import Scratch

    scratch = Scratch(spark, "test")
    path = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = near_dups.components(path, scratch).collect()
    assert sorted(x.v for x in found) == list(range(501)) and len({x.c for x in found}) == 1
    assert len(scratch.made) < 40
    scratch.clear()


def test_long_texts():
    r = random.Random(2)
    base = r.choices([f"w{i}" for i in range(9999)], k=60_000)
    near = list(base)
    for at in range(0, len(near), 50):
        near[at] = "changed"
    a, b = " ".join(base), " ".join(near)
    assert similar(a, b) and not similar(a, b, 0.99) and not similar(a, " ".join(r.sample(base, len(base))))
    x, y = keys_of([a, b])[1]
    assert set(x.tolist()) & set(y.tolist())


def behind_a_passage(r, unlike=90):
    """Stars of variants and unlike texts, all behind one passage that is under half of each."""
    fresh, words = iter(range(10**6)), ["w%d" % i for i in range(3000)]
    passage, texts = r.choices(words, k=50), []
    for n in (40, 10, 2, 1):
        base = r.choices(words, k=60) + passage
        texts.append(" ".join(base))
        for _ in range(n):
            c = list(base)
            for at in r.sample(range(60), 13):
                c[at] = f"x{next(fresh)}"
            texts.append(" ".join(c))
    texts += [" ".join(r.choices(words, k=60) + passage) for _ in range(unlike)]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize(("group", "block", "whole", "finer"), [(8, 16, 1 << 14, 0), (8, 16, 32, 1)])
def test_large_keys_in_blocks_and_the_largest_cut_finer(spark, docs, monkeypatch, group, block, whole, finer):
    texts, cut, rare = behind_a_passage(random.Random(12)), [], near_dups.rare_runs
    for name, value in (("GROUP", group), ("BLOCK", block), ("WHOLE", whole)):
        monkeypatch.setattr(near_dups, name, value)
    monkeypatch.setattr(near_dups, "rare_runs", lambda *a: cut.append(1) or rare(*a))
    found = {x.doc_id: x.class_id for x in find_near_duplicates(docs(*texts, extra=False)).collect()}
    assert [found[i] for i in range(len(texts))] == by_pairs(texts) and len(cut) == finer


def test_groups_of_the_same_texts_are_one(spark):
    from fableloom.llm.common import Scratch

    scratch = Scratch(spark, "test")
    rows = [(key, 9, tid) for key, tids in ((1, (1, 2, 3)), (2, (1, 2, 3)), (3, (1, 2)), (4, (2, 3)), (5, (4,)), (6, (2, 3))) for tid in tids]
    classes = spark.createDataFrame([(2, 2), (3, 2)], "v long, c long")
    found = near_dups.mixed_groups(spark.createDataFrame(rows, "key long, n int, tid long"), "key", classes, scratch).collect()
    assert sorted((r.key, r.tid, r.c, r.size) for r in found) == [(1, 1, 1, 3), (1, 2, 2, 3), (1, 3, 2, 3), (3, 1, 1, 2), (3, 2, 2, 2)]
    scratch.clear()


@pytest.mark.parametrize("most", [128, 1])
def test_two_texts_of_several_large_groups_are_compared_once(spark, monkeypatch, most):
    """Where rows name but one group, pairs may come twice; none is left out."""
    from fableloom.llm.common import Scratch

    monkeypatch.setattr(near_dups, "BLOCK", 3)
    monkeypatch.setattr(near_dups, "OTHERS", most)
    members = {-5: range(0, 8), 2: range(2, 12), 7: [0, 1, 4, 5, 6, 7, 11], 9: [12, 13]}
    wanted = {(a, b) for own in members.values() for a in own for b in own if a < b}
    seen, scratch = [], Scratch(spark, "test")
    for key, own in members.items():
        others = [np.array(sorted(k for k, m in members.items() if t in m)[:most]) for t in own]
        g = near_dups.pd.DataFrame({"key": key, "i": 0, "j": 0, "own": 0, "n": 3, "tid": list(own), "c": list(own), "bag": [word_bags(["same three words"])[1][0]] * len(own), "others": others})
        seen += near_dups.compared(g, 0.8).itertuples(index=False, name=None)
    assert set(seen) == wanted and (most == 1 or len(seen) == len(wanted))
    rows = spark.createDataFrame([(t, ("same three words",)) for t in range(14)], "row long, doc struct<text string>")
    groups = spark.createDataFrame([(key, 3, t, t, len(own)) for key, own in members.items() for t in own], "key long, n int, tid long, c long, size long")
    found = near_dups.block_pairs(groups, "key", rows, "text", 0.8, scratch).collect()
    assert len(found) == len(wanted) and {(r.a, r.b) for r in found} == wanted
    scratch.clear()

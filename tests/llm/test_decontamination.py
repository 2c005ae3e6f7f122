import hashlib
import random
import re

import pytest

from fableloom.llm.decontamination import find_contamination, winnow, words_of


def brute(text, items):
    w = words_of(text)
    hit, found = set(), set()
    for item, t in items:
        own = words_of(t)
        if item is None or not own:
            continue
        k = min(10, len(own))
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_winnowing_keeps_one_of_every_window():
    import numpy as np

    h = np.random.default_rng(0).integers(0, 9, 200).astype(np.uint64)
    at = set(winnow(h, 6).tolist())
    assert all(at & set(range(i, i + 6)) for i in range(195))
    assert len(winnow(h[:3], 6)) == 0


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_against_brute_force(spark, docs, clashing, block_words):
    r = random.Random(9)
    words = ["".join(r.choices("abcdé", k=2)) for _ in range(12)]
    items = [(i, " ".join(r.choices(words, k=r.choice((1, 2, 4, 7, 9, 10, 11, 15, 30))))) for i in range(14)]
    items += [(None, "lost words here"), (50, None), (51, "--"), (7, "a second text of seven")]
    texts = []
    for _ in range(60):
        own = r.choices(words, k=r.randint(0, 60))
        if r.random() < 0.6:
            piece = words_of(r.choice(items[:14])[1])
            s = r.randrange(len(piece))
            own[len(own) // 2 : len(own) // 2] = piece[s : s + r.randint(1, 30)]
        texts.append(re.sub(" ", lambda m: r.choice((" ", ", ", "\n")), " ".join(own)).upper() if r.random() < 0.3 else " ".join(own))
    texts.append("x " * 3000 + items[13][1])
    frame = docs(*texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(clashing(frame), clashing(bench), block_words=block_words).collect()
    assert sorted((str(x.doc_id), x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in found) == sorted((str(x.doc_id), *brute(x.text, items)) for x in frame.collect())
    assert any(x.contaminated for x in found) and not all(x.contaminated for x in found)


def test_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in find_contamination(docs("a b"), none).collect())
    assert find_contamination(docs().limit(0), none).count() == 0


def test_items_without_id(spark, docs):
    passage, other = " ".join(f"p{i}" for i in range(12)), " ".join(f"q{i}" for i in range(12))
    own = spark.createDataFrame([(None, passage), (7, other)], "item_id long, text string")
    for size in (2_000_000, 5):
        found = find_contamination(docs(f"a {passage} b", f"{other} {passage}", other, extra=False), own, size).collect()
        hashed = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert sorted((r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in found) == [(0, 12, 1, hashed("")), (1, 24, 2, hashed("7")), (2, 12, 1, hashed("7"))]

import random

import numpy as np
import pytest

from fableloom.llm.quality_rules import COUNTS, RULES, fit_votes, judge_quality, text_counts, unpack


def slow_counts(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_counts_against_brute_force():
    r = random.Random(2)
    samples = ["", None, "\x0b \x1c x y", "a b c a b c", "l\n l\nl\r\nl\n\nl"] + ["".join(r.choices("ab ñ#*\n\t|<&", k=r.randint(0, 200))) for _ in range(60)]
    for s in samples:
        assert text_counts(s)[:5] == slow_counts(s), s


def test_em_finds_planted_accuracies():
    r = np.random.default_rng(0)
    good = r.random(20000) < 0.85
    votes = np.full((20000, 4), -1)
    right = [0.95, 0.9, 0.8, 0.7]
    for k, p in enumerate(right):
        on = r.random(20000) < 0.7
        votes[on, k] = np.where(r.random(20000) < p, good, ~good)[on]
    codes, counts = np.unique(((votes + 1) * 3 ** np.arange(4)).sum(1), return_counts=True)
    model = fit_votes(codes, counts, 4)
    assert np.abs(model.accuracies() - right).max() < 0.04 and abs(model.share - 0.85) < 0.03
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.93
    assert (unpack(np.arange(81), 4) + 1).max() == 2
    assert 0 < fit_votes(np.zeros(0, np.int64), np.zeros(0), len(RULES)).share < 1


def test_verdicts(docs, clashing):
    clean = " ".join(["the", "river", "of", "stones", "and", "a", "house", "in", "green", "fields"] * 8)
    words = [f"word{i} the house" for i in range(40)]
    prose = [" ".join(random.Random(i).sample(words, 40)) for i in range(30)]
    junk = [" ".join(f"{w.upper()}!!" for w in p.split()) for p in prose[:5]]
    found = {r.doc_id: r for r in judge_quality(clashing(docs(*prose, *junk, clean))).collect()}
    assert all(found[i].kept for i in range(30))
    assert not any(found[i].kept for i in range(30, 35))
    assert found[35].base_failed and found[35].n_repeat_words == 80
    assert not found[900].kept and found[900].n_words == 0 and found[900].base_failed
    assert set(COUNTS) < set(found[0].asDict())


@pytest.mark.parametrize("n", [0])
def test_empty(docs, n):
    assert judge_quality(docs().limit(n)).count() == 0

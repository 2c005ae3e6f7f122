import random
import tracemalloc
import zlib

import numpy as np
import pytest

from fableloom.llm import quality_crf, toxicity
from fableloom.llm.quality_crf import OWN_FEATURES, LineField, chain_marginals, count_text, document_quality, fit_field, fit_quality, line_features, long_chain, own_features, score_quality
from fableloom.llm.toxicity import fit_toxicity, score_toxicity

WORDS = "river stone house green field water light morning table window garden letter".split()


def make(spark, docs, n=400):
    r = random.Random(4)
    texts, labels = [], []
    for i in range(n):
        words = r.choices(WORDS, k=60)
        toxic, bad = i % 4 == 0, i % 5 == 0
        if toxic:
            words[r.randrange(60)] = r.choice(("vilefool", "vilescum", "vilefoolish"))
        lines = [" ".join(words[k : k + 10]) + "." for k in range(0, 60, 10)]
        if bad:
            lines = [x.upper().replace(" ", "!! ") if r.random() < 0.8 else x for x in lines]
        texts.append("\n".join(lines))
        labels.append((i, int(not bad), int(toxic)))
    labels += [(None, 1, 1), (1, None, None), (77777, 1, 0)]
    return docs(*texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("score", "column", "cut"), [(score_toxicity, "toxic", 0.5), (score_quality, "quality", 0.3)])
def test_held_out_accuracy(spark, docs, clashing, score, column, cut):
    frame, labels = make(spark, docs)
    wanted = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None}
    rows = score(clashing(frame), labels).collect()
    assert len(rows) == frame.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in wanted]
    assert sum(r.predicted == wanted[r.doc_id] for r in held) / len(held) > 0.95


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_without_labels_and_rows(spark, docs, score):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in score(docs("a text", "b"), empty).collect())
    one = spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int")
    assert score(docs("a text", "b"), one).count() == 8
    assert score(docs().limit(0), empty).count() == 0


@pytest.mark.parametrize("fit", [fit_toxicity, fit_quality])
def test_repeated_ids_enter_the_fit_once(spark, docs, fit):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:20]
    labels = spark.createDataFrame([(i, n % 2, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    own = docs(*[f"{WORDS[i % 12]} {'vilefool' if i in ids[1::2] else 'gentle'}" for i in range(40)], extra=False)
    more = own.where(f"doc_id = {ids[0]}").crossJoin(spark.range(50)).select(own.columns)
    one, many = fit(own, labels), fit(own.unionByName(more), labels)
    assert np.allclose(one.weights, many.weights)


def test_ngrams_cover_the_whole_text(monkeypatch):
    ids = lambda t: toxicity.ngram_ids(toxicity.characters(t))
    assert len(ids("abcdefgh")) == 6 + 5 + 4 + 3 and len(ids("ab")) == 0 and len(ids(None)) == 0
    assert (ids("ABC") == ids("abc")).all()
    text = "some words of a text, ÄÖ " * 9
    whole = [x.tolist() if hasattr(x, "tolist") else x for x in toxicity.ngram_counts(text)]
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert [x.tolist() if hasattr(x, "tolist") else x for x in toxicity.ngram_counts(text)] == whole


def test_ratios_and_regression_against_plain_ones():
    texts = ["good day to you", "a good green field", "you vile fool", "vile words, you fool"]
    y = np.array([0, 0, 1, 1])
    bags = [toxicity.ngram_counts(t) for t in texts]
    sums = np.zeros((2, 1 << toxicity.BITS))
    for (own, counts, total), k in zip(bags, y, strict=True):
        for i, c in zip(own, counts, strict=True):
            sums[k, i] += (1000 * c / total) ** 0.5
    size = 1 << toxicity.BITS
    ratios = toxicity.log_count_ratios(sums[0], sums[1], sums[0].sum(), sums[1].sum())
    i = int(bags[2][0][0])
    assert ratios[i] == pytest.approx(np.log((1 + sums[1, i]) / (sums[1].sum() + size) / ((1 + sums[0, i]) / (sums[0].sum() + size))), abs=1e-6)
    held = sums.astype(bool).sum(0) + 0
    assert (toxicity.chosen_ratios(np.array([2.0, -3.0, 0.1]), np.array([1, 4, 9])) == [0, -3.0, 0]).all()
    assert (toxicity.chosen_ratios(np.array([2.0, -3.0]), np.array([1, 2])) == [0, -3.0]).all()
    assert (toxicity.chosen_ratios(np.array([0.2, 0.0]), np.array([1, 2])) == [0.2, 0]).all() and held.any()
    scale = np.where(ratios != 0, ratios, 0)
    pairs = [(own.astype(np.int64), toxicity.weigh(counts, total)) for own, counts, total in bags]
    weights, bias = toxicity.logistic(pairs, y.astype(float), scale, rounds=400)
    # the fit is where the gradient of the penalised likelihood vanishes
    used = np.unique(np.concatenate([o for o, _ in pairs]))
    used = used[scale[used] != 0]
    x = np.zeros((4, len(used)))
    for r, (own, values) in enumerate(pairs):
        inside = np.isin(own, used)
        x[r, np.searchsorted(used, own[inside])] = values[inside] * scale[own[inside]]
    w = weights[used] / scale[used]
    p = 1 / (1 + np.exp(-(x @ w + bias)))
    assert np.abs(x.T @ ((p - y) * 0.25) + 3e-3 * w).max() < 0.02 and ((p > 0.5) == y).all()


def test_scarce_labels_do_not_flag_everything(spark, docs):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:4]
    labels = spark.createDataFrame([(k, 1, int(n == 0)) for n, k in enumerate(ids)], "doc_id long, quality int, toxic int")
    own = docs(*["vilefool vilescum" if i == ids[0] else f"{WORDS[i % 12]} and {WORDS[i % 7]} stand there" for i in range(40)])
    found = {r.doc_id: r for r in score_toxicity(own, labels).collect()}
    assert found[ids[0]].predicted == 1 and sum(r.predicted for r in found.values()) < 10


def test_marginals_against_all_labellings():
    r = np.random.default_rng(1)
    x, doc = r.normal(size=(5, 3)), np.array([0, 0, 0, 0, 1])
    field = LineField(r.normal(size=3), r.normal(size=(2, 2)))
    sums, total = np.zeros(4), 0.0
    for bits in range(16):
        y = [(bits >> i) & 1 for i in range(4)]
        w = np.exp(sum(y[i] * (x[i] @ field.weights) for i in range(4)) + sum(field.moves[y[i], y[i + 1]] for i in range(3)))
        sums, total = sums + w * np.array(y), total + w
    good = field.marginals(x, doc)
    assert np.allclose(good[:4], sums / total)
    assert np.isclose(good[4], 1 / (1 + np.exp(-x[4] @ field.weights)))


def test_pair_marginals_and_long_chains():
    r = np.random.default_rng(3)
    score, moves = r.normal(size=7) * 3, r.normal(size=(2, 2))
    good, pairs = chain_marginals(score, np.zeros(7, int), moves, np.ones(7))
    assert np.allclose(long_chain(score, moves), good)
    assert np.isclose(pairs.sum(), 6) and np.allclose(pairs.sum(1)[1], good[:-1].sum()) and np.allclose(pairs.sum(0)[1], good[1:].sum())
    assert np.allclose(long_chain(np.array([900.0, -900.0, 900.0]), moves), [1, 0, 1])


def test_good_lines_in_bad_documents_are_good():
    r = random.Random(5)
    prose = lambda: " ".join(r.choices(WORDS, k=9)) + "."
    junk = lambda: " ".join(w.upper() + "!!" for w in r.choices(WORDS, k=9))
    texts, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        kinds = [bad and 4 <= k < 11 for k in range(r.randint(12, 14))]
        texts.append("\n".join(junk() if k else prose() for k in kinds))
        labels.append(int(not bad))
    x, lengths, doc = line_features(texts)
    field = fit_field(x, doc, np.array(labels)[doc], lengths)
    mixed = "\n".join([prose() for _ in range(5)] + [junk() for _ in range(7)] + [prose() for _ in range(4)])
    own, _, d = own_features([mixed])
    good = chain_marginals(field.scores(own, d), d, field.moves)
    assert (good[:4] > 0.6).all() and (good[6:11] < 0.3).all() and (good[13:] > 0.6).all()
    assert document_quality([texts[1]], field)[0] > 0.8 > 0.6 > document_quality([texts[0]], field)[0]


def test_pieces_of_a_text_are_stitched(monkeypatch):
    r = random.Random(8)
    for _ in range(60):
        text = "".join(r.choice(["a", "B", "1", "é", "!", "|", " ", " ", "x x x ", "\n", "\t", "word "]) for _ in range(r.randint(0, 200)))
        monkeypatch.setattr(quality_crf, "PIECE", 1 << 20)
        whole, lengths, _ = own_features([text])
        monkeypatch.setattr(quality_crf, "PIECE", r.choice((1, 3, 10)))
        found = count_text(text.encode())
        assert np.array_equal(found.lengths, lengths)
        assert np.allclose(found.features(quality_crf.seen_before(np.zeros(len(found.words), int), found.hashes)), whole)


def test_scores_from_own_features_equal_those_of_all():
    texts = ["one two two\nTHREE!! | four\n\none two two", "", "x\ny"]
    field = LineField(np.random.default_rng(2).normal(size=3 * OWN_FEATURES + 1), np.zeros((2, 2)))
    x, _, _ = line_features(texts)
    own, _, doc = own_features(texts)
    assert np.allclose(field.scores(own, doc), x @ field.weights)


@pytest.mark.parametrize("line", ["some words of a line that is not very long, and one more comma.\n", "one endless line of words "])
def test_a_text_of_50_megabytes_fits_into_a_gigabyte(line):
    text = line * (50_000_000 // len(line))
    field = LineField(np.ones(3 * OWN_FEATURES + 1) / 9, np.array([[0.5, -0.5], [-0.5, 0.5]]))
    tracemalloc.start()
    assert 0 <= document_quality([text], field)[0] <= 1
    assert tracemalloc.get_traced_memory()[1] < 1e9
    tracemalloc.stop()


def test_features_of_a_text_do_not_depend_on_its_batch():
    texts = ["one two two\nTHREE!! | four\n\none two two", "", None, "x"]
    together, _, doc = line_features(texts)
    for i, t in enumerate(texts):
        assert np.allclose(together[doc == i], line_features([t])[0])
    assert len(document_quality(texts, LineField(np.ones(together.shape[1]), np.zeros((2, 2))))) == 4

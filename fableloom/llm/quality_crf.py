"""Quality from a linear-chain conditional random field over lines.

Every line of a text gets features of its own and of its neighbours. The field
labels the whole chain of lines good or bad; a document's quality is the mean
of its lines' probabilities of being good (forward-backward marginals), weighted
by line length. Only documents are labelled, so the labels of lines are hidden:
the field is trained by expectation-maximisation, where the expected labels of a
training document's lines are the field's own, moved just so far that the share
of the document's label among them is large enough. Bad lines in good documents,
and good ones in bad, thus stay possible, and the field learns where labels change.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import class_counts, held_out, labelled_sample, sampled_texts, schema_of
from .words import PRIME, slice_hashes

#: Training documents of each class at most; those of more lines than that are not chosen (whole texts are always scored).
PER_CLASS, TRAIN_LINES = 1500, 400
#: The least share of good lines expected in good training documents, and of bad ones in bad.
GOOD_SHARE, BAD_SHARE = 0.9, 0.7
#: Bytes of a text from which on it is measured piece by piece, and lines of a chain from which on it is summed line by line.
PIECE, LONG_CHAIN = 1 << 20, 5000

_KINDS = 9
#: Kind of each UTF-8 byte: 0 other letters, 1 small, 2 capital, 3 digit, 4 white space, 5 symbol, 6 bar, 7 exclamation, 8 other punctuation.
_KIND = np.zeros(256, np.int64)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[list(b" \t\v\f\r\n")] = 4
_KIND[list(b"#*$%&<>@^~_=+\\/{}[]")] = 5
_KIND[ord("|")] = 6
_KIND[ord("!")] = 7
_KIND[list(b".,;:?'\"()-")] = 8
OWN_FEATURES = 14


@dataclass
class Lines:
    """What is counted of some lines."""

    kinds: np.ndarray  # bytes of each kind
    lengths: np.ndarray
    words: np.ndarray
    repeats: np.ndarray  # words equal to one of the three before them
    hashes: np.ndarray
    last: np.ndarray  # last byte, 0 if empty
    ends: tuple[np.ndarray, np.ndarray]  # hashes of up to three words at the start of the first line and at the end of the last

    def features(self, seen: np.ndarray) -> np.ndarray:
        """seen: whether the text has had such a line before."""
        n, w, words = self.kinds, np.maximum(self.words, 1), self.words
        size, letters = np.maximum(self.lengths, 1), np.maximum(n[:, 1] + n[:, 2], 1)
        columns = [
            n[:, 2] / letters,
            n[:, 5] / size,
            n[:, 6] / w,
            n[:, 7] / w,
            n[:, 3] / size,
            n[:, 8] / w,
            self.repeats / w,
            seen & (words > 0),
            np.log1p(words) / 5,
            np.minimum((size - n[:, 4]) / w, 30) / 10,
            np.isin(self.last, list(b".!?:")),
            words == 0,
            n[:, 5] > 0.05 * size,
            n[:, 2] > 0.5 * letters,
        ]
        return np.stack(columns, 1).astype(float)


def count_lines(data: np.ndarray) -> Lines:
    """data: bytes of whole lines, each with its line end."""
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts
    line = np.repeat(np.arange(len(ends)), lengths + 1)
    kind = _KIND[data]
    kinds = np.bincount(line * _KINDS + kind, minlength=len(ends) * _KINDS).reshape(-1, _KINDS).astype(float)
    solid = kind != 4
    first = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]]))
    last = np.flatnonzero(solid & np.concatenate([~solid[1:], [True]])) + 1
    h = slice_hashes(data, first, last)
    again = np.zeros(len(first), bool)
    for back in (1, 2, 3):
        again[back:] |= (h[back:] == h[:-back]) & (line[first[back:]] == line[first[:-back]])
    words = np.bincount(line[first], minlength=len(ends)).astype(float)
    return Lines(
        kinds,
        lengths,
        words,
        np.bincount(line[first], again, minlength=len(ends)),
        slice_hashes(data, starts, ends),
        np.where(lengths > 0, data[np.maximum(ends - 1, 0)], 0),
        (h[: int(words[0])][:3], h[len(h) - int(words[-1]) :][-3:]) if len(words) else (h, h),
    )


def joined(parts: list[Lines], open_ends: list[bool]) -> Lines:
    """The lines of pieces of a text, where the last line of an open piece goes on in the next."""
    out: list[Lines] = []
    for part, goes_on in zip(parts, [False, *open_ends], strict=False):
        if goes_on and out:
            was, tail = out[-1], out[-1].ends[1]
            head = part.ends[0]
            for j, h in enumerate(head):  # repeats over the cut that the piece itself could not see
                near = set(tail[max(0, len(tail) - 3 + j) :].tolist())
                part.repeats[0] += int(h) in near and int(h) not in head[:j].tolist()
            part.hashes[0] = (int(was.hashes[-1]) + pow(int(PRIME), int(was.lengths[-1]), 1 << 64) * int(part.hashes[0])) % (1 << 64)
            if part.lengths[0] == 0:
                part.last[0] = was.last[-1]
            for name in ("kinds", "lengths", "words", "repeats"):
                getattr(part, name)[0] += getattr(was, name)[-1]
            part.kinds[0, 4] -= 1  # the line end that the cut added
            if len(part.words) == 1:
                part.ends = (part.ends[0], np.concatenate([tail, part.ends[1]])[-3:])
            for name in ("kinds", "lengths", "words", "repeats", "hashes", "last"):
                setattr(was, name, getattr(was, name)[:-1])
        out.append(part)
    return Lines(*[np.concatenate([getattr(p, name) for p in out]) for name in ("kinds", "lengths", "words", "repeats", "hashes", "last")], ends=out[-1].ends)


def count_text(raw: bytes) -> Lines:
    """The lines of one text, in pieces of bounded size that are cut at line ends or, within a long line, at white space."""
    parts, open_ends, at = [], [], 0
    while at <= len(raw):
        end = raw.find(b"\n", at + PIECE) if len(raw) - at > 2 * PIECE else -1
        goes_on = False
        if end < 0 and len(raw) - at > 2 * PIECE or end - at > 2 * PIECE:
            blank = raw.find(b" ", at + PIECE, at + 2 * PIECE)
            if blank >= 0:
                end, goes_on = blank, True
        if end < 0:
            end = len(raw)
        piece = raw[at : end + goes_on]  # the blank belongs to the line
        parts.append(count_lines(np.frombuffer(piece + b"\n", np.uint8)))
        open_ends.append(goes_on)
        at = end + 1
    return joined(parts, open_ends)


def seen_before(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether an earlier line of the same text has the same hash."""
    order = np.lexsort((np.arange(len(doc)), hashes, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    seen = np.zeros(len(doc), bool)
    seen[order[1:][same]] = True
    return seen


def own_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of all texts: their own features, bytes, and the text each belongs to. A text has at least one line; null counts as empty."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    if len(raw) == 1 and len(raw[0]) > 2 * PIECE:
        lines = count_text(raw[0])
        doc = np.zeros(len(lines.words), np.int64)
    else:
        lines = count_lines(np.frombuffer(b"".join(r + b"\n" for r in raw), np.uint8))
        doc = np.repeat(np.arange(len(raw)), [r.count(b"\n") + 1 for r in raw])
    return lines.features(seen_before(doc, lines.hashes)), lines.lengths, doc


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of all texts: features (its own, its two neighbours', a constant), bytes, and the text each belongs to."""
    own, lengths, doc = own_features(texts)
    before, after = np.zeros_like(own), np.zeros_like(own)
    inside = doc[1:] == doc[:-1]
    before[1:][inside] = own[:-1][inside]
    after[:-1][inside] = own[1:][inside]
    return np.concatenate([own, before, after, np.ones((len(own), 1))], 1), lengths, doc


@dataclass(frozen=True)
class LineField:
    """weights: of the features towards good; moves[a, b]: of a line labelled a (1 is good) before one labelled b."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, x: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Each line's probability of being good."""
        return chain_marginals(x @ self.weights, doc, self.moves)

    def scores(self, own: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Each line's score towards good from its own features alone: what neighbours add is summed as one number a line."""
        w = self.weights
        out, inside = own @ w[:OWN_FEATURES] + w[-1], doc[1:] == doc[:-1]
        out[1:] += np.where(inside, own[:-1] @ w[OWN_FEATURES : 2 * OWN_FEATURES], 0)
        out[:-1] += np.where(inside, own[1:] @ w[2 * OWN_FEATURES : 3 * OWN_FEATURES], 0)
        return out


def chain_marginals(good: np.ndarray, doc: np.ndarray, moves: np.ndarray, pair_weights: np.ndarray | None = None):
    """Each line's probability of being good, given its score towards good; with weights of lines, also the weighted sums of the probabilities of neighbouring labels."""
    size = np.bincount(doc)
    size = size[size > 0]
    if pair_weights is None and len(size) == 1 and size[0] > LONG_CHAIN:
        return long_chain(good, moves)
    score = np.stack([np.zeros(len(good)), good], 1)
    offset = np.concatenate([[0], np.cumsum(size)[:-1]])
    order = np.argsort(-size, kind="stable")
    size, offset = size[order], offset[order]
    # how many chains are longer than t
    longer = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    ahead, behind = np.zeros_like(score), np.zeros_like(score)
    for t, n in enumerate(longer):
        at = offset[:n] + t
        if t:
            prev = ahead[at - 1]
            ahead[at] = np.logaddexp(prev[:, :1] + moves[0], prev[:, 1:] + moves[1])
        ahead[at] += score[at]
    for t in range(len(longer) - 2, -1, -1):
        at = offset[: longer[t + 1]] + t
        after = behind[at + 1] + score[at + 1]
        behind[at] = np.logaddexp(after[:, :1] + moves[:, 0], after[:, 1:] + moves[:, 1])
    both = ahead + behind
    p = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    if pair_weights is None:
        return p
    whole = np.logaddexp(both[:, 0], both[:, 1])
    left = np.flatnonzero(doc[1:] == doc[:-1])
    joint = ahead[left][:, :, None] + moves + (score[left + 1] + behind[left + 1])[:, None, :] - whole[left][:, None, None]
    return p, (np.exp(joint) * pair_weights[left][:, None, None]).sum(0)


def long_chain(good: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """As chain_marginals for one chain, on log odds, which need one number a line and direction."""

    def run(scores: np.ndarray, m: np.ndarray) -> np.ndarray:
        (a, b), (c, d) = np.exp(m).tolist()
        out, odds = [], 0.0
        for i, s in enumerate(scores.tolist()):
            if i:  # from odds of the line before, kept from overflowing
                e = math.exp(min(max(odds, -300.0), 300.0))
                odds = s + math.log((b + e * d) / (a + e * c))
            else:
                odds = s
            out.append(odds)
        return np.array(out)

    both = run(good, moves) + run(good[::-1], moves.T)[::-1] - good
    return 1 / (1 + np.exp(-np.clip(both, -500, 500)))


def expected_labels(model: LineField, x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The bias of each line, equal within a document, by which the weighted share of the document's label among its lines reaches GOOD_SHARE or BAD_SHARE; 0 where the field alone reaches it."""
    score, sign = x @ model.weights, np.where(y == 1, 1.0, -1.0)
    total = np.bincount(doc, weight)
    least = np.bincount(doc, weight * np.where(y == 1, GOOD_SHARE, BAD_SHARE)) / total

    def enough(bias: np.ndarray) -> np.ndarray:
        good = chain_marginals(score + sign * bias[doc], doc, model.moves)
        return np.bincount(doc, weight * np.where(y == 1, good, 1 - good)) / total >= least

    low, high = np.zeros(len(total)), np.where(enough(np.zeros(len(total))), 0.0, 30.0)
    for _ in range(10):
        middle = (low + high) / 2
        done = enough(middle)
        low, high = np.where(done, low, middle), np.where(done, middle, high)
    return sign * high[doc]


def fit_field(x: np.ndarray, doc: np.ndarray, y: np.ndarray, lengths: np.ndarray, passes: int = 3, rounds: int = 40, ridge: float = 1e-3, rate: float = 0.05) -> LineField:
    """Training by expectation-maximisation, with Adam on all chains at once; documents of either label weigh the same in sum.

    x, doc: lines and their chains, numbered from 0; y: each line's document's
    label; lengths: its bytes. The first pass takes the document's label for each
    line and no moves; each further pass takes the labels expected under the field.
    """
    own = lengths + 1.0
    share = own / np.bincount(doc, own)[doc] * np.sqrt(np.bincount(doc))[doc]  # a document counts by the root of its lines, a line by its length
    weight = share * np.where(y == 1, 0.5 / max(1e-9, share[y == 1].sum()), 0.5 / max(1e-9, share[y == 0].sum()))
    theta = np.zeros(x.shape[1] + 4)
    target, pairs = y.astype(float), np.zeros((2, 2))
    for p in range(passes):
        model = LineField(theta[:-4], theta[-4:].reshape(2, 2))
        if p:
            bias = expected_labels(model, x, doc, y, own)
            target, pairs = chain_marginals(x @ model.weights + bias, doc, model.moves, weight)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, rounds * (1 if p else 3) + 1):
            model = LineField(theta[:-4], theta[-4:].reshape(2, 2))
            good, moves = chain_marginals(x @ model.weights, doc, model.moves, weight)
            g = np.concatenate([((good - target) * weight) @ x, (moves - pairs).ravel() if p else np.zeros(4)]) + ridge * theta
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return LineField(theta[:-4], theta[-4:].reshape(2, 2))


def document_quality(texts: list[str | None], model: LineField) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good."""
    own, lengths, doc = own_features(texts)
    weight = lengths + 1.0  # so that an empty text has its one empty line
    good = chain_marginals(model.scores(own, doc), doc, model.moves)
    return np.bincount(doc, good * weight, minlength=len(texts)) / np.bincount(doc, weight, minlength=len(texts))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, label: str = "quality") -> LineField:
    """Train on at most ``per_class`` labelled documents of each class, all lines of each; held-out ids are never used.

    Documents of more than TRAIN_LINES lines are left out of the sample. Where a
    class has no training document, every line scores the smoothed share of label 1.
    """

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for text, y in zip(b["text"], b["y"], strict=True):
                x, lengths, _ = line_features([text])
                yield pd.DataFrame({"x": [x.astype("<f4").tobytes()], "lengths": [lengths.astype("<i8").tobytes()], "y": [y]})

    rows = sampled_texts(docs, labelled_sample(labels, label, per_class))
    rows = rows.where(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) < TRAIN_LINES)
    found = rows.mapInPandas(vectors, schema_of(x="binary", lengths="binary", y="int")).toPandas()  # 2 * per_class rows of TRAIN_LINES lines at most
    width = 3 * OWN_FEATURES + 1
    bad, good = class_counts(labels, label)
    if found["y"].nunique() < 2:
        weights = np.zeros(width)
        weights[-1] = np.log((good + 1) / (bad + 1))
        return LineField(weights, np.zeros((2, 2)))
    found = found.sort_values(["x", "lengths", "y"])  # the same model whatever the order of tasks
    lengths = [np.frombuffer(b, "<i8") for b in found["lengths"]]
    n = np.array([len(b) for b in lengths])
    x = np.frombuffer(b"".join(found["x"]), "<f4").reshape(-1, width).astype(float)
    return fit_field(x, np.repeat(np.arange(len(n)), n), np.repeat(found["y"].to_numpy(), n), np.concatenate(lengths))


def text_ranges(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are measured together; a long one stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "") + 100
        if i > start and size + n > PIECE:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def quality_of(model: LineField):
    """A pandas function from texts to their quality."""

    def score(texts: pd.Series) -> pd.Series:
        own = list(texts)
        return pd.Series(np.concatenate([np.zeros(0), *[document_quality(own[a:b], model) for a, b in text_ranges(own)]]))

    return F.pandas_udf(score, "double").asNondeterministic()


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs(doc_id, text), trained on labels(doc_id, quality).

    Null texts score as empty ones, which have one empty line. Repeated rows and
    null ids stay and equal texts score the same; of a repeated id one text is
    trained on. Long texts are scored whole, in pieces of bounded memory. Other
    columns are ignored, and an empty table gives an empty one.
    """
    own = docs.select("doc_id", "text")
    scored = own.select("doc_id", quality_of(fit_quality(own, labels, per_class))(F.col("text")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

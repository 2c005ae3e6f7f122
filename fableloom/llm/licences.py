"""Licence scans: Dice coefficient over word bigrams against templates.

Texts are normalised to lower-case runs of ASCII letters and digits. A stretch of a
text begins and ends with bigrams of a template, wherever these stand, and has at
most twice the template's words; its coefficient counts different bigrams. Every
stretch is looked at: for each first bigram, running counts of the bigrams that are
new since then give the coefficient at all ends at once. Before that, sizes prune:
a template is left out where the text has too few of its different bigrams for any
stretch to reach the threshold, and a first bigram where too few follow it. Of
stretches that overlap, the one that shares most stands for its place, so that a
notice of one version is not taken for those of others too.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schema_of
from .licence_texts import TEMPLATES

THRESHOLD = 0.8
#: Words of the longest stretch, for each word of the template.
LONGEST = 2
#: Cells of the running counts that are held at a time.
CELLS = 1 << 20

_WORD = re.compile("[a-z0-9]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


#: Licence, coefficient, start and end (words), shared bigrams.
Found = tuple[str, float, int, int, int]


class TemplateIndex:
    """Templates by size, and an index from bigram to the templates that have it."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        own = [(name, words_of(t)) for name, texts in templates.items() for t in texts]
        self.names, self.lengths = [name for name, _ in own], [len(w) for _, w in own]
        self.vocabulary: dict[str, int] = {}
        for _, words in own:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.base = len(self.vocabulary) + 1
        self.grams = [np.unique(self.codes(np.array([self.vocabulary[w] for w in words], np.int64))) for _, words in own]
        self.sizes = np.array([len(g) for g in self.grams])
        # 2 * both / (a + b) reaches the threshold only if a and b share this many of a bigrams, as b has no fewer than both.
        self.least = np.maximum(1, np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9)).astype(np.int64)
        every, template = np.concatenate(self.grams), np.repeat(np.arange(len(own)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.known, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.template = template[order]

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """A number for each bigram of words in the vocabulary, -1 for others (0 is an unknown word)."""
        return np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * self.base + ids[1:], -1)

    def candidates(self, codes: np.ndarray) -> np.ndarray:
        """Templates of which the text has enough different bigrams. codes: of all its bigrams."""
        own = np.unique(codes)
        near = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        near = near[self.known[near] == own]
        counts = self.count[near]
        entry = np.arange(counts.sum()) + np.repeat(self.first[near] - np.cumsum(counts) + counts, counts)
        return np.flatnonzero(np.bincount(self.template[entry], minlength=len(self.names)) >= self.least)

    def stretches(self, template: int, codes: np.ndarray, before: np.ndarray) -> list[Found]:
        """The best stretch from each bigram of the template, if it reaches the threshold.

        before: where each bigram of the text stood last, -1 if nowhere.
        """
        hit = np.isin(codes, self.grams[template])
        width, n = LONGEST * self.lengths[template], len(codes)
        starts = np.flatnonzero(hit)
        # A hit is new in the longest stretches that start after its last place and reach it.
        change = np.bincount(np.maximum(before[starts], starts - width) + 1, minlength=n + 1) - np.bincount(starts + 1, minlength=n + 1)
        starts = starts[change.cumsum()[starts] >= self.least[template]]
        found = []
        step = max(1, CELLS // width)
        for own in (starts[i : i + step, None] for i in range(0, len(starts), step)):
            at = own + np.arange(width)
            inside, at = at < n, np.minimum(at, n - 1)
            new = inside & (before[at] < own)
            both = (new & hit[at]).cumsum(1)
            dice = 2.0 * both / (new.cumsum(1) + self.sizes[template])
            dice[~(new & hit[at])] = 0.0
            end = dice.argmax(1)
            top = dice[np.arange(len(own)), end]
            found += [(self.names[template], float(top[i]), int(own[i, 0]), int(own[i, 0] + end[i]) + 2, int(both[i, end[i]])) for i in np.flatnonzero(top >= self.threshold)]
        return found

    def match(self, text: str) -> list[Found]:
        """The best stretch of every place that reaches the threshold."""
        words = words_of(text)
        if len(words) < 2:
            return []
        codes = self.codes(np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words)))
        templates = self.candidates(codes)
        if not len(templates):
            return []
        own: dict[str, int] = {}
        ids = np.fromiter((own.setdefault(w, len(own)) for w in words), np.int64, len(words))
        every = ids[:-1] * len(own) + ids[1:]
        order = np.argsort(every, kind="stable")
        before = np.full(len(every), -1)
        again = every[order[1:]] == every[order[:-1]]
        before[order[1:][again]] = order[:-1][again]
        return best_of_places([f for t in templates.tolist() for f in self.stretches(t, codes, before)])


def best_of_places(found: list[Found]) -> list[Found]:
    """The best stretches that do not overlap, in the text's order. Most shared bigrams are best, then the highest coefficient, the first start, end and name."""
    kept: list[Found] = []
    starts: list[int] = []
    for f in sorted(found, key=lambda f: (-f[4], -f[1], f[2], f[3], f[0])):
        i = bisect.bisect_left(starts, f[3])  # the kept ones before i begin before this one ends
        if not i or kept[i - 1][3] <= f[2]:
            kept.insert(i, f)
            starts.insert(i, f[2])
    return kept


def scan_licences(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_places, licence, dice and licences for every row of docs(doc_id, text).

    n_places: places that reach the threshold for some licence, each of which counts
    for its best licence only. licences: those of all places, sorted and joined by
    commas (empty if none); licence and dice: the one with the highest coefficient,
    the first by name among equals, else null. Null and empty texts hold none; long
    texts are scanned whole, in memory that grows with their words; repeated rows
    and null ids stay; other columns are ignored; an empty table gives an empty one.
    """
    index = TemplateIndex(templates, threshold)

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = index.match(t or "")
            top = min(found, key=lambda f: (-f[1], f[0]), default=(None, None))
            rows.append((len(found), top[0], top[1], ",".join(sorted({f[0] for f in found}))))
        return pd.DataFrame(rows, columns=["n_places", "licence", "dice", "licences"])

    out = schema_of(n_places="long", licence="string", dice="double", licences="string")
    return docs.select("doc_id", F.pandas_udf(run, out).asNondeterministic()(F.col("text")).alias("f")).select("doc_id", "f.*")

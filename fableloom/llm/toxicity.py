"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the bag of its lower-cased character n-grams, hashed; an n-gram weighs
the square root of its share of the text, so length does not matter. Every
n-gram is scaled by the log of the ratio of its (smoothed) share among toxic and
among other training texts, and a logistic regression is fitted on the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import class_counts, held_out, labelled_sample, materialise, sampled_texts, schema_of

SIZES = (3, 4, 5, 6)
BITS = 20
#: Training documents of each class at most; also bounds what reaches the driver.
PER_CLASS = 2500
#: N-grams whose log-count ratio is nearer to 0, or that fewer training texts hold, are left out of the
#: regression; where that leaves none, fewer texts are enough.
MIN_RATIO, MIN_TEXTS = 1.2, 4
#: Characters of a text that are counted at a time.
PIECE = 1 << 20


def characters(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def ngram_ids(c: np.ndarray, start: int = 0, end: int | None = None, bits: int = BITS) -> np.ndarray:
    """The hashed n-grams of a text's characters that begin from start on and before end."""
    end = len(c) if end is None else end
    parts = [np.zeros(0, np.uint32)]
    for n in SIZES:
        own = c[start : min(len(c), end + n - 1)]
        if len(own) < n:
            break
        h = np.full(len(own) - n + 1, n, np.uint32)
        for j in range(n):
            h *= np.uint32(0x01000193)
            h ^= own[j : j + len(h)]
        h *= np.uint32(0x9E3779B1)
        parts.append(h >> np.uint32(32 - bits))
    return np.concatenate(parts)


def ngram_counts(text: str | None, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """The distinct n-grams of a whole text in order, of those that are used, how often each occurs, and the number of all."""
    c = characters(text)
    if len(c) <= PIECE:
        ids = ngram_ids(c)
        own, counts = np.unique(ids if used is None else ids[used[ids]], return_counts=True)
        return own, counts, len(ids)
    sums = np.zeros(1 << BITS, np.int64)
    for start in range(0, len(c), PIECE):
        sums += np.bincount(ngram_ids(c, start, min(len(c), start + PIECE)), minlength=1 << BITS)
    own = np.flatnonzero(sums if used is None else np.where(used, sums, 0))
    return own, sums[own], int(sums.sum())


def weigh(counts: np.ndarray, total: int) -> np.ndarray:
    """The root of each n-gram's share (per 1000) of the text's ``total``."""
    return np.sqrt(1000.0 * counts / max(1, total))


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # of each hashed n-gram, the log-count ratio included
    bias: float

    @cached_property
    def used(self) -> np.ndarray:
        return self.weights != 0

    def score(self, text: str | None) -> float:
        own, counts, total = ngram_counts(text, self.used)
        z = float((self.weights[own] * weigh(counts, total)).sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each n-gram in the task: its summed weight in either class and the texts that hold it."""
    sums, texts = np.zeros((2, 1 << BITS)), np.zeros(1 << BITS, np.int64)
    for b in batches:
        for text, y in zip(b["text"], b["y"], strict=True):
            own, counts, total = ngram_counts(text)
            sums[y, own] += weigh(counts, total)
            texts[own] += 1
    found = np.flatnonzero(texts)
    yield pd.DataFrame({"gram": found, "clean": sums[0, found], "toxic": sums[1, found], "texts": texts[found]})


def log_count_ratios(clean: np.ndarray, toxic: np.ndarray, all_clean: float, all_toxic: float) -> np.ndarray:
    """The log of the ratio of each n-gram's share among toxic texts to that among others, both smoothed by one."""
    logs = np.log((1 + toxic) / (all_toxic + (1 << BITS))) - np.log((1 + clean) / (all_clean + (1 << BITS)))
    return logs.round(6)  # sums of floats differ in their last digits with the order of tasks


def chosen_ratios(ratios: np.ndarray, texts: np.ndarray, min_ratio: float = MIN_RATIO, min_texts: int = MIN_TEXTS) -> np.ndarray:
    """The ratios, 0 where an n-gram is left out: of fewer than min_texts texts or nearer to 0 than min_ratio. Where that would leave out all, fewer texts and then any ratio are enough."""
    for least, near in [(k, min_ratio) for k in range(min_texts, 0, -1)] + [(1, 0.0)]:
        out = np.where((texts >= least) & (np.abs(ratios) >= near), ratios, 0.0)
        if out.any():
            return out
    return np.zeros(len(ratios))


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, label: str = "toxic") -> ToxicityModel:
    """Train on at most ``per_class`` labelled documents of each class, whole texts; held-out ids are never used.

    Where a class has no training document, or both hold the same n-grams only,
    the score is the smoothed share of label 1.
    """
    spark = docs.sparkSession
    clean, toxic = class_counts(labels, label)
    prior = float(np.log((toxic + 1) / (clean + 1)))
    rows = materialise(sampled_texts(docs, labelled_sample(labels, label, per_class)), "toxicity-sample")
    counts = rows.mapInPandas(_count_batches, schema_of(gram="long", clean="double", toxic="double", texts="long"))
    counts = materialise(counts.groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts")), "toxicity-counts")
    sums = counts.agg(F.coalesce(F.sum("clean"), F.lit(0.0)).alias("clean"), F.coalesce(F.sum("toxic"), F.lit(0.0)).alias("toxic")).first()
    if sums["clean"] == 0 or sums["toxic"] == 0:
        return ToxicityModel(np.zeros(1 << BITS, np.float32), prior)
    # Only n-grams of enough texts can be used, so only they come to the driver; the shares are of all.
    most = counts.agg(F.max("texts")).first()[0]
    own = counts.where(F.col("texts") >= min(most, MIN_TEXTS)).toPandas()  # 2 ** BITS rows at most
    if not chosen_ratios(log_count_ratios(own["clean"].to_numpy(), own["toxic"].to_numpy(), sums["clean"], sums["toxic"]), own["texts"].to_numpy(), MIN_RATIO, 1).any() and MIN_TEXTS > 1:
        own = counts.toPandas()
    ratio = np.zeros(1 << BITS)
    ratio[own["gram"]] = chosen_ratios(log_count_ratios(own["clean"].to_numpy(), own["toxic"].to_numpy(), sums["clean"], sums["toxic"]), own["texts"].to_numpy())
    used = ratio != 0
    if not used.any():  # the same n-grams in both classes
        return ToxicityModel(np.zeros(1 << BITS, np.float32), prior)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bags = [(own, weigh(counts, total)) for own, counts, total in (ngram_counts(t, used) for t in b["text"])]
            yield pd.DataFrame({"ids": [i.astype("<u4").tobytes() for i, _ in bags], "values": [v.astype("<f4").tobytes() for _, v in bags], "y": b["y"]})

    found = rows.mapInPandas(vectors, schema_of(ids="binary", values="binary", y="int")).toPandas()  # 2 * per_class rows
    found = found.sort_values(["ids", "values", "y"])  # the same model whatever the order of tasks
    bags = [(np.frombuffer(i, "<u4").astype(np.int64), np.frombuffer(v, "<f4")) for i, v in zip(found["ids"], found["values"], strict=True)]
    weights, bias = logistic(bags, found["y"].to_numpy(float), ratio)
    return ToxicityModel(weights.astype(np.float32), bias)


def logistic(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, scale: np.ndarray, rounds: int = 150, ridge: float = 3e-3, rate: float = 0.02) -> tuple[np.ndarray, float]:
    """Weights (scale included) and bias of a logistic regression on scaled bags of (ids, values), fitted by Adam on all of them at once; either class weighs the same in sum."""
    n = len(bags)
    row = np.repeat(np.arange(n), [len(i) for i, _ in bags])
    columns, at = np.unique(np.concatenate([i for i, _ in bags]), return_inverse=True)
    s = np.concatenate([v for _, v in bags]) * scale[columns][at]
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w = np.zeros(len(columns) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(row, s * w[:-1][at], minlength=n) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * share
        g = np.append(np.bincount(at, s * err[row], minlength=len(columns)) + ridge * w[:-1], err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = np.zeros(len(scale))
    weights[columns] = w[:-1] * scale[columns]
    return weights, float(w[-1])


def toxicity_of(spark: SparkSession, model: ToxicityModel):
    """A pandas function from whole texts to their toxicity, from 0 to 1. Null texts score as empty ones."""
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS floats: 4 MB

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return F.pandas_udf(score, "double").asNondeterministic()


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs(doc_id, text), trained on labels(doc_id, toxic).

    Null texts score as empty ones, by the bias alone. Repeated rows and null ids
    stay and equal texts score the same; of a repeated id one text is trained on,
    with its largest label. Long texts are counted whole, in pieces of bounded
    memory. Other columns are ignored, and an empty table gives an empty one.
    """
    own = docs.select("doc_id", "text")
    scored = own.select("doc_id", toxicity_of(docs.sparkSession, fit_toxicity(own, labels, per_class))(F.col("text")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

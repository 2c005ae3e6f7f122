"""Quality rules under weak supervision.

Each rule looks at counts of one text and votes good, bad or abstains.
Expectation-maximisation over the whole corpus's votes estimates the share of
good documents and how each rule votes on either kind, hence how often it is
right; a document is kept if its posterior probability of being good reaches a
threshold, so one failed rule need not reject it. The corpus
enters only as a count per vote pattern, of which there are at most 3 to the
number of rules.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, schema_of, unused

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_bars", "n_stop")
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    w.encode()
    for w in (
        "the of and to in a is that for it was on are as with be by this from or an at not "
        "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
        "de la le et les des en un du une que est pour qui dans par au sur pas avec "
        "el los las que y del se por con para su al lo como una es"
    ).split()
)
ASCII_SPACE = b" \t\n\v\f\r"

#: Kind of each UTF-8 byte: 0 other, 1 white space, 2 symbol, 3 capital, 4 small letter, 5 exclamation mark, 6 continuation byte, 7 bar.
_KIND = np.zeros(256, np.uint8)
_KIND[list(ASCII_SPACE)] = 1
_KIND[list(b"#*$%&<>")] = 2
_KIND[ord("A") : ord("Z") + 1] = 3
_KIND[ord("a") : ord("z") + 1] = 4
_KIND[ord("!")] = 5
_KIND[0x80:0xC0] = 6
_KIND[ord("|")] = 7


def numbered(words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int]]:
    """Words as numbers in the order in which they first occur."""
    ids: dict[bytes, int] = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int64), ids


def repeated_words(a: np.ndarray, ids: dict[bytes, int]) -> int:
    """Words that lie in a window of three that the text holds twice or more."""
    if len(a) < 4:
        return 0
    pair = a[:-1] * len(ids) + a[1:]
    if len(ids) > 2_000_000:  # else the product of three would not fit
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(ids) + a[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(a), bool)
    for k in range(3):
        hit[k : k + len(twice)] |= twice
    return int(hit.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The values of COUNTS for one text; a null text counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=8)
    words = data.split()
    a, ids = numbered(words)
    stop = [i for w, i in ids.items() if w in STOP_WORDS]
    seen: set[bytes] = set()
    lines = dup = 0
    for line in data.split(b"\n"):
        if line.strip(ASCII_SPACE):
            lines += 1
            dup += line in seen
            seen.add(line)
    chars = len(data) - int(kinds[1]) - int(kinds[6])
    return (len(words), chars, int(kinds[2] + kinds[7]), dup, repeated_words(a, ids), lines, int(kinds[3]), int(kinds[3] + kinds[4]), int(kinds[5]), int(kinds[7]), int(np.bincount(a, minlength=1)[stop].sum()))


def _counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t) for t in texts], columns=list(COUNTS), dtype="int64")


#: Not repeated by the optimiser in a filter, as it is marked nondeterministic.
counts_of = F.pandas_udf(_counts, schema_of(**dict.fromkeys(COUNTS, "long"))).asNondeterministic()


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good``, bad from ``bad`` on, else abstains, as where the value is null; ``value`` takes the counts by name."""

    name: str
    value: Callable[[Any], Any]
    bad: float
    good: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda c: c["n_symbols"] / c["n_words"], bad=0.15),
    Rule("capitals", lambda c: c["n_upper"] / (c["n_letters"] + 1), bad=0.3, good=0.1),
    Rule("exclamations", lambda c: c["n_marks"] / c["n_words"], bad=0.15),
    Rule("repeated_lines", lambda c: c["n_dup_lines"] / c["n_lines"], bad=0.3),
    Rule("repeated_words", lambda c: c["n_repeat_words"] / c["n_words"], bad=0.3),
    Rule("word_length", lambda c: (c["word_chars"] / c["n_words"] - 5.5) ** 2, bad=16.0, good=4.0),
    Rule("few_stop_words", lambda c: 0 - c["n_stop"] / c["n_words"], bad=-0.02, good=-0.1),
)


def votes_of(counts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The votes as one number to base 3: 0 abstains, 1 is bad, 2 is good. counts: a struct of COUNTS with at least one word."""
    code = F.lit(0)
    for i, r in enumerate(rules):
        v = r.value(counts)
        vote = F.when(v >= r.bad, 1) if r.good is None else F.when(v >= r.bad, 1).when(v <= r.good, 2)
        code = code + vote.otherwise(0) * 3**i
    return code.cast("int")


@dataclass
class VoteModel:
    """share: of good documents; says[r, y, v + 1]: how often rule r says v (-1 abstains) on documents of kind y."""

    share: float
    says: np.ndarray

    def accuracies(self) -> np.ndarray:
        """How often each rule is right where it votes."""
        right = (1 - self.share) * self.says[:, 0, 1] + self.share * self.says[:, 1, 2]
        return right / (right + (1 - self.share) * self.says[:, 0, 2] + self.share * self.says[:, 1, 1])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        logs = np.log(np.clip(self.says, 1e-9, 1))
        odds = np.log(self.share) - np.log(1 - self.share)
        for r in range(votes.shape[1]):
            odds = odds + (logs[r, 1] - logs[r, 0])[votes[:, r] + 1]
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def unpack(codes: np.ndarray, n: int) -> np.ndarray:
    """Votes of packed codes: -1 abstains, 0 is bad, 1 is good."""
    return (codes[:, None] // 3 ** np.arange(n)) % 3 - 1


def fit_votes(codes: np.ndarray, counts: np.ndarray, n_rules: int, rounds: int = 200, prior: float = 30.0) -> VoteModel:
    """EM over vote patterns and their counts.

    prior: imagined documents of each kind, on which every rule abstains in 50
    of 100 cases, is right in 48 and wrong in 2. They keep "good" from swapping
    meaning and carry the fit where there are no rows.
    """
    votes, counts = unpack(codes, n_rules), counts.astype(float)
    start = np.array([[0.5, 0.48, 0.02], [0.5, 0.02, 0.48]])
    model = VoteModel(0.8, np.tile(start, (n_rules, 1, 1)))
    for _ in range(rounds):
        good = model.posterior(votes) * counts
        kinds = np.stack([counts - good, good])
        says = np.stack([kinds @ (votes == v) for v in (-1, 0, 1)], -1).transpose(1, 0, 2) + prior * start
        says /= says.sum(2, keepdims=True)
        share = (good.sum() + 0.8 * prior) / (counts.sum() + prior)
        done = np.abs(says - model.says).max() < 1e-9
        model = VoteModel(float(share), says)
        if done:
            break
    return model


def fit_rules(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """The model fitted to the votes on all rows of counts(counts: a struct of COUNTS); texts that fail the base rule by their length do not count."""
    c = F.col("counts")
    patterns = counts.where(c["n_words"] >= MIN_WORDS).select(votes_of(c, rules).alias("code")).groupBy("code").count()
    found = patterns.toPandas()  # at most 3 ** len(rules) rows
    return fit_votes(found["code"].to_numpy(np.int64), found["count"].to_numpy(np.float64), len(rules))


def verdict_of(c: Column, model: VoteModel, rules: tuple[Rule, ...] = RULES, keep_from: float = 0.5) -> Column:
    """The counts, base_failed, posterior and kept as a struct. c: a struct of COUNTS."""
    posterior = model.posterior(unpack(np.arange(3 ** len(rules)), len(rules)))
    by_code = F.from_json(F.lit(f"[{','.join(f'{p:.9g}' for p in posterior)}]"), "array<double>")
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    p = F.when(c["n_words"] > 0, F.get(by_code, votes_of(c, rules))).otherwise(F.lit(0.0))
    return F.struct(*[c[n].alias(n) for n in COUNTS], failed.alias("base_failed"), p.alias("posterior"), (~failed & (p >= keep_from)).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep_from: float = 0.5) -> DataFrame:
    """The rows of docs that are kept, with all their columns, whatever these are called.

    Two passes over the texts: one counts vote patterns, one applies the fitted
    model; for cases see judge_quality.
    """
    model = fit_rules(docs.select(counts_of(F.col(text)).alias("counts")), rules)
    name = unused(docs, "_counts")
    kept = docs.withColumn(name, counts_of(F.col(text))).where(verdict_of(F.col(name), model, rules, keep_from)["kept"])
    return kept.drop(name)


def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, posterior and kept for every row of docs(doc_id, text).

    One pass over the texts; their counts are written down. Null and empty texts
    have no words and fail the base rule. Rows stay as they are, so repeats, ties
    and null ids need no care; long texts are counted whole. Other columns are
    ignored, and an empty table gives an empty one.
    """
    counted = materialise(docs.select("doc_id", counts_of(F.col("text")).alias("counts")), "quality-counts")
    return counted.select("doc_id", verdict_of(F.col("counts"), fit_rules(counted)).alias("v")).select("doc_id", "v.*")

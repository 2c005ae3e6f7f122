"""Benchmark decontamination by winnowing.

Words are lower-cased runs of letters, digits and non-ASCII characters. Of every
``w`` consecutive hashes of ``k`` words the smallest is kept, in documents and in
benchmark items alike, so that any shared span of ``k + w - 1`` words leaves at
least one fingerprint in common. Shared fingerprints are joined and extended,
word by word, to the whole shared span. Items shorter than the span get the same
with ``w = 1`` and ``k`` their own length.

Benchmark fingerprints go to the tasks in blocks of bounded size, and a block is
joined inside the pass over the documents, which therefore are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, materialise, schema_of, unused
from .words import WORD, gram_hashes, utf8, word_hashes

SPAN = 10
K = 5
#: Words of a block of benchmark items that is sent to the tasks at a time (about 100 bytes each there).
BLOCK_WORDS = 2_000_000

_LOWER = str.maketrans(UPPER, UPPER.lower())


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions of the smallest hash (the last among equals) of each w consecutive ones, in order and once each."""
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:n].copy(), np.arange(n)
    for j in range(1, w):
        better = hashes[j : j + n] <= best
        best[better] = hashes[j : j + n][better]
        at[better] = np.flatnonzero(better) + j
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def hashed(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, end to end, and each text's number of words."""
    return word_hashes(utf8(t).lower() for t in texts)


class BenchmarkBlock:
    """Fingerprints of some benchmark items, by the length of window they stand for."""

    def __init__(self, items: Iterable[tuple[int, str | None]], span: int = SPAN, k: int = K):
        self.span, self.k = span, k
        self.items = [(i, w) for i, t in items if (w := words_of(t))]
        self.by_length: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for n, (_, words) in enumerate(self.items):
            length = min(span, len(words))
            kk, w = self.sizes(length)
            grams = gram_hashes(hashed([" ".join(words)])[0], kk)
            for at in winnow(grams, w):
                self.by_length.setdefault(length, {}).setdefault(int(grams[at]), []).append((n, int(at)))
        self.sorted = {length: np.sort(np.fromiter(found, np.uint64, len(found))) for length, found in self.by_length.items()}

    def sizes(self, length: int) -> tuple[int, int]:
        """k and w for windows of so many words."""
        return (self.k, length - self.k + 1) if length == self.span else (length, 1)

    def search(self, texts: list[str | None]) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, list[int]]]]:
        """The number of words of each text; and of the texts with an occurrence: which words lie in one, and the items that occur.

        All texts are winnowed in one go: what is kept of a window inside a text
        does not depend on the texts around it, and more is kept at their ends only.
        """
        hashes, sizes = hashed(texts)
        ends = np.cumsum(sizes)
        shared: dict[int, list[tuple[int, int, int]]] = {}  # of a text: length of the window, place and hash of a fingerprint that items have too
        for length, known in self.sorted.items():
            k, w = self.sizes(length)
            grams = gram_hashes(hashes, k)
            at = winnow(grams, w) if len(hashes) >= length else np.arange(len(grams))
            own = grams[at]
            for p in at[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own].tolist():
                i = int(np.searchsorted(ends, p, side="right"))
                if p + k <= ends[i]:
                    shared.setdefault(i, []).append((length, p - int(ends[i] - sizes[i]), int(grams[p])))
        return sizes, {i: found for i, places in shared.items() if (found := self._extend(words_of(texts[i]), places))}

    def _extend(self, words: list[str], places: list[tuple[int, int, int]]) -> tuple[np.ndarray, list[int]] | None:
        """Each shared fingerprint extended word by word to the whole shared span, which counts if it holds a window."""
        hit, found = np.zeros(len(words), bool), set()
        done: dict[tuple[int, int], int] = {}  # item and diagonal: the end of the span already extended there
        for length, p, gram in places:
            k, _ = self.sizes(length)
            for n, q in self.by_length[length][gram]:
                item = self.items[n][1]
                if done.get((n, p - q), -1) > p or words[p : p + k] != item[q : q + k]:
                    continue
                a, b = p, q
                while a and b and words[a - 1] == item[b - 1]:
                    a, b = a - 1, b - 1
                end, e = p + k, q + k
                while end < len(words) and e < len(item) and words[end] == item[e]:
                    end, e = end + 1, e + 1
                done[n, p - q] = end
                if end - a >= length:
                    hit[a:end] = True
                    found.add(self.items[n][0])
        return (hit, sorted(found, key=_order)) if hit.any() else None


def _order(item: int | None) -> tuple[bool, int]:
    """Ids in order, the missing one last."""
    return item is None, item or 0


def _ranges(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of set words, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def _search_with(block):
    """A pandas function over texts and earlier findings. block: a broadcast BenchmarkBlock."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ranges, items in batches:
            rows, own, earlier, known = [], list(texts), list(ranges), list(items)
            for start in range(0, len(own), 500):
                sizes, found = block.value.search(own[start : start + 500])
                for i, n in enumerate(sizes.tolist(), start):
                    r, ids = list(map(int, earlier[i])), {None if pd.isna(x) else int(x) for x in known[i]}
                    if i - start in found:
                        hit, more = found[i - start]
                        for a, b in zip(r[::2], r[1::2], strict=True):
                            hit[a:b] = True
                        r, ids = _ranges(hit), ids | set(more)
                    rows.append((n, r, sorted(ids, key=_order)))
            yield pd.DataFrame(rows, columns=["n_words", "ranges", "items"])

    return run


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[list[tuple[int, str]]]:
    """Items in blocks of about ``block_words`` words. Rows without words are left out; repeated ids stay, as more windows of that item, and rows without id are windows of one item.

    A block is gathered only when it is used, so that the driver holds one at a time.
    """
    sized = benchmark.select("item_id", "text").where("text is not null").withColumn("_n", F.length("text"))
    total = sized.agg(F.sum("_n")).first()[0] or 0
    n = max(1, -(-int(total) // (6 * block_words)))
    own = sized.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    return [own.where(F.col("_block") == i).select("item_id", "text") for i in range(n)]


def with_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_words: int = BLOCK_WORDS, name: str = "_found") -> DataFrame:
    """docs with a struct of that name: n_words, ranges (starts and ends of hit runs of words) and items (ids that occur, once each).

    Every row is searched as a whole; null texts have no words. One pass for each
    block of the benchmark; later blocks' findings are merged into the first's.
    """
    none = F.array().cast("array<bigint>")
    out = docs.withColumn(name, F.struct(F.lit(0).cast("long").alias("n_words"), none.alias("ranges"), none.alias("items")))
    blocks = benchmark_blocks(benchmark, block_words)
    for i, part in enumerate(blocks):
        block = docs.sparkSession.sparkContext.broadcast(BenchmarkBlock([(r["item_id"], r["text"]) for r in part.collect()]))
        search = F.pandas_udf(_search_with(block), schema_of(n_words="long", ranges="longs", items="longs")).asNondeterministic()
        out = out.withColumn(name, search(F.col(text), F.col(name)["ranges"], F.col(name)["items"]))
        if i + 1 < len(blocks):
            out = materialise(out, "decontamination")  # so that a task holds one block at a time
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that hold no window of any item, with all their columns, whatever these are called; for cases see find_contamination."""
    name = unused(docs, "_found")
    return with_contamination(docs, benchmark, text, name=name).where(F.size(F.col(name)["ranges"]) == 0).drop(name)


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of docs(doc_id, text).

    benchmark(item_id, text). Items without id are searched like others and count
    as one item, which items_sha256 passes over; equal items each count; items
    without words never occur, and with an empty benchmark nothing does. Null
    texts have no words; repeated rows and null ids stay as rows; long texts are
    searched whole. Other columns are ignored, and an empty table gives an empty one.
    """
    f = F.col("_found")
    hit = F.aggregate(F.sequence(F.lit(0), F.size(f["ranges"]) - 1), F.lit(0).cast("long"), lambda s, i: s + F.when(i % 2 == 1, F.get(f["ranges"], i)).otherwise(-F.get(f["ranges"], i)))
    n_hit = F.when(F.size(f["ranges"]) > 0, hit).otherwise(F.lit(0).cast("long"))
    ids = F.array_join(F.array_sort(F.transform(f["items"], lambda x: x.cast("string"))), ",")
    return (
        with_contamination(docs.select("doc_id", "text"), benchmark, block_words=block_words)
        .select("doc_id", f["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(f["items"]).cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )

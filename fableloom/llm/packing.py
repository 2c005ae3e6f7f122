"""Packing along a space-filling curve.

Each document's token counts are hashed and projected to a few dimensions by
random signs, and the point is numbered along a Hilbert curve. Documents are
range-sorted by that number; laid end to end in this order and cut every
``capacity`` ids, neighbours on the curve share sequences and only the last
sequence of all needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, schema_of
from .tokens import word_tokenizer

CAPACITY, END_ID = 2048, 1
DIMENSIONS, LEVELS = 3, 10


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_signs(n_ids: int = 1 << 16, dimensions: int = DIMENSIONS) -> np.ndarray:
    """1 for plus or 0 for minus for each dimension and token id, from a hash of the id."""
    h = np.arange(1, n_ids + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return np.stack([((h >> np.uint64(7 * d)) & np.uint64(1)).astype(np.uint8) for d in range(dimensions)])


def curve_points(ids: np.ndarray, lengths: np.ndarray, signs: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Points of documents whose ids lie end to end: the mean sign in each dimension, stretched and cut into 2 ** levels steps."""
    ends = np.cumsum(lengths)
    mean = np.zeros((len(lengths), len(signs)))
    for d, own in enumerate(signs):
        plus = np.concatenate([[0], np.cumsum(own[ids], dtype=np.int64)])
        mean[:, d] = (2 * (plus[ends] - plus[ends - lengths]) - lengths) / np.maximum(1, lengths)
    unit = 0.5 + 0.5 * np.tanh(3.0 * mean)
    return np.minimum((unit * (1 << levels)).astype(np.int64), (1 << levels) - 1)


def hilbert_numbers(points: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Place of each row of points (integers below 2 ** levels) along the Hilbert curve through that grid."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    bit = 1 << (levels - 1)
    while bit > 1:  # undo the turns and flips of each finer cell
        low = bit - 1
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    bit = 1 << (levels - 1)
    while bit > 1:
        turn ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    out = np.zeros(x.shape[1], np.int64)
    for b in range(levels - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and a struct ``t`` of n, curve and ids (little-endian unsigned 16-bit, the end id last) for every row of docs(doc_id, text)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, signs = word_tokenizer(tokenizer), token_signs()
        for texts in batches:
            parts = [pd.DataFrame({"n": [], "curve": [], "ids": []})]
            for start in range(0, len(texts), 1000):
                ids = encoder.encode(list(texts.iloc[start : start + 1000]))
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                curve = hilbert_numbers(curve_points(np.concatenate(ids), lengths, signs))
                end = np.array([end_id], "<u2").tobytes()
                parts.append(pd.DataFrame({"n": lengths + 1, "curve": curve, "ids": [i.astype("<u2", copy=False).tobytes() + end for i in ids]}))
            yield pd.concat(parts[1:], ignore_index=True) if len(parts) > 1 else parts[0]

    return docs.select("doc_id", F.pandas_udf(run, schema_of(n="long", curve="long", ids="binary"))(F.col("text")).alias("t"))


def stream_starts(sizes: DataFrame) -> DataFrame:
    """row and start: where each document begins in the stream of all ids, in the order of (curve, row).

    sizes(row, n, curve) is range-sorted; only the sum of each range reaches the
    driver, one number for each partition.
    """
    spark = sizes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        at, part = 0, TaskContext.get().partitionId()
        for b in batches:
            ends = at + b["n"].cumsum()
            yield pd.DataFrame({"row": b["row"], "start": ends - b["n"], "n": b["n"], "part": part})
            at = int(ends.iloc[-1]) if len(b) else at

    ordered = sizes.repartitionByRange(n, "curve", "row").sortWithinPartitions("curve", "row").mapInPandas(run, schema_of(row="long", start="long", n="long", part="int"))
    ordered = materialise(ordered, "packing-order")
    sums = {r["part"]: r["s"] for r in ordered.groupBy("part").agg(F.sum("n").alias("s")).collect()}
    base, before = 0, {}
    for p in sorted(sums):
        before[p], base = base, base + sums[p]
    bases = F.from_json(F.lit(str([before.get(p, 0) for p in range(max(sums, default=0) + 1)])), "array<bigint>")
    return ordered.select("row", (F.col("start") + F.get(bases, F.col("part"))).alias("start"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (16-bit), ids_crc32, doc_tokens, sequence_id and offset.

    A null text counts as empty and is packed as its end id. Repeated rows are
    packed each; null ids stay null; ties on the curve go by the order of rows.
    Other columns are ignored. All sequences but the last are full.
    """
    tokens = tokenised(docs, tokenizer or default_tokenizer(), end_id).select("doc_id", "t.*", F.monotonically_increasing_id().alias("row"))
    tokens = materialise(tokens, "packing-tokens")
    starts = stream_starts(tokens.select("row", "n", "curve"))

    fields = {"start": "longs", "length": "longs", "ids": "binarys", "ids_crc32": "longs", "sequence_id": "longs", "offset": "longs"}

    def cut(all_ids: pd.Series, starts: pd.Series) -> pd.DataFrame:
        rows = []
        for ids, at in zip(all_ids, starts, strict=True):
            ids, at = np.frombuffer(ids, "<u2"), int(at)
            cuts = np.unique(np.concatenate([[0, len(ids)], np.arange(capacity - at % capacity, len(ids), capacity)]))
            own = [ids[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
            rows.append((cuts[:-1], np.diff(cuts), [x.tobytes() for x in own], [zlib.crc32(x.astype("<u4").tobytes()) for x in own], (at + cuts[:-1]) // capacity, (at + cuts[:-1]) % capacity))
        return pd.DataFrame(rows, columns=list(fields))

    placed = tokens.select("row", "doc_id", "n", "ids").join(starts, "row")
    placed = placed.select("doc_id", F.col("n").alias("doc_tokens"), F.pandas_udf(cut, schema_of(**fields)).asNondeterministic()("ids", "start").alias("p"))
    return placed.select("doc_id", "doc_tokens", F.inline(F.arrays_zip(*[F.col("p")[f].alias(f) for f in fields])))


def pack_documents(docs: DataFrame) -> DataFrame:
    """The pieces without their ids."""
    return pack(docs).drop("ids")

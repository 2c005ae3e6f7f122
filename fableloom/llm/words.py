"""Words as runs of letters, digits and non-ASCII characters, and hashes of them that are the same in every process."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed at a time.
PIECE = 1 << 18

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class _Powers:
    """Powers of PRIME and of its inverse, as many as were needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            step = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n + PIECE, np.uint64(x))]), dtype=np.uint64)
            cls.up, cls.down = step(int(PRIME)), step(pow(int(PRIME), -1, 1 << 64))
        return cls.up, cls.down


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each slice of bytes, by differences of one running polynomial."""
    up, down = _Powers.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def word_hashes(raw: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, end to end, and each text's number of words. raw: lower-case texts in UTF-8."""
    raw = list(raw)
    parts, sizes = [np.zeros(0, np.uint64)], np.zeros(len(raw), np.int64)
    for batch in _batches(raw):
        data = np.frombuffer(b"\n".join(t for _, t in batch) + b"\n", np.uint8)
        inside = _IN_WORD[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        starts, ends = edges[::2], edges[1::2]
        parts.append(mix(slice_hashes(data, starts, ends)))
        own = np.searchsorted(starts, np.cumsum([len(t) + 1 for _, t in batch]))
        np.add.at(sizes, [i for i, _ in batch], np.diff(own, prepend=0))
    return np.concatenate(parts), sizes


def _batches(raw: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """The number and a stretch of a text, in batches of about PIECE bytes; long texts are cut at spaces."""
    batch, size = [], 0
    for i, t in enumerate(raw):
        at = 0
        while at >= 0:
            end = t.find(b" ", at + PIECE) if len(t) - at > PIECE else -1
            batch.append((i, t[at : end if end >= 0 else None] if at or end >= 0 else t))
            size += len(batch[-1][1])
            at = end
            if size >= PIECE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h *= PRIME
        h += words[j : j + n]
    return mix(h)

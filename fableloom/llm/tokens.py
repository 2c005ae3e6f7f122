"""Token ids by a public tokenizer whose words end at white space, fast on repeated words."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

#: A run of letters (small ASCII ones, and Latin ones that composing leaves as they are), then signs without apostrophes.
_PLAIN = re.compile("([a-z\xdf-\xf6\xf8-ɏ]+)([!-&(-/:-@\\[-`{-~]*)")
#: Characters of texts that are split and encoded at a time.
STEP_CHARS = 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others for those from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class _Numbers(dict):
    """The number of each word, in the order in which they come; new ones are listed."""

    def __init__(self, words=()):
        super().__init__(words)
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.fresh.append(word)
        return n


class WordTokenizer:
    """Ids of whole texts by a tokenizer that lower-cases and drops white space.

    Its own splitting never crosses a space or a line end, nor a change from
    letters to signs, so the ids of a text are those of its parts one after the
    other, and a part met before need not be encoded again. Of a full store the
    older half is dropped.
    """

    def __init__(self, path: str, special_as_text: bool = False, store: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.store = store
        self.known, self.flat, self.start = _Numbers(), np.zeros(0, np.uint16), np.zeros(1, np.int64)  # the ids of word n are flat[start[n] : start[n + 1]]

    def _forget(self) -> None:
        half = len(self.known) // 2
        self.known = _Numbers((w, n - half) for w, n in self.known.items() if n >= half)
        self.flat = self.flat[self.start[half] :].copy()
        self.start = self.start[half:] - self.start[half]

    def _piece(self, piece: str) -> list[int]:
        """Ids of a run of letters or of signs."""
        n = self.known.get(piece, len(self.start))
        if n < len(self.start) - 1:
            return self.flat[self.start[n] : self.start[n + 1]].tolist()
        if not piece.isascii():
            piece = "".join(map(self.letters.__getitem__, piece.encode()))
        return [t.id for t in self.model.tokenize(piece)]

    def _learn(self) -> None:
        """Ids of the fresh words. Plain ones go to the model piece by piece, which spares the tokenizer's own splitting."""
        words, self.known.fresh = self.known.fresh, []
        pieces: dict[str, list[int]] = {"": []}
        own: list[list[int] | None] = []
        for w in words:
            m = _PLAIN.fullmatch(w)
            if m and (w.isascii() or w == w.lower()):
                for p in m.groups():
                    if p not in pieces:
                        pieces[p] = self._piece(p)
                own.append(pieces[m[1]] + pieces[m[2]])
            else:
                own.append(None)
        others = [w for w, ids in zip(words, own, strict=True) if ids is None]
        for start in range(0, len(others), 10_000):
            part = others[start : start + 10_000]
            pieces.update((w, e.ids) for w, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True))
        own = [pieces[w] if ids is None else ids for w, ids in zip(words, own, strict=True)]
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(own), np.uint16, int(lengths.sum()))])

    def _ids(self, split: list[list[str]]) -> list[np.ndarray]:
        """The ids of each list of words."""
        if len(self.known) > self.store:
            self._forget()
        counts = np.fromiter(map(len, split), np.int64, len(split))
        n = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if self.known.fresh:
            self._learn()
        start, length = self.start[n], self.start[n + 1] - self.start[n]
        ends = np.cumsum(length)
        if not len(ends):
            return [np.zeros(0, np.uint16) for _ in split]
        ids = self.flat[np.arange(ends[-1]) + np.repeat(start - (ends - length), length)]
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; None counts as empty."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for batch in _batches(texts):
            for (i, _), ids in zip(batch, self._ids([s.split(" ") for _, s in batch]), strict=True):
                out[i].append(ids)
        return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, np.uint16), *x]) for x in out]


def _batches(texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
    """The number and a stretch of a text, in batches of about STEP_CHARS; long texts are cut at spaces."""
    batch, size = [], 0
    for i, t in enumerate(texts):
        t = (t or "").replace("\n", " ")
        if not ("<|" in t or "Σ" in t or "İ" in t):  # special tokens are told by case, and these letters by their place or in two steps
            t = t.lower()
        at = 0
        while at >= 0:
            end = t.find(" ", at + STEP_CHARS) if len(t) > STEP_CHARS else -1
            batch.append((i, t[at : end if end >= 0 else None]))
            size += len(batch[-1][1])
            at = end
            if size >= STEP_CHARS:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


_LOADED: dict[tuple[str, bool], WordTokenizer] = {}


def word_tokenizer(path: str, special_as_text: bool = False) -> WordTokenizer:
    """One tokenizer for each process, so that a Python worker keeps what it has learnt from task to task."""
    key = path, special_as_text
    if key not in _LOADED:
        _LOADED[key] = WordTokenizer(path, special_as_text)
    return _LOADED[key]

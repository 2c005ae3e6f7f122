import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from fableloom.llm import tokens
from fableloom.llm.packing import curve_points, default_tokenizer, hilbert_numbers, pack, pack_documents, token_signs
from fableloom.llm.tokens import WordTokenizer


def test_hilbert_visits_neighbours():
    grid = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    numbers = hilbert_numbers(grid, 3)
    assert sorted(numbers) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(numbers)], axis=0)).sum(1) == 1).all()


TEXTS = ["Plain words, and more. " * 9, "it's 12,345 ΣΑΣ σας <|endoftext|> a\tb  c", "ÉCOLE école é\n\nx", "", None, "x" * 5000]


def test_tokenizer_equals_the_whole_text():
    encoder = WordTokenizer(default_tokenizer(), store=3)
    for _ in range(2):
        for text, ids in zip(TEXTS, encoder.encode(TEXTS), strict=True):
            assert ids.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_tokenizer_equals_the_whole_text_of_any_letters():
    r = random.Random(2)
    signs = "abcxyz" * 4 + "éßñøžǅŉƀɏªµº" + "ΑΣσςЖж中あ٣²½" + " \n\t .,;:'’&$%!-_()\"" + "\u0301\u00a0\u200b" + "AZÉİ0123" + "🙂"
    texts = ["".join(r.choices(signs, k=r.randint(0, 60))) for _ in range(3000)] + ["don't I'll x's 's'm &&'s a'b", "<|endoftext|>.", "a" * 300 + "."]
    encoder = WordTokenizer(default_tokenizer(), store=50)
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        wanted = [e.ids for e in encoder.tokenizer.encode_batch(part, add_special_tokens=False)]
        assert [i.tolist() for i in encoder.encode(part)] == wanted


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="needs the driver's tables")
def test_tokenizer_equals_the_whole_text_of_the_tables(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    encoder = WordTokenizer(default_tokenizer(), store=5000)
    wanted = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    found = [i.tolist() for start in range(0, len(texts), 50) for i in encoder.encode(texts[start : start + 50])]
    assert found == wanted


def test_long_text_is_cut_and_stitched(monkeypatch):
    encoder = WordTokenizer(default_tokenizer())
    texts = ["some words, here. " * 50, "", None, "x" * 500, "one two"]
    whole = [i.tolist() for i in encoder.encode(texts)]
    monkeypatch.setattr(tokens, "STEP_CHARS", 40)
    assert [i.tolist() for i in encoder.encode(texts)] == whole


def test_points_are_mean_signs():
    ids, lengths, signs = np.array([3, 9, 9, 7, 3], np.uint16), np.array([2, 0, 3]), token_signs()
    for got, own in zip(curve_points(ids, lengths, signs), ([3, 9], [], [9, 7, 3]), strict=True):
        mean = (2.0 * signs[:, own] - 1).mean(1) if own else np.zeros(len(signs))
        assert got.tolist() == np.minimum(((0.5 + 0.5 * np.tanh(3 * mean)) * 1024).astype(int), 1023).tolist()


@pytest.mark.parametrize("capacity", [2048, 7])
def test_pieces_rebuild_the_documents(docs, clashing, capacity):
    frame = clashing(docs(*TEXTS))
    rows = pack(frame, capacity=capacity).collect()
    encoder = WordTokenizer(default_tokenizer())
    known = {r.doc_id: r.text for r in frame.collect()}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32
    assert set(by_doc) == set(known)
    for doc, pieces in by_doc.items():
        wanted = [*encoder.encode([known[doc]])[0].tolist(), 1]
        pieces = sorted(pieces, key=lambda r: r.start)
        if doc == 903:  # twice
            assert sum(r.length for r in pieces) == 2 * len(wanted)
            continue
        assert [x for r in pieces for x in np.frombuffer(r.ids, "<u2").tolist()] == wanted
        assert all(r.doc_tokens == len(wanted) for r in pieces)
    stream = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    at = 0
    for sequence, offset, length in stream:
        assert sequence * capacity + offset == at and offset + length <= capacity
        at += length


def test_empty(docs):
    assert pack_documents(docs().limit(0)).count() == 0

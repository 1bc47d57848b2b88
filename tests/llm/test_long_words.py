"""Words without end: base64 lines and scripts without spaces."""

from __future__ import annotations

import random
import resource
import time

import numpy as np
import pytest

from waymill.llm import pieces
from waymill.llm.arrays import U64, mix64
from waymill.llm.pieces import MODEL, Lattice, LongChunk, encode_pieces, piece_table, sample_pieces

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"


@pytest.fixture(scope="module")
def table():
    return piece_table(MODEL, 0.5)


@pytest.mark.parametrize("word", [" unbelievable", "e", " é▁日本語\U0001f600x" * 3, "  " * 9, "\n", "abc" * 40])
@pytest.mark.parametrize("segment", [1 << 15, 7])
def test_a_chunk_by_itself_is_drawn_as_in_a_block(table, monkeypatch, word, segment):
    monkeypatch.setattr(pieces, "_SEGMENT", segment)
    keys = mix64(np.arange(300).astype(U64))
    counts, found = Lattice(table, [word]).sample(np.zeros(300, np.int64), keys)
    ends = np.concatenate(([0], np.cumsum(counts)))
    long = LongChunk(table, word)
    for i in range(300):
        assert long.sample(keys[i]).tolist() == found[ends[i] : ends[i + 1]].tolist()


def test_blocks_do_not_change_what_is_drawn(table, monkeypatch):
    texts = [" ".join(random.Random(i).choices(["the", "of", "x" * 600, "thing"], k=40)) for i in range(6)]
    whole = [p.tolist() for p in sample_pieces(table, list(range(6)), texts)]
    for name, value in (("_BLOCK", 3), ("_BLOCK_CHARS", 5), ("_LONG", 2)):
        monkeypatch.setattr(pieces, name, value)
        assert [p.tolist() for p in sample_pieces(table, list(range(6)), texts)] == whole
    assert [pieces._decoded(table, p) for p in whole] == texts


def test_a_word_of_a_million_characters(table):
    text = "start " + "".join(random.Random(1).choices(LETTERS, k=1_000_000)) + " end"
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    [found] = sample_pieces(table, [5], [text])
    assert pieces._decoded(table, found.tolist()) == text
    assert time.perf_counter() - start < 40
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000


def test_lossless_is_told_without_the_text(spark):
    rows = [(1, "a b"), (2, None), (3, ""), (4, "x" * 100_000 + " y\n ▁"), (None, "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "key")
    coded = encode_pieces(docs, key="key", lossless="same")
    assert coded.columns == ["key", "text", "pieces", "same"] and all(r["same"] for r in coded.collect())
    assert encode_pieces(docs.limit(0), key="key", lossless="same").collect() == []

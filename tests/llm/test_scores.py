"""LM scoring: texts are split for the counts and the ids alone, and sums over blocks are those of a plain softmax."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymill.llm import scoring
from waymill.llm.recurrent import HIDDEN, Network, score_texts, train


def test_rounds_read_stored_ids_and_no_texts(spark, monkeypatch):
    seen = []
    for name in ("train_network", "better_network"):

        def noted(docs, *rest, real=getattr(scoring, name)):
            seen.append(docs.columns)
            return real(docs, *rest)

        monkeypatch.setattr(scoring, name, noted)
    rows = [(i, " ".join(["one two three four five six"] * 8)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    scored = scoring.score_documents(docs, F.col("doc_id") % 5 != 0, outputs=16, classes=3).collect()
    assert len(scored) == 60 and all(r["n_tokens"] == 49 for r in scored)
    assert len(seen) >= 2 and all("ids" in columns and "text" not in columns for columns in seen)


def test_words_are_those_of_a_plain_split():
    rng = random.Random(4)
    signs = [*map(chr, range(34)), "A", "Z", "b", "\x7f", "\x85", "\xa0", "É", "İ", "\U0001f600", " ", " "]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(2000)] + [None, "", " ", "\0", " a  B\n"]
    for column in (pa.array(texts), pa.array(texts).slice(700, 900), pa.array([], pa.string())):
        words, sizes = scoring.words_of(column)
        plain = [(t or "").encode().lower().split() for t in column.to_pylist()]
        assert words.to_pylist() == [w for ws in plain for w in ws] and sizes.tolist() == [len(ws) for ws in plain]


@pytest.mark.parametrize("size", [0.3, 60.0])
def test_probabilities_and_gradients_of_a_plain_softmax(size):
    """Small logits, and such as exp leaves the range of single precision for."""
    rng = np.random.default_rng(5)
    net = Network.of_counts(np.arange(50, 0, -1.0) ** 2, end=7, classes=6)
    net = net.with_flat(net.flat() + rng.standard_normal(len(net.flat())) * size)
    states, targets, g = rng.uniform(-1, 1, (80, HIDDEN)).astype(np.float32), rng.integers(0, 50, 80), {}
    found = net.log_p(states, targets, g)

    def log_softmax(logits):
        logits = logits - logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    wide = states.astype(float)
    of = np.searchsorted(net.starts, targets, side="right") - 1
    by_class = log_softmax(wide @ net.class_w + net.class_b)
    d_class = np.exp(by_class)
    d_class[np.arange(80), of] -= 1
    expected, d_words = by_class[np.arange(80), of], np.zeros(net.word_w.shape)
    for i, (t, c) in enumerate(zip(targets, of)):
        its = slice(net.starts[c], net.starts[c + 1])
        word = log_softmax((net.word_w[its] @ wide[i] + net.word_b[its])[None])[0]
        expected[i] += word[t - net.starts[c]]
        q = np.exp(word)
        q[t - net.starts[c]] -= 1
        d_words[its] += np.outer(q, wide[i])
    assert np.allclose(found, expected, rtol=1e-4, atol=1e-3)
    assert np.allclose(g["class_w"], wide.T @ d_class, atol=2e-3) and np.allclose(g["word_w"], d_words, atol=2e-3)


def test_texts_of_small_ids_score_as_those_of_large_ones():
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 40, n).astype(np.uint16) for n in (0, 1, 70, 300, 5)]
    net = train(Network.of_counts(np.arange(40, 0, -1.0), end=3, classes=4), texts)
    assert np.allclose(score_texts(net, texts), score_texts(net, [t.astype(np.int32) for t in texts]))

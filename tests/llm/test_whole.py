"""Operators do their whole job: no smaller model, no documents, words or contexts left out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from waymill.llm import scoring
from waymill.llm.recurrent import Lanes, Network


def test_the_state_has_24_units():
    net = Network.of_counts(np.arange(40, 0, -1.0), end=3, classes=4)
    assert net.u.shape == (24, 72) and net.word_w.shape == (40, 24)


def test_windows_grow_as_lanes_end_and_hold_every_token_once():
    texts = [np.zeros(n, np.int32) for n in (5000, 900, *range(1, 60))]
    dealt = Lanes(texts, 1, 32)
    windows = list(dealt.windows(16))
    at = np.sort(np.concatenate([places[there] for places, there in windows]))
    assert np.array_equal(at, np.arange(len(dealt.targets)))
    assert len(windows) < 5001 / 16 / 4


def test_the_network_learns_from_every_document(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    learn = scoring.train

    def counted(net, texts, **options):
        seen.add(sum(len(t) for t in texts))
        return learn(net, texts, **options)

    monkeypatch.setattr(scoring, "train", counted)
    rows = [(i, " ".join(["one two three four five six"] * 8)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    scored = scoring.score_documents(docs, F.col("doc_id") % 5 != 0, outputs=16, classes=3).collect()
    assert seen.value == 160 * 48
    assert sum(r["score"] for r in scored) > 0.999 * sum(r["base_score"] for r in scored)

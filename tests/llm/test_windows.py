"""Removal of repeated windows against a plain one that looks at every window."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymill.llm import windows
from waymill.llm.windows import Runs, repeated_windows, repeated_windows_of, window_runs


def plainly(docs: list[list[bytes]], window: int) -> list[set[int]]:
    """Of documents in order, the words that a window which occurred earlier covers."""
    seen, gone = set(), []
    for words in docs:
        own = set()
        for i in range(len(words) - window + 1):
            shown = tuple(words[i : i + window])
            if shown in seen:
                own |= set(range(i, i + window))
            seen.add(shown)
        gone.append(own)
    return gone


def covered(batch, docs):
    gone = [set() for _ in docs]
    for place, _, start, end in zip(*(c.to_pylist() for c in batch.columns)):
        gone[place] |= set(range(start, end))
    return gone


TEXTS = st.lists(st.lists(st.sampled_from("a b c dd \U0001f600".split()), max_size=40), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(2, 8), st.sampled_from([1 << 18, 9]), st.booleans())
def test_runs_hold_each_window_once_and_judge_it(docs, window, segment, all_hot):
    before, windows._SEGMENT = windows._SEGMENT, segment
    try:
        texts = pa.array([" \n".join(d) for d in docs], pa.string())
        place = np.arange(len(docs))
        hot = np.empty(0, np.uint64)
        if all_hot:
            parts = list(window_runs(place, place, texts, window, 1, hot, False))
            hot = np.unique(np.concatenate([p.key for p in parts])) if parts else hot
        parts = list(window_runs(place, place, texts, window, 1, hot, True))
    finally:
        windows._SEGMENT = before
    assert sum(int(p.windows.sum()) for p in parts) == sum(max(0, len(d) - window + 1) for d in docs)
    if not parts:
        return
    runs = Runs.together(parts)
    if all_hot:
        assert (runs.windows == 1).all()
    shown = runs.texts().to_pylist()
    for p, start, n, text in zip(runs.place.tolist(), runs.start.tolist(), runs.windows.tolist(), shown):
        assert text.decode().split() == docs[p][start : start + n + window - 1]
    assert covered(repeated_windows_of(runs, window), docs) == plainly(docs, window)
    # Equal windows of different runs are dealt alike.
    keys = {}
    for p, start, n, key in zip(runs.place.tolist(), runs.start.tolist(), runs.windows.tolist(), runs.key.tolist()):
        for i in range(start, start + n):
            assert keys.setdefault(tuple(docs[p][i : i + window]), key) == key


def test_equal_hashes_of_different_windows(monkeypatch):
    docs = [list("abcab"), list("bcabx"), list("ab")]
    texts, place = pa.array([" ".join(d) for d in docs], pa.string()), np.arange(3)
    runs = Runs.together(list(window_runs(place, place, texts, 2, 1, np.empty(0, np.uint64), True)))
    monkeypatch.setattr(windows, "_sums", lambda numbers: lambda low, high: np.zeros(len(low), np.uint64))
    assert covered(repeated_windows_of(runs, 2), docs) == plainly(docs, 2)


PASSAGE = " ".join(f"p{i * i % 1013}" for i in range(60))
LONG = " ".join(f"q{i * i % 10007}" for i in range(60_000))
GIANT = "z" * 3_000_000
ROWS = [
    (1, "start " + PASSAGE + " end"), (2, "x " + PASSAGE.replace(" ", " \n\t") + " y"), (2, "x " + PASSAGE.replace(" ", " \n\t") + " y"),
    (3, None), (4, ""), (5, " \x0b "), (None, PASSAGE), (6, "other key " + PASSAGE), (6, PASSAGE + " other text"),
    (7, LONG + " a " + LONG), (8, "word " * 5000), (9, f"{GIANT} " + PASSAGE + f" {GIANT}"), (10, f"{GIANT[1:]} " + PASSAGE + f" {GIANT}"),
    (11, "few words"), (12, PASSAGE.upper()), (13, " ".join(f"é{i}" for i in range(30)) + " \U0001f600"), (-3, PASSAGE[:200]),
]


def expected(spark, rows, window):
    marks = spark.createDataFrame([(i, t or "") for i, (_, t) in enumerate(rows)], "i int, t string")
    mark = {r["i"]: r["m"] for r in marks.select("i", F.xxhash64("t").alias("m")).collect()}
    distinct = sorted({(k is None, k or 0, mark[i], t or "") for i, (k, t) in enumerate(rows)})
    words = {d: d[3].encode().split() for d in distinct}
    gone = dict(zip(distinct, plainly([words[d] for d in distinct], window)))
    found = []
    for i, (k, t) in enumerate(rows):
        own = (k is None, k or 0, mark[i], t or "")
        kept = b" ".join(w for j, w in enumerate(words[own]) if j not in gone[own])
        found.append((k, len(words[own]), len(gone[own]), kept.decode(), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


@pytest.mark.parametrize("hot", [50_000, 0, 2])
def test_nulls_ties_long_texts_and_clashing_names(spark, monkeypatch, hot):
    monkeypatch.setattr(windows, "_HOT", hot)
    monkeypatch.setattr(windows, "_BUCKET", 100)
    docs = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, place int, mark string").repartition(3)
    found = []
    for r in repeated_windows(docs, window=20).collect():
        removed = sum(s["end"] - s["start"] for s in r["spans"])
        found.append((r["doc_id"], r["n_words"], removed, r["kept_text"], r["kept_sha256"]))
    assert sorted(found, key=repr) == expected(spark, ROWS, 20)


def test_many_copies_of_a_passage(spark):
    """A passage in every third document, with other words around it: found, and never gathered whole."""
    rows = [(i, f"a{i} b{i} c{i} " + (PASSAGE if i % 3 == 0 else f"n{i}") + f" d{i} e{i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: sum(s["end"] - s["start"] for s in r["spans"]) for r in repeated_windows(docs).collect()}
    assert found == {i: 60 if i % 3 == 0 and i else 0 for i in range(900)}


def test_empty_table(spark):
    assert repeated_windows(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        repeated_windows(spark.createDataFrame([], "doc_id long, text string"), window=5)

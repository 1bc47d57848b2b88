"""The audit of filters against a plain one that applies every order to every document."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymill.llm.interactions import audit_filters, judge_documents, order_counts, removal_steps

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def plainly(judged, filters):
    """(part, order, step) → counts, by walking through the filters."""
    found = {}
    for part in {r[0] for r in judged}:
        own = [r for r in judged if r[0] == part]
        shares = dict.fromkeys(filters, 0)
        for order in map("".join, permutations(filters)):
            left = list(own)
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                again = sum(name in r[1] for r in own) - len(gone)
                left = [r for r in left if name not in r[1]]
                shares[name] += len(gone)
                alone = sum(r[1] == name for r in own)
                found[part, order, step] = [len(left), len(gone), again, alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), counts in found.items():
            if p == part:
                counts.append(shares[order[step - 1]])
    return found


def test_steps_of_removal():
    orders, steps = removal_steps(3)
    for order, by_mask in zip(orders.tolist(), steps.tolist()):
        for mask, step in enumerate(by_mask):
            assert step == next((k for k, f in enumerate(order, 1) if mask >> f & 1), 4)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.booleans(), st.booleans()), max_size=40))
def test_counts(documents):
    weights = np.zeros((16, 3), np.int64)
    for mask, good, toxic in documents:
        weights[mask] += 1, good, toxic
    orders, steps = removal_steps(4)
    found = order_counts(weights, orders, steps)
    judged = [("p", "".join(c for i, c in enumerate("ABCD") if m >> i & 1), g, t) for m, g, t in documents]
    for (_, order, step), counts in plainly(judged, "ABCD").items():
        row = [i for i, o in enumerate(orders.tolist()) if "".join("ABCD"[f] for f in o) == order][0]
        assert [int(found[c][row, step - 1]) for c in (*COUNTS, "shapley")] == counts


LONG = " ".join(f"w{i}" for i in range(250))
HUGE = "x" * 3_000_000
ROWS = [
    (1, LONG, "a", 9), (2, LONG, "a", 9), (2, LONG, "a", 9), (3, None, None, 9), (4, "", "", 9), (None, LONG, "a", 9), (5, HUGE, "b", 9),
    (6, "A B " * 150, "b", 9), (7, "no & yes " + LONG, "c", 9), (8, HUGE, None, 9), (9, f"{LONG} é \U0001f600 {LONG}", "d", 9),
]
FAILS = ["", "E", "E", "A", "AE", "", "A", "BC", "D", "AE", ""]


def test_audit_with_nulls_ties_and_clashing_names(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, good int")
    docs = docs.withColumnsRenamed({"good": "whole"}).withColumn("digest", docs["source"]).withColumn("A", docs["source"])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (7, None, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    judged = judge_documents(docs, labels)
    found = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (*COUNTS, "shapley")] for r in audit_filters(judged, "ABCDE").collect()}
    flags = {1: (True, False), 2: (True, True), 7: (False, True)}
    plain = [(source or "", fails, *flags.get(key, (False, False))) for (key, _, source, _), fails in zip(ROWS, FAILS)]
    assert found == plainly(plain, "ABCDE")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(judge_documents(docs, labels), "ABCDE").collect() == []
    some = spark.createDataFrame([(1, "x", "a")], docs.schema)
    assert len(audit_filters(judge_documents(some, labels), "ABCDE").collect()) == 600


@pytest.mark.parametrize("filters", ["", "AA", "ABCDEFGH"])
def test_names_of_filters(spark, filters):
    with pytest.raises(ValueError):
        audit_filters(spark.createDataFrame([], "part string"), filters)

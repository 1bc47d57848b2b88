"""Operators against brute force on random small tables."""

from __future__ import annotations

from tables import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from waymill.operators import (
    attach_name,
    branch_counts,
    cheapest_per_key,
    column_profile,
    least_row_per_key,
    newer_than,
    newer_than_per_key,
    high_water_marks,
    read_mark,
)
from waymill.sources import inline_table

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.sampled_from("abc"))
numbers = st.one_of(st.none(), st.integers(-3, 3))


def null_first(value):
    return (value is not None, value if value is not None else 0)


@few
@given(data=st.lists(st.tuples(keys, st.integers(-3, 3), st.integers(0, 9)), max_size=30), parts=st.integers(1, 5))
def test_cheapest_row(spark, data, parts):
    df = inline_table(spark, data, "k STRING, amount INT, tie INT").repartition(parts)
    best = {}
    for k, amount, tie in data:
        best[k] = min(best.get(k, (amount, tie)), (amount, tie))
    assert rows(cheapest_per_key(df, ["k"], ties=["tie"])) == sorted(((k, *v) for k, v in best.items()), key=repr)


@few
@given(data=st.lists(st.tuples(keys, numbers, numbers), max_size=30))
def test_least_row_does_not_depend_on_order(spark, data):
    first = inline_table(spark, data, "k STRING, a INT, b INT")
    second = inline_table(spark, data[::-1], "k STRING, a INT, b INT").repartition(3)
    best = {}
    for k, a, b in data:
        best[k] = min(best.get(k, (a, b)), (a, b), key=lambda pair: tuple(map(null_first, pair)))
    expected = sorted(((k, *v) for k, v in best.items()), key=repr)
    assert rows(least_row_per_key(first, ["k"], ["a"])) == expected == rows(least_row_per_key(second, ["k"], ["a"]))


@few
@given(codes=st.lists(keys, max_size=30), known=st.sets(st.sampled_from("abcd")))
def test_a_name_lookup_keeps_every_row(spark, codes, known):
    df = inline_table(spark, [(c,) for c in codes], "code STRING")
    names = inline_table(spark, [(c, c.upper()) for c in sorted(known)], "c STRING, n STRING")
    expected = sorted(((c, c.upper() if c in known else None) for c in codes), key=repr)
    assert rows(attach_name(df, names, "code", "name"), "code", "name") == expected


@few
@given(state=st.lists(st.tuples(keys, numbers), max_size=20), batch=st.lists(st.tuples(keys, numbers), max_size=20))
def test_marks(spark, state, batch):
    stored = inline_table(spark, state, "k STRING, t INT")
    new = inline_table(spark, batch, "k STRING, t INT")
    times = [t for _, t in state if t is not None]
    mark = max(times) if times else None
    read = read_mark(stored, "t")
    assert (None if read is None else spark.range(1).select(read).first()[0]) == mark
    kept = [(k, t) for k, t in batch if mark is None or (t is not None and t > mark)]
    assert rows(newer_than(new, "t", mark)) == sorted(kept, key=repr)
    marks = {k: max(t for key, t in state if key == k and t is not None) for k, v in state if v is not None}
    kept = [(k, t) for k, t in batch if k is None or k not in marks or (t is not None and t > marks[k])]
    assert rows(newer_than_per_key(new, "t", high_water_marks(stored, "t", ["k"]), ["k"])) == sorted(kept, key=repr)


@few
@given(data=st.lists(st.tuples(keys, numbers), max_size=20))
def test_counts_and_profile(spark, data):
    df = inline_table(spark, data, "k STRING, v INT")
    counts = dict(rows(branch_counts(df.filter("k IS NOT NULL"), "k")))
    named = [k for k, _ in data if k is not None]
    assert {k: n for k, n in counts.items() if k != "total"} == {k: named.count(k) for k in named}
    assert counts.get("total", 0) == len(named)
    values = [v for _, v in data if v is not None]
    profile = {row[0]: row[1:] for row in rows(column_profile(df))}
    text = (str(min(values)), str(max(values))) if values else (None, None)
    assert profile["v"] == (len(data), len(data) - len(values), len(set(values)), *text)
    assert {row[0]: row[1:] for row in rows(column_profile(df, ["v"], approximate=True))}["v"] == profile["v"]
